import datetime as dt

import pytest
from pyspark.sql import functions as F

from martloom.plans import gold, order_states, silver
from martloom.plans.demand import demand_forecast
from martloom.plans.medallion import build_lakehouse
from martloom.sources.tables import latest_order_date, retail_tables

AS_OF = dt.date(2024, 6, 30)


def orders(spark, rows):
    return spark.createDataFrame(
        rows, "order_id long, customer_id long, store_id long, order_date string, status string, channel string,"
        " order_total double, discount_amount double, tax_amount double, currency string",
    )


@pytest.fixture()
def t(spark):
    return {
        "orders": orders(
            spark,
            [
                (1, 10, 1, "2024-06-01", "Completed", "web", 100.0, 10.0, 7.2, "USD"),
                (2, 10, 1, "2024-06-01", "Cancelled", "web", 50.0, 0.0, 4.0, "USD"),
                (3, 11, 1, "2024-06-02", "Returned", "store", 20.0, 0.0, 1.6, "USD"),
                (4, None, 1, "2024-06-02", "Completed", "store", 20.0, 0.0, 1.6, "USD"),
                (5, 11, 1, "2024-06-02", "Completed", "store", 0.0, 0.0, 0.0, "USD"),
            ],
        ),
        "order_items": spark.createDataFrame(
            [("a", 1, 7, 2, 50.0, 100.0, 0.1), ("b", 3, 7, 1, 20.0, 20.0, 0.0), ("c", 3, 8, 0, 20.0, 0.0, 0.0)],
            "item_id string, order_id long, product_id long, quantity long, unit_price double, line_total double,"
            " discount_pct double",
        ),
        "returns": spark.createDataFrame(
            [("r1", 1, 7, "x", "2024-06-05", 30.0, "Approved"), ("r2", 1, 7, "x", "2024-06-05", 40.0, "Rejected"),
             ("r3", 3, 7, "x", "2024-06-06", 99.0, "Approved")],
            "return_id string, order_id long, product_id long, reason string, return_date string, refund_amount double,"
            " status string",
        ),
    }


def test_fact_orders_refunds_floor_and_filter(t):
    got = {r.order_id: r for r in silver.fact_orders(t).collect()}
    assert sorted(got) == [1, 2, 3]
    assert (got[1].net_revenue, got[1].approved_refund_amount, got[1].net_sales_before_refunds) == (60.0, 30.0, 90.0)
    assert got[2].net_revenue == 0.0
    assert got[3].net_revenue == 0.0  # refund above the order's value
    assert got[1].order_date_key == 20240601


def test_reconciled_headers_keep_orders_without_lines(t):
    got = {r.order_id: (r.order_total, r.discount_amount, r.tax_amount) for r in silver.reconciled_orders(t).collect()}
    assert got[1] == (100.0, 10.0, 7.2)
    assert got[2] == (50.0, 0.0, 4.0)
    assert got[3] == (20.0, 0.0, 1.6)


def test_daily_sales_counts_cancelled_customers(t):
    full = {**t, "fact_orders": silver.fact_orders(t)}
    row = next(r for r in gold.daily_sales_summary(full).collect() if r.channel == "web")
    assert (row.order_attempts, row.total_orders, row.unique_customers, row.cancelled_orders) == (2, 1, 1, 1)
    assert (row.total_revenue, row.avg_order_value, row.total_discounts) == (60.0, 60.0, 10.0)


def test_customers_and_products_without_activity(spark, t):
    customers = spark.createDataFrame(
        [(99, "A", "B", " A@B.c ", "1", "2000-01-01", "VIP", "2024-06-20", "US", "X", "Active", 5)],
        "customer_id long, first_name string, last_name string, email string, phone string, date_of_birth string,"
        " customer_segment string, registration_date string, country string, city string, status string,"
        " loyalty_points long",
    )
    full = {**t, "fact_orders": silver.fact_orders(t), "customers": customers}
    full["dim_customers"] = silver.dim_customers(full, AS_OF)
    full["customer_kpis"] = gold.customer_kpis(full, AS_OF)
    row = full["customer_kpis"].first()
    assert (row.total_orders, row.total_revenue, row.avg_order_value) == (0, 0.0, 0.0)
    assert (row.last_order_date, row.days_since_last_order, row.tenure_days) == (dt.date(2024, 6, 20), 10, 10)
    clv = gold.customer_lifetime_value(full).first()
    assert (clv.baseline_3yr_clv, clv.clv_tier) == (0.0, "Bronze")
    assert full["dim_customers"].first().email_normalized == "a@b.c"


def test_zero_price_has_no_margin_percent(spark):
    t = {
        "products": spark.createDataFrame(
            [(1, "p", "c", 1, 0.0, 0.0, "s", 1.0, "Active"), (2, "q", "x", 1, 3.0, 2.0, "s", 1.0, "Active")],
            "product_id long, name string, category_id string, supplier_id long, price double, cost double, sku string,"
            " weight_kg double, status string",
        ),
        "categories": spark.createDataFrame([("c", "Cat", "")], "category_id string, name string, description string"),
    }
    got = {r.product_id: (r.category_name, r.gross_margin, r.margin_pct) for r in silver.dim_products(t).collect()}
    assert got == {1: ("Cat", 0.0, None), 2: (None, 1.0, 33.33)}


def test_on_time_is_unknown_until_delivered(spark):
    t = {
        "shipments": spark.createDataFrame(
            [("a", 1, "c", "t", "s", "2024-01-01", "2024-01-03", None, 1.0), ("b", 1, "c", "t", "s", "2024-01-01", "2024-01-03", "2024-01-03", 1.0),
             ("c", 1, "c", "t", "s", "2024-01-01", "2024-01-03", "2024-01-04", 1.0)],
            "shipment_id string, order_id long, carrier string, tracking_number string, status string, ship_date string,"
            " estimated_delivery string, actual_delivery string, weight_kg double",
        )
    }
    assert [r.delivered_on_time for r in silver.fact_shipments(t).orderBy("shipment_id").collect()] == [None, True, False]


def test_demand_window_and_stability(spark):
    facts = spark.createDataFrame(
        [(1, AS_OF - dt.timedelta(days=89), "Completed"), (2, AS_OF - dt.timedelta(days=90), "Completed"),
         (3, AS_OF, "Cancelled"), (4, AS_OF, "Completed")],
        "order_id long, order_date date, order_status string",
    )
    items = spark.createDataFrame([(1, 1, 6), (2, 1, 600), (3, 1, 600), (4, 2, 9), (1, 2, 9)], "order_id long, product_id long, quantity long")
    t = {"fact_orders": facts, "fact_order_items": items, "dim_products": spark.createDataFrame([(1,), (2,), (3,)], "product_id long")}
    got = {r.product_id: (r.predicted_units, r.stability_score) for r in demand_forecast(t, AS_OF).collect()}
    assert got == {1: (2, 0.011), 2: (6, 0.022), 3: (0, 0.0)}


def test_order_states_by_age(spark):
    t = {"orders": orders(spark, [(i, 1, 1, d, s, "web", 1.0, 0.0, 0.0, "USD") for i, (d, s) in enumerate(
        [("2024-06-30", "Shipped"), ("2024-06-28", "Shipped"), ("2024-06-27", "Processing"), ("2024-06-01", "Returned")])])}
    got = [(r.age_band, r.state_allowed) for r in order_states.status_by_age(t, AS_OF).orderBy("order_id").collect()]
    assert got == [("up to 0", False), ("up to 2", True), ("up to 7", False), ("older", True)]


def test_return_quota_too_small(t):
    with pytest.raises(ValueError):
        order_states.select_returns(t, AS_OF, 0)


def test_return_quota_that_cannot_be_filled(t):
    with pytest.raises(ValueError, match="do not fill"):
        order_states.select_returns(t, AS_OF, 10_000, every_returned=False)


def test_returned_order_without_lines_is_an_error(spark, t):
    lost = {**t, "order_items": t["order_items"].where("false")}
    returned = {**lost, "orders": t["orders"].withColumn("status", F.lit("Returned"))}
    with pytest.raises(ValueError, match="no eligible product"):
        order_states.select_returns(returned, AS_OF, 0)


def test_running_stock_flags_a_dip_that_the_total_hides(spark):
    rows = [("a", 1, 1, "sale", -5, "2024-01-01"), ("b", 1, 1, "receipt", 9, "2024-01-02")]
    t = {"inventory_events": spark.createDataFrame(rows, "event_id string, product_id long, warehouse_id long, event_type string, quantity long, event_date string")}
    got = [(r.running_stock, r.below_zero) for r in order_states.running_stock(t).orderBy("event_id").collect()]
    assert got == [(-5, True), (4, False)]


def test_whole_lakehouse_is_written(spark, small, tmp_path):
    source, as_of = retail_tables(spark, small), latest_order_date(spark, small)
    names = [n for n in source if n not in ("order_events", "questions", "sql_texts", "customer_scores", "pipeline_runs", "streaming_metrics")]
    t, counts = build_lakehouse(
        spark, source, str(tmp_path), as_of, "run1", dt.datetime(2001, 8, 1), names, enforce_quality=False
    )
    assert counts["orders"] == source["orders"].count() == t["fact_orders"].count()
    assert counts["customer_360"] == source["customers"].count()
    assert counts["executive_kpi"] == 1
    assert "_run_id" in t["fact_orders"].columns
    runs = spark.read.parquet(str(tmp_path / "monitoring/pipeline_runs"))
    assert {(r.notebook, r.status) for r in runs.collect()} == {
        (s, "SUCCEEDED") for s in ("load_bronze", "check_quality", "build_silver", "build_gold", "build_genai")
    }
    assert spark.read.parquet(str(tmp_path / "quality/quality_results")).count() == 36


def test_return_quota_takes_each_pair_once(spark, t):
    full = {**t, "orders": t["orders"].withColumn("status", F.expr("if(order_id % 2 = 0, 'Returned', 'Completed')"))}
    pairs = order_states.eligible_pairs(full, AS_OF)
    n = pairs.count()
    got = order_states.select_returns(full, AS_OF, n, every_returned=False).collect()
    assert sorted((r.order_id, r.product_id) for r in got) == sorted((r.order_id, r.product_id) for r in pairs.collect())
    first = pairs.where("status = 'Returned'").groupBy("order_id").agg(F.min("product_id"))
    assert sorted((r.order_id, r.product_id) for r in got if r.forced) == sorted(map(tuple, first.collect()))
