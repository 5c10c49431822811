"""Sources, sinks, projections, joins, aggregates, windows, sorts and scalar functions (S, P, J, A, W, L, U, F, X)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.functions import dates as d, labels as lb, money as m, text as tx
from martloom.operators import aggregates as ag, joins as jn, ordering as od, windows as wn
from martloom.plans import assistant, quality, silver
from martloom.session import scratch_path
from martloom.sources import sinks
from martloom.sources.run_table import RunTable
from martloom.sources.tables import TableSet, catalog_tables
from verification.common import Registry
from verification.ctes import AS_OF, LINE_NET, mean, money, pct, sql

R = Registry()
AT = dt.datetime(2001, 8, 1)
col, n = F.col, lambda: F.count(F.lit(1))


def read(x, path):
    return x.spark.read.parquet(path)


# --- S: sources, sinks, table writes ----------------------------------------------------------

R.add(
    "s1_load_tables",
    lambda x: x.star["lineitem"].select("l_orderkey", "l_partkey", "l_quantity"),
    "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem",
)


def stamped(x):
    path = scratch_path(x.spark, "s2")
    sinks.write_table(sinks.stamp(x.source["suppliers"], "b1", "r1", AT), path)
    sinks.write_table(sinks.stamp(x.source["stores"], "b2", "r2", AT), path)
    return read(x, path)


R.add(
    "s2_stamp_and_overwrite",
    stamped,
    sql("SELECT *, 'b2' AS _batch_id, 'r2' AS _run_id, TIMESTAMP '2001-08-01' AS _ingestion_ts FROM src_stores"),
)


def chunked(x):
    path, clicks = scratch_path(x.spark, "s3"), x.source["clickstream_events"]
    sinks.write_chunks([clicks.where(F.pmod("event_id", F.lit(4)) == i) for i in range(4)], path)
    return read(x, path)


R.add("s3_chunked_load", chunked, sql("SELECT * FROM src_clickstream_events"))


def replaced(x):
    path = scratch_path(x.spark, "s4")
    sinks.write_table(x.t["fact_payments"].limit(1), path)
    sinks.write_table(x.t["fact_payments"], path)
    return read(x, path)


R.add("s4_replace_table", replaced, sql("SELECT * FROM fact_payments"))


def managed_table(x, name, df):
    """A managed table of our own scratch schema, made anew."""
    x.spark.sql("CREATE SCHEMA IF NOT EXISTS martloom_check")
    x.spark.sql(f"DROP TABLE IF EXISTS martloom_check.{name}")
    path = scratch_path(x.spark, name)
    df.write.format("parquet").option("path", path).saveAsTable(f"martloom_check.{name}")
    return f"martloom_check.{name}"


R.add(
    "s5_managed_scan",
    lambda x: catalog_tables(x.spark, {"suppliers": managed_table(x, "s5", x.source["suppliers"])})["suppliers"],
    sql("SELECT * FROM src_suppliers"),
)


def typed_table(x):
    x.spark.sql("CREATE SCHEMA IF NOT EXISTS martloom_check")
    x.spark.sql("DROP TABLE IF EXISTS martloom_check.s6")
    where = scratch_path(x.spark, "s6")
    sinks.create_table(x.spark, "martloom_check.s6", "store_id INT, store_name STRING, size_sqft DOUBLE")
    rows = sinks.conform(x.source["stores"].withColumnRenamed("name", "store_name"), x.spark.table("martloom_check.s6").schema)
    sinks.write_table(rows, where)
    return read(x, where)


R.add(
    "s6_typed_table",
    typed_table,
    sql("SELECT store_id, name AS store_name, CAST(size_sqft AS DOUBLE) AS size_sqft FROM src_stores"),
)
R.add(
    "s7_add_missing_column",
    lambda x: sinks.with_missing_columns(x.source["streaming_metrics"].drop("event_lag_seconds"), {"event_lag_seconds": "double"}),
    sql("SELECT * REPLACE (CAST(NULL AS DOUBLE) AS event_lag_seconds) FROM src_streaming_metrics"),
)


def merged_schema(x):
    path, p = scratch_path(x.spark, "s8"), x.source["products"]
    sinks.write_table(p.where("product_id % 2 = 0").select("product_id", "name"), path)
    sinks.write_table(p.where("product_id % 2 = 1").select("product_id", "name", "status"), path, "append")
    return sinks.read_merged(x.spark, path)


R.add(
    "s8_append_with_new_column",
    merged_schema,
    sql("SELECT product_id, name, CASE WHEN product_id % 2 = 1 THEN status END AS status FROM src_products"),
)


def header_update(x):
    lines = x.source["order_items"].groupBy("order_id").agg(m.dollars(m.total("line_total")).alias("order_total"))
    return sinks.update_matched(x.source["orders"], lines, "order_id").select("order_id", "customer_id", "order_total")


R.add(
    "s9_update_matched",
    header_update,
    sql(
        "SELECT o.order_id, o.customer_id, COALESCE(i.t, o.order_total) AS order_total FROM src_orders o LEFT JOIN"
        f" (SELECT order_id, CAST(SUM({money('line_total')}) AS DOUBLE) AS t FROM src_order_items GROUP BY order_id) i"
        " ON o.order_id = i.order_id"
    ),
)


def conditional_upsert(x):
    """Fold the second half of the events into the first half's latest rows."""
    from martloom.streaming.live_sales import accepted_rows

    e = x.source["order_events"].select("order_id", "event_id", "event_time", "channel", "order_total")
    old = wn.latest_by_key(e.where("order_total < 80"), "order_id", ["event_time", "event_id"])
    new = wn.latest_by_key(e.where("order_total >= 80"), "order_id", ["event_time", "event_id"])
    return sinks.upsert_rows(old, accepted_rows(new, old), ["order_id"])


R.add(
    "s10_conditional_upsert",
    conditional_upsert,
    sql(
        "SELECT order_id, event_id, event_time, channel, order_total FROM (SELECT *, row_number() OVER"
        " (PARTITION BY order_id ORDER BY event_time DESC, event_id DESC) AS n FROM src_order_events) WHERE n = 1"
    ),
)


def composite_upsert(x):
    stock = x.t["fact_inventory_daily_movement"].groupBy("product_id", "warehouse_id").agg(F.sum("net_quantity").alias("q"))
    batch = stock.where("product_id % 3 = 0").withColumn("q", F.lit(0.0))
    return sinks.upsert_rows(stock, batch, ["product_id", "warehouse_id"])


R.add(
    "s11_composite_upsert",
    composite_upsert,
    sql(
        "SELECT product_id, warehouse_id, CASE WHEN product_id % 3 = 0 THEN 0 ELSE SUM(net_quantity) END AS q"
        " FROM fact_inventory_daily_movement GROUP BY product_id, warehouse_id"
    ),
)
R.add(
    "s12_insert_absent",
    lambda x: sinks.insert_absent(x.source["order_events"].where("channel = 'web'"), x.source["order_events"], "event_id").select("event_id"),
    sql("SELECT event_id FROM src_order_events WHERE channel <> 'web'"),
)


def latest_history(x):
    runs = RunTable(x.spark, scratch_path(x.spark, "s13"))
    for status in ("Active", "Inactive"):
        runs.commit(x.source["suppliers"].where(col("status") == status))
    now = runs.latest().select("supplier_id", F.lit(True).alias("latest"))
    return runs.history().select("supplier_id").join(now, "supplier_id", "left")


R.add(
    "s13_latest_and_history",
    latest_history,
    sql("SELECT supplier_id, CASE WHEN status = 'Inactive' THEN true END AS latest FROM src_suppliers"),
)


def audited(x):
    log, out = scratch_path(x.spark, "runs"), scratch_path(x.spark, "s14")
    with sinks.logged_run(x.spark, log, "r1", "load_orders", "bronze") as run:
        run["rows"] = sinks.write_table(x.source["orders"], out)
    return read(x, log).select("run_id", "notebook", "layer", "status", "rows_written", "error_message")


R.add(
    "s14_run_audit",
    audited,
    "SELECT 'r1' AS run_id, 'load_orders' AS notebook, 'bronze' AS layer, 'SUCCEEDED' AS status, COUNT(*) AS rows_written,"
    " '' AS error_message FROM orders",
)


def counted(x):
    names = ("fact_order_items", "fact_payments", "dim_products")
    rows = [(t, sinks.write_table(x.t[t], scratch_path(x.spark, t))) for t in names]
    return x.spark.createDataFrame(rows, "table_name string, rows long")


R.add(
    "s15_counts_during_write",
    counted,
    sql(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, COUNT(*) AS rows FROM {t}" for t in ("fact_order_items", "fact_payments", "dim_products")
        )
    ),
)


def json_sink(x):
    path = scratch_path(x.spark, "s16")
    p = x.source["products"].select("product_id", "name", "price")
    sinks.append_json(p.where("price < 1500"), path)
    sinks.append_json(p.where("price >= 1500"), path)
    return x.spark.read.schema(p.schema).json(path)


R.add("s16_json_append", json_sink, sql("SELECT product_id, name, price FROM src_products"))


def named(x):
    x.source["orders"].createOrReplaceTempView("martloom_orders_now")
    return x.spark.sql("SELECT status, count(*) AS orders FROM martloom_orders_now GROUP BY status")


R.add("s17_named_intermediate", named, sql("SELECT status, COUNT(*) AS orders FROM src_orders GROUP BY status"))
R.add(
    "s18_row_cap",
    lambda x: od.repeatable_limit(x.source["orders"].select("order_id", "status"), ["order_id"], 100),
    sql("SELECT order_id, status FROM src_orders ORDER BY order_id LIMIT 100"),
)


def existence(x):
    name = managed_table(x, "s19", x.source["categories"])
    return sinks.tables_exist(x.spark, [name, "martloom_check.absent"])


R.add(
    "s19_table_existence",
    existence,
    "SELECT 'martloom_check.s19' AS table_name, true AS present UNION ALL SELECT 'martloom_check.absent', false",
)


def described(x):
    name = managed_table(x, "s20", x.source["categories"])
    sinks.describe_tables(x.spark, {name: "Product categories"})
    text = x.spark.catalog.getTable(name).description
    return x.spark.table(name).select("category_id", F.lit(text).alias("description"))


R.add(
    "s20_table_descriptions",
    described,
    sql("SELECT category_id, 'Product categories' AS description FROM src_categories"),
)
R.add(
    "s21_model_frame",
    lambda x: x.t["customer_kpis"].select("customer_id", "total_orders", "total_revenue"),
    sql("SELECT customer_id, total_orders, total_revenue FROM customer_kpis"),
)

# --- P: projections and predicates ------------------------------------------------------------

R.add("p1_select_rename_type", lambda x: x.t["dim_stores"], sql("SELECT * FROM dim_stores"))
R.add(
    "p2_computed_columns",
    lambda x: x.source["order_items"].select("order_id", "line_total", m.dollars(m.line_net()).alias("net")),
    sql(f"SELECT order_id, line_total, CAST({LINE_NET} AS DOUBLE) AS net FROM src_order_items"),
)
R.add(
    "p3_bands",
    lambda x: x.source["products"].select(
        "product_id", lb.clv_tier(col("price") * 3).alias("tier"), lb.recency_risk(col("product_id") % 700).alias("risk"),
        lb.stock_status(col("product_id") % 400 - 10).alias("stock"), lb.churn_band(col("product_id") % 10 / 10).alias("churn"),
    ),
    sql(
        "SELECT product_id, CASE WHEN price * 3 >= 5000 THEN 'Platinum' WHEN price * 3 >= 2000 THEN 'Gold'"
        " WHEN price * 3 >= 500 THEN 'Silver' ELSE 'Bronze' END AS tier, CASE WHEN product_id % 700 > 365 THEN 'High'"
        " WHEN product_id % 700 > 180 THEN 'Medium' ELSE 'Low' END AS risk, CASE WHEN product_id % 400 - 10 <= 0 THEN"
        " 'Out of Stock' WHEN product_id % 400 - 10 <= 10 THEN 'Critical' WHEN product_id % 400 - 10 <= 50 THEN 'Low'"
        " WHEN product_id % 400 - 10 <= 200 THEN 'Normal' ELSE 'Overstocked' END AS stock, CASE WHEN product_id % 10 >= 7"
        " THEN 'High (>=70%)' WHEN product_id % 10 >= 4 THEN 'Medium (40-70%)' ELSE 'Low (<40%)' END AS churn FROM src_products"
    ),
)
R.add(
    "p4_ordinal",
    lambda x: x.source["customers"].select("customer_id", lb.segment_score(col("customer_segment")).alias("score")),
    sql(
        "SELECT customer_id, CASE customer_segment WHEN 'VIP' THEN 4 WHEN 'Premium' THEN 3 WHEN 'Standard' THEN 2 ELSE 1 END"
        " AS score FROM src_customers"
    ),
)
R.add(
    "p5_history_columns",
    lambda x: x.source["customers"].select("customer_id", *silver.history_columns(x.as_of)),
    sql(f"SELECT customer_id, {AS_OF} AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current FROM src_customers"),
)
R.add(
    "p6_blank",
    lambda x: x.source["clickstream_events"].select("event_id", tx.is_blank(col("session_id")).alias("blank")),
    sql("SELECT event_id, session_id IS NULL OR trim(session_id) = '' AS blank FROM src_clickstream_events"),
)
R.add("p7_positive", lambda x: x.t["fact_payments"].select("payment_id"), sql("SELECT payment_id FROM src_payments WHERE amount > 0"))
R.add(
    "p8_membership",
    lambda x: x.source["orders"].select("order_id", col("status").isin("Completed", "Returned").alias("done"),
                                        (~col("channel").isin("web", "mobile")).alias("in_store")),
    sql(
        "SELECT order_id, status IN ('Completed', 'Returned') AS done, channel NOT IN ('web', 'mobile') AS in_store"
        " FROM src_orders"
    ),
)
R.add(
    "p9_pattern",
    lambda x: x.source["customers"].where(~col("email").like("%@%.%")).select("customer_id"),
    sql("SELECT customer_id FROM src_customers WHERE email NOT LIKE '%@%.%'"),
)
R.add(
    "p10_tolerance",
    lambda x: quality.violating_rows(x.source, quality.Rule("x", "orders", "f", "t", "s", 0.0, next(
        r.check for r in quality.RULES if r.rule_id == "QR025"), ""), x.as_of).select("order_id"),
    sql(
        f"SELECT o.order_id FROM src_orders o JOIN (SELECT order_id, SUM({money('line_total')}) AS t FROM src_order_items"
        f" GROUP BY order_id) i ON o.order_id = i.order_id WHERE abs({money('o.order_total')} - i.t) > 0.01"
    ),
)
R.add(
    "p11_relative_date",
    lambda x: x.source["orders"].where(d.since("order_date", x.as_of, 89)).select("order_id", "order_date"),
    sql(f"SELECT order_id, order_date FROM src_orders WHERE order_date >= {AS_OF} - 89"),
)
R.add(
    "p12_any_term",
    lambda x: x.t["document_chunks"].where(tx.contains_any(F.lower("chunk_text"), ["there", "ierung", "ment"])).select("document_id"),
    sql(
        "SELECT document_id FROM document_chunks WHERE contains(lower(chunk_text), 'there') OR"
        " contains(lower(chunk_text), 'ierung') OR contains(lower(chunk_text), 'ment')"
    ),
)
R.add(
    "p13_by_id",
    lambda x: x.t["fact_order_items"].where(col("order_id") == 42).select("item_id", "quantity"),
    sql("SELECT item_id, quantity FROM fact_order_items WHERE order_id = 42"),
)
R.add(
    "p14_three_valued",
    lambda x: x.t["fact_shipments"].groupBy("delivered_on_time").agg(n().alias("shipments")),
    sql("SELECT delivered_on_time, COUNT(*) AS shipments FROM fact_shipments GROUP BY delivered_on_time"),
)
R.add(
    "p15_metric_by_name",
    lambda x: assistant.metric(x.t, "total_orders"),
    sql("SELECT 'total_orders' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM fact_orders WHERE order_status <> 'Cancelled'"),
)

# --- J: joins ---------------------------------------------------------------------------------

R.add(
    "j1_inner",
    lambda x: jn.match(x.t["fact_order_items"].select("order_id", "item_id"), x.t["fact_orders"].select("order_id", "channel"), "order_id"),
    sql("SELECT i.order_id, i.item_id, o.channel FROM fact_order_items i JOIN fact_orders o ON i.order_id = o.order_id"),
)
R.add(
    "j2_fact_to_dimension",
    lambda x: jn.enrich(x.source["products"].select("product_id", "category_id"),
                        x.source["categories"].select("category_id", "description"), "category_id"),
    sql(
        "SELECT p.product_id, p.category_id, c.description FROM src_products p LEFT JOIN src_categories c"
        " ON p.category_id = c.category_id"
    ),
)
R.add(
    "j3_dimension_to_fact",
    lambda x: jn.zero_fill(jn.attach(x.source["customers"].select("customer_id"), [
        x.source["support_tickets"].groupBy("customer_id").agg(n().alias("tickets"))], "customer_id"), ["tickets"]),
    sql(
        "SELECT c.customer_id, COUNT(t.ticket_id) AS tickets FROM src_customers c LEFT JOIN src_support_tickets t"
        " ON c.customer_id = t.customer_id GROUP BY c.customer_id"
    ),
)
R.add(
    "j4_preaggregated_sides",
    lambda x: jn.attach(x.source["products"].select("product_id"), [
        x.source["order_items"].groupBy("product_id").agg(F.sum("quantity").alias("units")),
        x.source["returns"].groupBy("product_id").agg(n().alias("returned")),
        x.source["product_reviews"].groupBy("product_id").agg(n().alias("reviews"))], "product_id"),
    sql(
        "SELECT p.product_id, i.units, r.returned, v.reviews FROM src_products p"
        " LEFT JOIN (SELECT product_id, SUM(quantity) AS units FROM src_order_items GROUP BY 1) i ON p.product_id = i.product_id"
        " LEFT JOIN (SELECT product_id, COUNT(*) AS returned FROM src_returns GROUP BY 1) r ON p.product_id = r.product_id"
        " LEFT JOIN (SELECT product_id, COUNT(*) AS reviews FROM src_product_reviews GROUP BY 1) v ON p.product_id = v.product_id"
    ),
)
R.add(
    "j5_exists",
    lambda x: jn.existing(x.source["orders"].select("order_id", "status"), x.source["returns"], "order_id"),
    sql("SELECT order_id, status FROM src_orders o WHERE EXISTS (SELECT 1 FROM src_returns r WHERE r.order_id = o.order_id)"),
)
R.add(
    "j6_not_exists",
    lambda x: jn.missing(x.source["orders"].select("order_id", "status"), x.source["order_items"], "order_id"),
    sql(
        "SELECT order_id, status FROM src_orders o WHERE NOT EXISTS (SELECT 1 FROM src_order_items i WHERE i.order_id = o.order_id)"
    ),
)
R.add(
    "j7_not_in",
    lambda x: jn.not_in(x.source["clickstream_events"].select("product_id"),
                        x.source["product_reviews"].select("product_id"), "product_id"),
    sql(
        "SELECT COUNT(*) AS violations FROM src_clickstream_events WHERE product_id NOT IN"
        " (SELECT product_id FROM src_product_reviews)"
    ),
)
R.add(
    "j8_anti_on_nested_join",
    lambda x: quality.unverified_review(x.source, x.as_of).select("review_id"),
    sql(
        "SELECT review_id FROM src_product_reviews r WHERE r.verified_purchase AND NOT EXISTS (SELECT 1 FROM src_orders o"
        " JOIN src_order_items i ON o.order_id = i.order_id WHERE o.customer_id = r.customer_id"
        " AND i.product_id = r.product_id AND o.status IN ('Completed', 'Returned'))"
    ),
)
R.add(
    "j9_residual",
    lambda x: jn.mismatched(x.source["returns"].select("order_id", "return_id", "return_date"),
                            x.source["orders"].select("order_id", "order_date"), "order_id",
                            col("return_date") <= col("order_date")),
    sql(
        "SELECT r.order_id, r.return_id, r.return_date, o.order_date FROM src_returns r JOIN src_orders o"
        " ON r.order_id = o.order_id WHERE r.return_date <= o.order_date"
    ),
)
R.add(
    "j10_one_row_aggregates",
    lambda x: jn.one_row([x.source[t].agg(n().alias(t)) for t in ("orders", "customers", "products")]),
    sql(
        "SELECT (SELECT COUNT(*) FROM src_orders) AS orders, (SELECT COUNT(*) FROM src_customers) AS customers,"
        " (SELECT COUNT(*) FROM src_products) AS products"
    ),
)


def derived_key(x):
    e = x.source["order_events"].withColumn("event_minute", d.minute("event_time"))
    keys = e.where("order_total > 150").select("event_minute", "channel").distinct()
    return e.join(keys, ["event_minute", "channel"], "left_semi").select("event_id", "event_minute", "channel")


R.add(
    "j11_derived_key",
    derived_key,
    sql(
        "SELECT event_id, date_trunc('minute', event_time) AS event_minute, channel FROM src_order_events e WHERE EXISTS"
        " (SELECT 1 FROM src_order_events k WHERE k.order_total > 150 AND k.channel = e.channel"
        " AND date_trunc('minute', k.event_time) = date_trunc('minute', e.event_time))"
    ),
)

# --- A: aggregations --------------------------------------------------------------------------

R.add(
    "a1_group",
    lambda x: x.source["order_items"].groupBy("product_id").agg(
        F.sum("quantity").alias("units"), F.min("line_total").alias("lowest"), F.max("line_total").alias("highest"),
        F.avg("quantity").alias("mean_quantity"), n().alias("lines")),
    sql(
        "SELECT product_id, SUM(quantity) AS units, MIN(line_total) AS lowest, MAX(line_total) AS highest,"
        f" {mean('SUM(quantity)', 'COUNT(quantity)')} AS mean_quantity, COUNT(*) AS lines FROM src_order_items GROUP BY product_id"
    ),
)
R.add(
    "a2_conditional",
    lambda x: x.source["orders"].groupBy("channel").agg(
        ag.count_when(col("status") == "Cancelled").alias("cancelled"),
        m.dollars(ag.sum_when(col("status") != "Cancelled", m.cents("order_total"))).alias("live_total"),
        F.max(F.when(col("status") == "Completed", col("order_date"))).alias("last_completed")),
    sql(
        "SELECT channel, COUNT(CASE WHEN status = 'Cancelled' THEN 1 END) AS cancelled,"
        f" CAST(SUM(CASE WHEN status <> 'Cancelled' THEN {money('order_total')} ELSE 0 END) AS DOUBLE) AS live_total,"
        " MAX(CASE WHEN status = 'Completed' THEN order_date END) AS last_completed FROM src_orders GROUP BY channel"
    ),
)
R.add(
    "a3_distinct",
    lambda x: ag.with_distinct(
        x.source["orders"], ["store_id"], "customer_id",
        {"customers": None, "live_customers": col("status") != "Cancelled"}, others={"orders": ("order_id", None)}),
    sql(
        "SELECT store_id, COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers,"
        " COUNT(DISTINCT CASE WHEN status <> 'Cancelled' THEN customer_id END) AS live_customers FROM src_orders GROUP BY store_id"
    ),
)
R.add(
    "a4_surplus_duplicates",
    lambda x: x.source["order_items"].agg(ag.surplus_duplicates("item_id").alias("surplus")),
    sql("SELECT COUNT(*) - COUNT(DISTINCT item_id) AS surplus FROM src_order_items"),
)
R.add(
    "a5_global",
    lambda x: x.source["payments"].agg(n().alias("rows"), m.dollars(m.total("amount")).alias("amount")),
    sql(f"SELECT COUNT(*) AS rows, CAST(SUM({money('amount')}) AS DOUBLE) AS amount FROM src_payments"),
)
R.add(
    "a6_share",
    lambda x: x.source["support_tickets"].groupBy("category").agg(ag.share_pct(col("status") == "resolved").alias("resolved_pct")),
    sql(
        f"SELECT category, {pct('COUNT(resolved_date)', 'COUNT(*)')} AS resolved_pct"
        " FROM src_support_tickets GROUP BY category"
    ),
)
R.add(
    "a7_stddev_pop",
    lambda x: x.source["order_items"].groupBy("product_id").agg(F.round(F.stddev_pop("quantity"), 6).alias("spread")),
    sql("SELECT product_id, ROUND(STDDEV_POP(quantity), 6) AS spread FROM src_order_items GROUP BY product_id"),
)
R.add(
    "a8_two_levels",
    lambda x: ag.two_level(x.source["inventory_events"], ["product_id", "event_date"], ["product_id"], "quantity").select(
        "product_id", "total", "groups", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std")),
    sql(
        "SELECT product_id, SUM(q) AS total, COUNT(*) AS groups, ROUND(AVG(q), 6) AS mean, ROUND(STDDEV_POP(q), 6) AS std"
        " FROM (SELECT product_id, event_date, SUM(quantity) AS q FROM src_inventory_events GROUP BY 1, 2) GROUP BY product_id"
    ),
)
R.add(
    "a9_filter_on_aggregate",
    lambda x: ag.groups_where(x.source["inventory_events"], ["product_id", "warehouse_id"], F.sum("quantity"), lambda t: t < 0),
    sql(
        "SELECT * FROM (SELECT product_id, warehouse_id, SUM(quantity) AS total FROM src_inventory_events GROUP BY 1, 2)"
        " WHERE total < 0"
    ),
)
R.add(
    "a10_group_by_expression",
    lambda x: x.source["orders"].groupBy(F.date_trunc("month", "order_date").cast("date").alias("month")).agg(n().alias("orders")),
    sql("SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, COUNT(*) AS orders FROM src_orders GROUP BY 1"),
)
R.add(
    "a11_exact_percentiles",
    lambda x: od.exact_percentiles(x.source["orders"], "order_total", [0.7, 0.9]).select(
        F.round("p1", 6).alias("p70"), F.round("p2", 6).alias("p90")),
    sql(
        "SELECT ROUND(quantile_cont(order_total, 0.7), 6) AS p70, ROUND(quantile_cont(order_total, 0.9), 6) AS p90 FROM src_orders"
    ),
)
R.add(
    "a12_status_counts",
    lambda x: ag.status_counts(x.source["shipments"], "status", "carrier"),
    sql("SELECT status, carrier, COUNT(*) AS rows FROM src_shipments GROUP BY status, carrier"),
)
R.add(
    "a14_distinct_rows",
    lambda x: x.source["shipments"].select("order_id", "carrier").distinct(),
    sql("SELECT DISTINCT order_id, carrier FROM src_shipments"),
)
R.add(
    "a15_batch_statistics",
    lambda x: x.source["order_events"].agg(n().alias("rows"), F.max("event_time").alias("newest")),
    sql("SELECT COUNT(*) AS rows, MAX(event_time) AS newest FROM src_order_events"),
)

# --- W, L, U: windows, sorts, unions ----------------------------------------------------------

R.add(
    "w1_numbered_top",
    lambda x: wn.numbered_top(x.source["orders"].select("order_id", "order_total"), [F.desc("order_total"), F.asc("order_id")], 500),
    sql(
        "SELECT order_id, order_total, CAST(n AS INTEGER) AS position FROM (SELECT order_id, order_total, row_number() OVER"
        " (ORDER BY order_total DESC, order_id) AS n FROM src_orders) WHERE n <= 500"
    ),
)
R.add(
    "w1_numbered_all",
    lambda x: wn.numbered(x.source["orders"].select("order_id", "order_total"), [F.desc("order_total"), F.asc("order_id")]),
    sql(
        "SELECT order_id, order_total, row_number() OVER (ORDER BY order_total DESC, order_id) AS position FROM src_orders"
    ),
)
R.add(
    "w2_window_percentile",
    lambda x: od.global_window_percentile(x.source["customers"].select("customer_id", "loyalty_points"), "loyalty_points", 0.9, "p90")
    .select("customer_id", F.round("p90", 6).alias("p90")),
    sql("SELECT customer_id, ROUND(quantile_cont(loyalty_points, 0.9) OVER (), 6) AS p90 FROM src_customers"),
)
R.add(
    "w3_running_total",
    lambda x: wn.running_total(x.source["orders"].select("order_id", "store_id", m.cents("order_total").alias("amount")),
                               ["store_id"], [F.asc("order_id")], "amount", "so_far").select(
        "order_id", "store_id", m.dollars(col("so_far")).alias("so_far")),
    sql(
        f"SELECT order_id, store_id, CAST(SUM({money('order_total')}) OVER (PARTITION BY store_id ORDER BY order_id"
        " ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS so_far FROM src_orders"
    ),
)
R.add(
    "w4_latest_by_key",
    lambda x: wn.latest_by_key(x.source["order_events"].select("order_id", "event_id", "event_time", "order_total"),
                               "order_id", ["event_time", "event_id"]),
    sql(
        "SELECT order_id, event_id, event_time, order_total FROM (SELECT *, row_number() OVER (PARTITION BY order_id"
        " ORDER BY event_time DESC, event_id DESC) AS n FROM src_order_events) WHERE n = 1"
    ),
)
R.add(
    "l1_mixed_sort",
    lambda x: x.source["stores"].orderBy(F.desc("state"), "name").select("state", "name"),
    sql("SELECT state, name FROM src_stores ORDER BY state DESC, name"),
)
R.add(
    "l2_label_order",
    lambda x: od.sorted_by_label(x.t["inventory_health"].select("stock_status").distinct(), "stock_status", lb.STOCK_ORDER)
    .withColumn("place", lb.position(col("stock_status"), lb.STOCK_ORDER)),
    sql(
        "SELECT DISTINCT stock_status, CASE stock_status WHEN 'Out of Stock' THEN 1 WHEN 'Critical' THEN 2 WHEN 'Low' THEN 3"
        " WHEN 'Normal' THEN 4 ELSE 5 END AS place FROM inventory_health"
    ),
)
R.add(
    "l3_top_k",
    lambda x: od.top_k(x.source["order_items"].select("item_id", "product_id", "line_total"),
                       [F.desc("line_total"), F.asc("item_id"), F.asc("product_id")], 20),
    sql("SELECT item_id, product_id, line_total FROM src_order_items ORDER BY line_total DESC, item_id, product_id LIMIT 20"),
)
R.add(
    "l4_repeatable_sample",
    lambda x: od.repeatable_limit(x.source["customers"].where("status = 'Churned'").select("customer_id"), ["customer_id"], 10),
    sql("SELECT customer_id FROM src_customers WHERE status = 'Churned' ORDER BY customer_id LIMIT 10"),
)


def halves(x):
    first, rest = od.ordered_split(x.source["orders"].select("order_id"), "order_id", 0.8)
    return first.withColumn("part", F.lit("first")).unionByName(rest.withColumn("part", F.lit("rest")))


R.add(
    "l5_ordered_split",
    halves,
    sql(
        "SELECT order_id, CASE WHEN n <= CAST(floor(c * 0.8) AS BIGINT) THEN 'first' ELSE 'rest' END AS part FROM"
        " (SELECT order_id, row_number() OVER (ORDER BY order_id) AS n, COUNT(*) OVER () AS c FROM src_orders)"
    ),
)


def accumulated(x):
    path, p = scratch_path(x.spark, "u1"), x.source["payments"]
    for status in ("Completed", "Refunded", "Failed"):
        sinks.write_table(p.where(col("status") == status), path, "append")
    return read(x, path)


R.add("u1_accumulate", accumulated, sql("SELECT * FROM src_payments"))
R.add(
    "u2_first_available",
    lambda x: assistant.first_available(
        TableSet({"empty": lambda: x.source["orders"].limit(0), "stores": lambda: x.source["stores"]}), ["absent", "empty", "stores"]
    )[1].select("store_id"),
    sql("SELECT store_id FROM src_stores"),
)

# --- F, X: scalar functions -------------------------------------------------------------------

R.add(
    "f1_date_format",
    lambda x: x.source["orders"].select("order_id", d.date_key("order_date").alias("k"),
                                        F.date_format("order_date", "MMMM").alias("month_name"),
                                        F.date_format("order_date", "EEEE").alias("day_name")),
    sql(
        "SELECT order_id, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS k, strftime(order_date, '%B') AS month_name,"
        " strftime(order_date, '%A') AS day_name FROM src_orders"
    ),
)
R.add(
    "f2_date_parts",
    lambda x: x.source["orders"].select("order_id", F.year("order_date").alias("y"), F.quarter("order_date").alias("q"),
                                        F.month("order_date").alias("m"), F.weekofyear("order_date").alias("w"),
                                        F.dayofmonth("order_date").alias("dom"), F.dayofweek("order_date").alias("dow")),
    sql(
        "SELECT order_id, CAST(year(order_date) AS INTEGER) AS y, CAST(quarter(order_date) AS INTEGER) AS q,"
        " CAST(month(order_date) AS INTEGER) AS m, CAST(weekofyear(order_date) AS INTEGER) AS w,"
        " CAST(day(order_date) AS INTEGER) AS dom, CAST(dayofweek(order_date) + 1 AS INTEGER) AS dow FROM src_orders"
    ),
)
R.add(
    "f3_season_weekend",
    lambda x: x.source["orders"].select("order_id", d.season(F.month("order_date")).alias("season"),
                                        F.dayofweek("order_date").isin(1, 7).alias("weekend")),
    sql(
        "SELECT order_id, CASE WHEN month(order_date) IN (12, 1, 2) THEN 'Winter' WHEN month(order_date) IN (3, 4, 5)"
        " THEN 'Spring' WHEN month(order_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,"
        " dayofweek(order_date) IN (0, 6) AS weekend FROM src_orders"
    ),
)
R.add(
    "f4_explode_sequence",
    lambda x: x.source["suppliers"].select("supplier_id", F.explode(F.sequence(F.lit(0), (col("lead_time_days")).cast("int"))).alias("day")),
    sql("SELECT supplier_id, CAST(UNNEST(generate_series(0, lead_time_days)) AS INTEGER) AS day FROM src_suppliers"),
)
R.add(
    "f5_date_arithmetic",
    lambda x: x.source["orders"].select("order_id", F.add_months("order_date", 3).alias("in_3_months"),
                                        F.date_add("order_date", 30).alias("in_30_days"), F.date_sub("order_date", 7).alias("week_ago"),
                                        d.age_days("order_date", x.as_of).alias("age")),
    sql(
        "SELECT order_id, CAST(order_date + INTERVAL 3 MONTH AS DATE) AS in_3_months, order_date + 30 AS in_30_days,"
        f" order_date - 7 AS week_ago, CAST(date_diff('day', order_date, {AS_OF}) AS INTEGER) AS age FROM src_orders"
    ),
)
R.add(
    "f6_to_date",
    lambda x: x.star["lineitem"].select("l_orderkey", d.as_date(F.concat(F.date_format("l_shipdate", "yyyy-MM-"), F.lit("30"))).alias("day")),
    "SELECT l_orderkey, TRY_CAST(strftime(l_shipdate, '%Y-%m-') || '30' AS DATE) AS day FROM lineitem",
)
R.add(
    "f7_minute",
    lambda x: x.star["events"].select("event_id", d.minute("ts").cast("timestamp_ntz").alias("minute")),
    "SELECT event_id, date_trunc('minute', ts) AS minute FROM events",
)
R.add(
    "f8_as_of",
    lambda x: x.source["stores"].select("store_id", d.day(x.as_of).alias("today"), d.age_days("opened_date", x.as_of).alias("age")),
    sql(f"SELECT store_id, {AS_OF} AS today, CAST(date_diff('day', opened_date, {AS_OF}) AS INTEGER) AS age FROM src_stores"),
)
R.add(
    "f9_seconds_before",
    lambda x: x.star["events"].select("event_id", d.seconds_before(col("ts").cast("timestamp"), col("event_id") % 60).cast("timestamp_ntz").alias("t")),
    "SELECT event_id, ts - to_seconds(event_id % 60) AS t FROM events",
)
R.add(
    "f10_strings",
    lambda x: x.source["customers"].select("customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
                                           F.lower(F.trim("email")).alias("email"), F.length("country").alias("len"),
                                           F.lpad(col("customer_id").cast("string"), 7, "0").alias("padded")),
    sql(
        "SELECT customer_id, first_name || ' ' || last_name AS full_name, lower(trim(email)) AS email,"
        " CAST(length(country) AS INTEGER) AS len, lpad(CAST(customer_id AS VARCHAR), 7, '0') AS padded FROM src_customers"
    ),
)
R.add(
    "f11_word_count",
    lambda x: x.star["documents"].select("doc_id", tx.word_count(col("text")).alias("words")),
    "SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS words FROM documents",
)
R.add(
    "f12_contains",
    lambda x: x.star["documents"].select("doc_id", F.lower("text").contains("the").alias("hit")),
    "SELECT doc_id, contains(lower(text), 'the') AS hit FROM documents",
)
R.add(
    "f13_numbers",
    lambda x: x.star["lineitem"].select("l_orderkey", F.abs(-col("l_quantity")).alias("a"), F.greatest("l_quantity", "l_extendedprice").alias("g"),
                                        F.least("l_discount", "l_tax").alias("s"), (col("l_orderkey") % 7).alias("r"),
                                        m.money("l_extendedprice").alias("cents")),
    "SELECT l_orderkey, abs(-l_quantity) AS a, greatest(l_quantity, l_extendedprice) AS g, least(l_discount, l_tax) AS s,"
    " l_orderkey % 7 AS r, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS cents FROM lineitem",
)
R.add(
    "f14_conditionals",
    lambda x: x.source["clickstream_events"].select("event_id", F.coalesce("product_id", F.lit(-1)).alias("p"),
                                                    F.nullif("page", F.lit("home")).alias("page"),
                                                    col("duration_seconds").cast("double").alias("d")),
    sql(
        "SELECT event_id, COALESCE(product_id, -1) AS p, NULLIF(page, 'home') AS page, CAST(duration_seconds AS DOUBLE) AS d"
        " FROM src_clickstream_events"
    ),
)
R.add(
    "f15_search_terms",
    lambda x: x.star["documents"].select("doc_id", F.concat_ws(" ", tx.search_terms(col("text"))).alias("terms")),
    "SELECT doc_id, array_to_string(list_transform(list_slice(list_filter(regexp_extract_all(text, '[A-Za-z0-9_]+'),"
    " lambda x: length(x) > 3), 1, 8), lambda x: lower(x)), ' ') AS terms FROM documents",
)
R.add(
    "f16_keyword",
    lambda x: x.star["documents"].select("doc_id", tx.has_keyword(F.lower("text"), "and").alias("word"),
                                         tx.has_keyword(F.lower("text"), "on the").alias("phrase")),
    "SELECT doc_id, regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}_])and([^\\p{L}\\p{N}_]|$)') AS word,"
    " contains(lower(text), 'on the') AS phrase FROM documents",
)
R.add(
    "f17_extract",
    lambda x: x.source["questions"].select("question_id", tx.customer_id_in(col("text")).alias("customer"),
                                           tx.period_days(col("text")).alias("days"), tx.document_ids(col("text")).alias("docs")),
    sql(
        "SELECT question_id, upper(NULLIF(regexp_extract(text, '(?i)C[0-9]{7}'), '')) AS customer,"
        " CASE regexp_extract(text, '([0-9]+)\\s*(day|week|month)', 2) WHEN '' THEN 7 ELSE"
        " CAST(regexp_extract(text, '([0-9]+)\\s*(day|week|month)', 1) AS INTEGER)"
        " * CASE regexp_extract(text, '([0-9]+)\\s*(day|week|month)', 2) WHEN 'day' THEN 1 WHEN 'week' THEN 7 ELSE 30 END END AS days,"
        " array_to_string(regexp_extract_all(text, 'DOC[0-9]+'), ',') AS docs FROM src_questions"
    ),
)
R.add(
    "f18_scrub_literals",
    lambda x: x.source["sql_texts"].select("sql_id", tx.without_literals(col("sql")).alias("scrubbed"),
                                           tx.mentions_forbidden_sql(col("sql")).alias("forbidden")),
    sql(
        "SELECT sql_id, regexp_replace(sql, '''(?:''''|[^''])*''', '''''', 'g') AS scrubbed,"
        f" regexp_matches(regexp_replace(sql, '''(?:''''|[^''])*''', '', 'g'), '(?i)\\b({'|'.join(tx.FORBIDDEN_SQL)})\\b') AS forbidden"
        " FROM src_sql_texts"
    ),
)
R.add(
    "f19_preview",
    lambda x: x.star["documents"].select("doc_id", tx.preview(col("text"), 160).alias("start")),
    "SELECT doc_id, substring(text, 1, 160) AS start FROM documents",
)
R.add(
    "f20_formatting",
    lambda x: x.source["order_items"].groupBy("product_id").agg(n().alias("lines"), m.total("line_total").alias("total"),
                                                               ag.count_when(col("discount_pct") > 0.05).alias("cut")).select(
        "product_id", tx.dollars(m.dollars(col("total"))).alias("total"), tx.thousands(col("lines") * 1000).alias("lines"),
        tx.percent(F.lit(0.25)).alias("share")),
    sql(
        f"SELECT product_id, '$' || format('{{:,}}', CAST(floor(t) AS BIGINT)) || '.' || lpad(CAST(CAST((t - floor(t)) * 100 AS INTEGER)"
        " AS VARCHAR), 2, '0') AS total, format('{:,}', c * 1000) AS lines, '25.00%' AS share FROM"
        f" (SELECT product_id, SUM({money('line_total')}) AS t, COUNT(*) AS c FROM src_order_items GROUP BY product_id)"
    ),
)
R.add(
    "x1_label_lookup",
    lambda x: x.source["customer_scores"].select("customer_id", lb.label_lookup(col("cluster"), {0: "Low", 1: "Mid", 2: "High"}).alias("label")),
    sql(
        "SELECT customer_id, CASE cluster WHEN 0 THEN 'Low' WHEN 1 THEN 'Mid' WHEN 2 THEN 'High' ELSE 'Unknown' END AS label"
        " FROM src_customer_scores"
    ),
)


def per_batch(x):
    """A callback per micro-batch that appends what it is given."""
    from martloom.streaming.events import event_stream, land

    landing, out = scratch_path(x.spark, "landing"), scratch_path(x.spark, "x2")
    land(x.source["order_events"].repartition(4, "event_id"), landing)

    def keep(batch, batch_id):
        batch.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(out)

    event_stream(x.spark, landing, 2).writeStream.foreachBatch(keep).trigger(availableNow=True).option(
        "checkpointLocation", f"{out}-cp"
    ).start().awaitTermination()
    return read(x, out).select("event_id", "order_total")


R.add("x2_batch_callback", per_batch, sql("SELECT event_id, order_total FROM src_order_events"))
