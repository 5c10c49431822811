import datetime as dt
import os
from contextlib import nullcontext

import pytest
from pyspark.sql import functions as F

from martloom.plans import quality as q, validation as v
from martloom.plans.quality_rules import RULES, Rule
from martloom.sources.tables import TableSet, latest_order_date, retail_tables

AT = dt.datetime(2024, 6, 30)
AS_OF = AT.date()


@pytest.fixture()
def t(spark):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "customers": df([("c1", "a@b.c"), ("c1", None), (None, "no-at"), ("c2", " ")], "customer_id string, email string"),
        "orders": df([("o1", "c1", "Completed"), ("o2", "zz", "Cancelled"), ("o3", None, "Returned"), (None, "c1", "Completed")],
                     "order_id string, customer_id string, status string"),
        "payments": df([("o1", "Completed"), ("o2", "Completed"), ("o9", "Failed"), (None, "Completed")], "order_id string, status string"),
        "shipments": df([("o2",), ("o2",), ("o1",)], "order_id string"),
        "returns": df([("o3", "Rejected")], "order_id string, status string"),
    }


def rules(*ids):
    return [r for r in RULES if r.rule_id in ids]


def counts(spark, t, chosen):
    return {r.rule_id: r.failed_records for r in q.violation_counts(spark, t, chosen, AS_OF).collect()}


def test_planted_violations(spark, t):
    got = counts(spark, t, rules("QR001", "QR002", "QR003", "QR029", "QR031", "QR032", "QR033"))
    assert got == {
        "QR001": 2,  # a repeat and a NULL
        "QR002": 2,
        "QR003": 2,  # NULL is not a malformed address
        "QR029": 2,  # both shipments of the cancelled order
        "QR031": 1,
        "QR032": 2,  # the unpaid return and the order without an id
        "QR033": 1,
    }


def test_reference_rule_with_null_in_reference_counts_nothing(spark, t):
    assert counts(spark, t, rules("QR005", "QR011")) == {"QR005": 0, "QR011": 0}
    clean = {**t, "customers": t["customers"].where("customer_id IS NOT NULL"), "orders": t["orders"].where("order_id IS NOT NULL")}
    assert counts(spark, clean, rules("QR005", "QR011")) == {"QR005": 1, "QR011": 1}


def test_headers_are_judged_unrounded(spark):
    nan = float("nan")
    headers = [(k, x, 0.0, 0.8) for k, x in enumerate([10.0, 10.01, 10.014, 10.0149, 10.02, nan, None])]
    t = {
        "orders": spark.createDataFrame(headers, "order_id int, order_total double, discount_amount double, tax_amount double"),
        "order_items": spark.createDataFrame([(k, 10.0, 0.0) for k in range(7)], "order_id int, line_total double, discount_pct double"),
    }
    assert counts(spark, t, rules("QR025", "QR026", "QR027")) == {"QR025": 4, "QR026": 0, "QR027": 1}
    taxed = {"orders": spark.createDataFrame([(1, 10.0, 0.0, 0.814)], t["orders"].schema), "order_items": t["order_items"]}
    assert counts(spark, taxed, rules("QR027")) == {"QR027": 1}


def test_fused_counts_equal_single_rule_counts(spark, small):
    t, as_of = retail_tables(spark, small), latest_order_date(spark, small)
    fused = {r.rule_id: r.failed_records for r in q.violation_counts(spark, t, RULES, as_of).collect()}
    assert len(fused) == 36
    for rule_id in ("QR005", "QR011", "QR025", "QR030", "QR031", "QR034"):
        rule = rules(rule_id)[0]
        assert fused[rule_id] == q.violation_counts(spark, t, [rule], as_of).first().failed_records
        if rule_id not in ("QR034",):
            assert fused[rule_id] == q.violating_rows(t, rule, as_of).count()


MIXED = [
    Rule("A1", "customers", "email", "completeness", "error", 50.0, "where: email IS NULL", "fits the threshold"),
    Rule("A2", "customers", "customer_id", "uniqueness", "critical", 0.0, "unique: customer_id", "fails"),
    Rule("A3", "customers", "email", "validity", "error", 0.0, "where: no_such_column > 1", "broken"),
    Rule("A4", "customers", "email", "validity", "error", 0.0, "where: true", "disabled", False),
    Rule("A5", "nothing", "x", "validity", "warning", 0.0, "where: true", "missing dataset"),
    Rule("A6", "customers", "email", "validity", "warning", 0.0, "sql: SELECT count(*) FROM {customers} WHERE email = 'no-at'", "free SQL"),
]


def test_broken_rules_become_errors_and_hide_nothing(spark, t):
    results, errors = q.run_rules(spark, TableSet({k: (lambda df=df: df) for k, df in t.items()}), AS_OF, "r", AT, MIXED)
    got = {r.rule_id: (r.status, r.failed_records, r.failure_pct) for r in results.collect()}
    assert got == {
        "A1": ("PASS", 1, 25.0), "A2": ("FAIL", 2, 50.0), "A3": ("ERROR", 0, 0.0), "A5": ("ERROR", 0, 0.0), "A6": ("FAIL", 1, 25.0),
    }
    assert set(errors) == {"A3", "A5"}
    with pytest.raises(q.QualityGateError, match="A2.*A3"):
        q.gate(results)
    assert q.run_status(results).first().status == "FAILED"
    summary = {r.severity: (r.rule_count, r.passed, r.failed, r.errors, r.pass_rate_pct) for r in q.quality_summary(results).collect()}
    assert summary == {"error": (2, 1, 0, 1, 50.0), "critical": (1, 0, 1, 0, 0.0), "warning": (2, 0, 1, 1, 0.0)}
    kpi = q.data_quality_kpi(q.quality_summary(results), AS_OF).first()
    assert (kpi.total_rules, kpi.total_passed, kpi.overall_pass_rate_pct) == (5, 1, 20.0)


def test_samples_are_capped_repeatable_and_cover_uniqueness(spark, t):
    results, _ = q.run_rules(spark, t, AS_OF, "r", AT, [MIXED[1]])
    a = q.failure_samples(spark, t, results, AS_OF, AT, [MIXED[1]])
    b = q.failure_samples(spark, t, results, AS_OF, AT, [MIXED[1]])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert a.count() == 3  # the repeated id twice, and the NULL id
    many = {"customers": spark.range(100).select(F.lit("x").alias("customer_id"), F.col("id").cast("string").alias("email"))}
    results, _ = q.run_rules(spark, many, AS_OF, "r", AT, [MIXED[1]])
    assert q.failure_samples(spark, many, results, AS_OF, AT, [MIXED[1]]).count() == 10


def test_gate_lets_warnings_pass(spark, t):
    results, _ = q.run_rules(spark, t, AS_OF, "r", AT, [MIXED[0], MIXED[5]])
    q.gate(results)


def test_rules_survive_a_table(spark):
    assert q.rules_from_frame(q.rules_frame(spark)) == sorted(RULES)


def test_small_datasets_warn(spark, t):
    counted = q.dataset_counts(spark, t, [MIXED[0], MIXED[4]])
    assert {r.dataset: r.total_records for r in q.small_datasets(counted).collect()} == {"customers": 4, "nothing": 0}


def test_validation_reports_missing_tables_and_gates(spark, t):
    results = v.run_checks(spark, t, AS_OF, "r", AT)
    got = {r.check_name: (r.status, r.actual_value) for r in results.collect()}
    assert len(got) == len(v.CHECKS)
    assert got["orders_customer_fk"] == ("FAIL", "2")
    assert got["null_churn_predictions"] == ("FAIL", "ERROR")
    assert got["realtime_rows"] == ("SKIP", "ERROR")
    with pytest.raises(v.ValidationError):
        v.gate(results)
    assert v.gate(results.where("category NOT IN ('core', 'objects')")) == [
        "agent_routing_eval", "available_now_realtime_rows", "available_now_successful_microbatches", "ml_customer_coverage",
    ]


def test_optional_tables_skip(spark, t):
    objects = {r.check_name: r.status for r in v.object_checks(spark, t, "r", AT).collect()}
    assert objects["object:customers"] == "PASS" and objects["object:product_kpis"] == "FAIL"
    assert objects["managed:orders_bronze_stream"] == "SKIP"


def test_halving_finds_every_broken_item_in_few_runs():
    runs = []

    def run(items):
        runs.append(len(items))
        if {5, 61} & set(items):
            raise RuntimeError("broken")
        return [i * 10 for i in items]

    rows, errors = q.in_halves(list(range(64)), run)
    assert rows == [i * 10 for i in range(64) if i not in (5, 61)]
    assert [(i, str(e)) for i, e in errors] == [(5, "broken"), (61, "broken")]
    assert len(runs) <= 25
    assert q.in_halves([], run) == ([], [])


def test_a_file_damaged_after_it_was_opened_costs_its_own_rules(spark, t, tmp_path):
    path = tmp_path / "customers"
    t["customers"].coalesce(1).write.parquet(str(path))
    lost = {**t, "customers": spark.read.parquet(str(path)), "orders": spark.createDataFrame([(1,), (None,)], "order_id int")}
    for part in path.glob("part-*"):
        part.write_bytes(b"no parquet")
        (path / f".{part.name}.crc").unlink()
    kept = Rule("B1", "orders", "order_id", "completeness", "warning", 0.0, "where: order_id IS NULL", "stays")
    results, errors = q.run_rules(spark, lost, AS_OF, "r", AT, [MIXED[0], MIXED[1], kept])
    got = {r.rule_id: (r.status, r.failed_records, r.total_records) for r in results.collect()}
    assert got == {"A1": ("ERROR", 0, 0), "A2": ("ERROR", 0, 0), "B1": ("FAIL", 1, 2)}
    assert set(errors) == {"A1", "A2"}


def test_rule_checks_share_the_scans_of_the_rules(spark, small):
    def scans(df):
        return df._jdf.queryExecution().executedPlan().toString().count("FileScan")

    t, as_of = retail_tables(spark, small), latest_order_date(spark, small)
    checks = [c for c in v.CHECKS if isinstance(c.actual, v.RuleCount)]
    asked = [v.RULE[c.actual.rule_id] for c in checks]
    joint = v.check_rows(spark, t, as_of, checks)
    assert 0 < scans(joint) == scans(q.violation_counts(spark, t, asked, as_of))
    singly = {c.name: v.check_rows(spark, t, as_of, [c]).first().actual for c in checks[:3]}
    together = {r.check_name: r.actual for r in joint.collect()}
    assert len(together) == len(checks) and singly.items() <= together.items()


def test_references_to_orders_come_from_the_ledger(spark, t, monkeypatch):
    """The same counts with and without a ledger beside them, and no second grouping by order id with one."""
    alone, ledger = rules("QR011", "QR015", "QR018"), rules("QR029", "QR031")
    filled = {**t, "orders": t["orders"].where("order_id IS NOT NULL")}
    empty = {**t, "orders": t["orders"].limit(0)}
    # one NULL among the references leaves NOT IN unknown; without references every row violates it, a NULL too
    expected = {"null": (t, [0, 0, 0]), "filled": (filled, [1, 0, 0]), "empty": (empty, [4, 3, 1])}
    wanted = {name: counts(spark, tables, alone) for name, (tables, _) in expected.items()}
    monkeypatch.setattr(q, "_reference_rules", None)  # not called
    for name, (tables, numbers) in expected.items():
        got = counts(spark, tables, alone + ledger)
        assert [got[r] for r in ("QR011", "QR015", "QR018")] == numbers == [wanted[name][r.rule_id] for r in alone]


def shuffled_mb(spark):
    """Shuffle files on disk."""
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    files = [os.path.join(at, f) for folder in folders for at, _, names in os.walk(folder) for f in names if f.startswith("shuffle_")]
    return sum(os.path.getsize(f) for f in files if os.path.exists(f)) / 1e6


@pytest.fixture()
def wide(spark, tmp_path):
    """20,000 shipments of 5000 orders with about 10 MB of text, and settings that shuffle every join."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = F.concat(*[F.sha2(F.concat(F.lit(k), F.col("id").cast("string")), 512) for k in ("a", "b", "c", "d")])
    cancelled = F.when(F.col("id") % 40 == 7, "Cancelled").otherwise("Completed")
    orders = spark.range(5000).select(F.col("id").alias("order_id"), cancelled.alias("status"))
    shipments = spark.range(20000).select(F.col("id").alias("shipment_id"), (F.col("id") % 5000).alias("order_id"), text.alias("note"))
    for name, df in {"orders": orders, "shipments": shipments}.items():  # files, so that no join is derived from formulas
        df.write.parquet(f"{tmp_path}/{name}")
    t = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in ("orders", "shipments")}
    yield {**t, **{x: t["orders"].limit(0) for x in ("payments", "returns")}}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def direct_texts(t, rule, n=10):
    texts = q.violating_rows(t, rule, AS_OF).select(F.substring(F.to_json(F.struct("*")), 1, 500).alias("x"))
    return [r.x for r in texts.orderBy("x").limit(n).collect()]


def test_samples_shuffle_keys_and_no_whole_rows(spark, wide, monkeypatch):
    monkeypatch.setattr(q, "freed_shuffles", lambda spark: nullcontext())
    chosen, at = rules("QR029"), shuffled_mb(spark)
    results, _ = q.run_rules(spark, wide, AS_OF, "r", AT, chosen)
    results = spark.createDataFrame(results.collect(), results.schema)
    counted = shuffled_mb(spark)
    got = [r.failing_value for r in q.failure_samples(spark, wide, results, AS_OF, AT, chosen).collect()]
    assert counted > at and shuffled_mb(spark) - counted < 3  # 4096 of 20,000 rows are tried; all of them are 10 MB
    assert got == direct_texts(wide, chosen[0]) and len(got) == 10
    counted = shuffled_mb(spark)
    assert q.smallest_texts(spark, wide, chosen[0], AS_OF, 10, tried=3) == got  # too few: by keys and leads
    assert shuffled_mb(spark) - counted < 2


def test_counts_and_samples_leave_no_shuffles(spark, wide):
    at = shuffled_mb(spark)
    results, _ = q.run_rules(spark, wide, AS_OF, "r", AT, rules("QR029", "QR015"))
    results = spark.createDataFrame(results.collect(), results.schema)
    assert q.failure_samples(spark, wide, results, AS_OF, AT, rules("QR029")).count() == 10
    assert shuffled_mb(spark) - at < 1  # the rows that were tried, not 10 MB


def test_samples_are_the_same_however_few_rows_are_tried(spark):
    """Nulls, keys and rows that come twice, keys of different lengths, and names that need quoting."""
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    n = range(60)
    orders = [(None if k % 11 == 0 else str(k % 45), f"c{k % 7}", "Cancelled" if k % 4 else "Returned", float(k), 1.0) for k in n]
    t = {
        "orders": df(orders, "order_id string, customer_id string, status string, order_total double, discount_amount double"),
        "order_items": df([(str(k % 50), f"p{k % 9}", 1.0 * k, 0.1) for k in n],
                          "order_id string, product_id string, line_total double, discount_pct double"),
        "shipments": df([(f"{{s{k}}}", None if k % 7 == 0 else str(k), None) for k in n], "`ship``ment.id` string, order_id string, note string"),
        "returns": df([(None if k % 3 else f"r{k}", str(k % 13) if k % 5 else None, f"p{k % 4}", "Approved", "2024-09-01") for k in n],
                      "return_id string, order_id string, product_id string, status string, return_date string"),
        "payments": df([(str(k), None if k % 2 else "Completed") for k in n], "order_id string, status string"),
        "customers": df([(f"c{k % 3 + 1}", f"x{k}") for k in range(5)] + [(None, "y")] * 3, "customer_id string, email string"),
        "product_reviews": df([(f"v{k}", f"c{k % 5}", f"p{k % 6}", k % 2 == 0) for k in n],
                              "review_id string, customer_id string, product_id string, verified_purchase boolean"),
    }
    t["orders"] = t["orders"].withColumn("order_date", F.lit("2024-05-01"))
    ids = ("QR001", "QR005", "QR011", "QR015", "QR018", "QR025", "QR026", "QR028", "QR029", "QR030", "QR031", "QR032", "QR033", "QR036")
    for rule in rules(*ids):
        want = direct_texts(t, rule, 7)
        for tried in (2, 4096) if rule.rule_id in ("QR001", "QR028", "QR036") else (2,):
            assert q.smallest_texts(spark, t, rule, AS_OF, 7, tried) == want, (rule.rule_id, tried)
