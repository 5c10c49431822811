import random

import pytest
from pyspark.sql import functions as F

from martloom.operators import aggregates as ag, joins as jn, ordering as od, windows as wn
from martloom.plans.lakehouse import lakehouse
from martloom.sources import sinks
from martloom.sources.tables import latest_order_date, retail_tables


def keys(spark, items):
    return spark.createDataFrame([(i,) for i in items], "k long")


@pytest.mark.parametrize(
    "left, right, expected",
    [
        ([1, 2, 3, None], [1, None], 0),
        ([1, 2, 3, None], [1], 2),
        ([1, 2, 3, None], [], 4),
        ([1, 1, 9, 9, 9], [1], 3),
        ([], [1], 0),
    ],
)
def test_not_in_with_nulls(spark, left, right, expected):
    got = jn.not_in(keys(spark, left), keys(spark, right), "k").first()[0]
    assert got == expected
    keys(spark, left).createOrReplaceTempView("l")
    keys(spark, right).createOrReplaceTempView("r")
    assert got == spark.sql("SELECT count(*) FROM l WHERE k NOT IN (SELECT k FROM r)").first()[0]


def test_anti_join_counts_null_keys(spark):
    left, right = keys(spark, [1, 2, 3, None]), keys(spark, [1, None])
    assert sorted(r.k or 0 for r in jn.missing(left, right, "k").collect()) == [0, 2, 3]
    assert [r.k for r in jn.existing(left, right, "k").collect()] == [1]


def test_attach_does_not_multiply(spark):
    base = keys(spark, [1, 2])
    sides = [
        spark.createDataFrame([(1, 5)] * 3, "k long, a long").groupBy("k").agg(F.sum("a").alias("a")),
        spark.createDataFrame([(1, 7)] * 2, "k long, b long").groupBy("k").agg(F.sum("b").alias("b")),
    ]
    got = jn.zero_fill(jn.attach(base, sides, "k"), ["a", "b"])
    assert sorted(map(tuple, got.collect())) == [(1, 15, 14), (2, 0, 0)]


def test_surplus_duplicates_counts_null(spark):
    df = keys(spark, [1, 1, 2, None])
    assert df.agg(ag.surplus_duplicates("k")).first()[0] == 2


def hot_rows(n=4000):
    """One key holds most of the rows, in shuffled order."""
    rng = random.Random(5)
    rows = [(1 if i % 5 else i % 7, i, rng.randint(-50, 50)) for i in range(n)]
    rng.shuffle(rows)
    return rows


def test_running_total_of_a_hot_key_matches_brute_force(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k long, t long, v long").repartition(6)
    got = {(r.k, r.t): r.so_far for r in wn.running_total(df, ["k"], [F.col("t").asc()], "v", "so_far").collect()}
    sums, expected = {}, {}
    for k, t, v in sorted(rows, key=lambda r: r[1]):
        sums[k] = sums.get(k, 0) + v
        expected[(k, t)] = sums[k]
    assert got == expected


def test_running_total_spreads_a_hot_key_over_slices(spark):
    df = spark.createDataFrame(hot_rows(), "k long, t long, v long")
    sliced = wn.ordered_slices(df, [F.col("k"), F.col("t")], 4)
    sizes = [r["count"] for r in sliced.groupBy(wn.SLICE).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 4000 * 0.5


def test_running_total_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 2), (None, 2, 3), (5, 1, 1)], "k long, t long, v long")
    got = sorted((r.k or 0, r.t, r.s) for r in wn.running_total(df, ["k"], [F.col("t").asc()], "v", "s").collect())
    assert got == [(0, 1, 2), (0, 2, 5), (5, 1, 1)]


def test_numbered_is_dense_and_ordered(spark):
    df = spark.createDataFrame([(i % 10, i) for i in range(500)], "a long, b long").repartition(5)
    got = wn.numbered(df, [F.desc("a"), F.asc("b")]).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 501))
    assert [(r.a, r.b) for r in got] == sorted(((i % 10, i) for i in range(500)), key=lambda x: (-x[0], x[1]))


@pytest.mark.parametrize("items", [[3.0], [1.0, 2.0], [5.0] * 50, [float(i * i % 97) for i in range(300)]])
def test_exact_percentiles(spark, items):
    df = spark.createDataFrame([(v,) for v in items], "x double")
    got = od.exact_percentiles(df, "x", [0.0, 0.5, 0.7, 0.9, 1.0]).first()
    want = df.agg(F.percentile("x", F.array(*[F.lit(p) for p in (0.0, 0.5, 0.7, 0.9, 1.0)]))).first()[0]
    assert list(got) == pytest.approx(want)


def test_exact_percentiles_of_nothing(spark):
    assert od.exact_percentiles(spark.createDataFrame([], "x double"), "x", [0.5]).first()[0] is None


def test_ordered_split(spark):
    df = spark.createDataFrame([(i,) for i in range(11)], "k long").repartition(3)
    first, rest = od.ordered_split(df, "k", 0.8)
    assert sorted(r.k for r in first.collect()) == list(range(8))
    assert sorted(r.k for r in rest.collect()) == [8, 9, 10]


def test_latest_by_key_breaks_ties_by_second_column(spark):
    rows = [("a", 1, "x", 10), ("a", 2, "x", 20), ("a", 2, "y", 30), ("b", 1, "z", 40)]
    df = spark.createDataFrame(rows, "k string, t long, id string, v long")
    assert sorted(map(tuple, wn.latest_by_key(df, "k", ["t", "id"]).collect())) == [("a", 2, "y", 30), ("b", 1, "z", 40)]


def test_first_per_group_keeps_all_columns(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(30)], "g long, v long")
    got = sorted(map(tuple, wn.first_per_group(df, ["g"], [F.asc("v")], 2).collect()))
    assert got == [(0, 0), (0, 3), (1, 1), (1, 4), (2, 2), (2, 5)]


def test_upserts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    assert sorted(map(tuple, sinks.upsert_rows(target, batch, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "C")]
    assert [r.k for r in sinks.insert_absent(target, batch, "k").collect()] == [3]
    updated = sinks.update_matched(target, batch, "k")
    assert sorted(map(tuple, updated.collect())) == [(1, "a"), (2, "B")]


def test_logged_run_records_failure(spark, tmp_path):
    log = str(tmp_path / "runs")
    with pytest.raises(RuntimeError):
        with sinks.logged_run(spark, log, "r", "step", "bronze") as run:
            run["rows"] = 3
            raise RuntimeError("boom " + "x" * 2000)
    row = spark.read.parquet(log).first()
    assert (row.status, row.rows_written, len(row.error_message)) == ("FAILED", 3, 1000)


def test_managed_table_chores(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS chores")
    spark.sql(f"CREATE TABLE IF NOT EXISTS chores.t (a INT) USING parquet LOCATION '{tmp_path}/t'")
    assert sinks.add_column_if_missing(spark, "chores.t", "b", "DOUBLE") is True
    assert sinks.add_column_if_missing(spark, "chores.t", "b", "DOUBLE") is False
    sinks.describe_tables(spark, {"chores.t": "it's a table"})
    assert spark.catalog.getTable("chores.t").description == "it's a table"
    spark.sql("DROP TABLE chores.t")


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS chores")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = sinks.write_bucketed(spark.range(50).withColumnRenamed("id", "order_id"), "chores.orders_b", "order_id", 4)
        lines = spark.range(200).select((F.col("id") % 50).alias("order_id"), F.col("id").alias("line"))
        b = sinks.write_bucketed(lines, "chores.lines_b", "order_id", 4)
        joined = jn.match(b, a, "order_id").groupBy("order_id").agg(F.count("*").alias("n"))
        assert joined.count() == 50
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE IF EXISTS chores.orders_b")
        spark.sql("DROP TABLE IF EXISTS chores.lines_b")


def test_hot_join_key_keeps_every_row(spark):
    facts = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    dims = spark.range(9000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    got = jn.enrich(facts, dims, "k").agg(F.count("*").alias("n"), F.count_if(F.col("k") == 7).alias("hot"), F.count("d").alias("d")).first()
    assert (got.n, got.hot, got.d) == (9000, 3001, 9000)


def test_distinct_counts_equal_count_distinct_without_copies(spark):
    pick = random.Random(7)
    rows = [
        (pick.choice([None, "hot", "hot", "hot", "a", "b"]), pick.choice([None, 1]), pick.choice([None, *range(9)]),
         pick.choice([None, *range(4)]), pick.choice([None, "x", "y"]), pick.choice([None, 3, -2])) for _ in range(400)
    ] + [("null values", 1, None, None, "x", None), ("never live", 2, 1, 1, "x", 5)]
    df = spark.createDataFrame(rows, "g string, h int, o int, c int, s string, v long")
    live = F.col("s") == "y"
    got = ag.with_distinct(
        df, ["g", "h"], "o", {"orders": None, "live_orders": live}, others={"buyers": ("c", None), "live_buyers": ("c", live)},
        totals={"value": F.sum("v"), "n": ag.count_when(live)},
    )
    want = df.groupBy("g", "h").agg(
        F.count_distinct("o").alias("orders"), ag.distinct_when(live, "o").alias("live_orders"),
        F.count_distinct("c").alias("buyers"), ag.distinct_when(live, "c").alias("live_buyers"),
        F.sum("v").alias("value"), ag.count_when(live).alias("n"),
    )
    names = want.columns
    assert sorted(map(str, got.select(names).collect())) == sorted(map(str, want.collect()))
    assert got.select(names).dtypes == want.dtypes
    assert "Expand" not in got._jdf.queryExecution().toString()
    assert ag.with_distinct(df.limit(0), ["g"], "o", {"n": None}, others={"m": ("c", None)}).count() == 0


@pytest.mark.parametrize("table", ["daily_sales_summary", "store_performance"])
def test_reports_with_several_distinct_counts_have_no_expand(spark, small, table):
    made = lakehouse(spark, retail_tables(spark, small), latest_order_date(spark, small))[table]
    assert "Expand" not in made._jdf.queryExecution().toString()


@pytest.mark.parametrize("digits, sortable", [(1, 3), (3, 10_000), (2, 1)])
def test_first_by_digest_equals_sorting(spark, digits, sortable):
    pick = random.Random(3)
    # one digest shared by many rows, digests that differ only at their end, a NULL digest and NULL ties
    rows = [("ab" * 4, i, None) for i in range(40)] + [(f"abababa{i:x}", 0, "t") for i in range(9)]
    rows += [(f"{pick.getrandbits(32):08x}", i, "u") for i in range(120)] + [(None, 1, "n"), ("ab" * 4, None, "s")]
    df = spark.createDataFrame(rows, "key string, a int, b string").repartition(5)
    ordered = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or ""))
    for n in (-1, 0, 1, 30, 60, 89, 170, 500):
        got = od.first_by_digest(df, "key", ["a", "b"], n, digits=digits, sortable=sortable)
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, ordered[: max(n, 0)])), n
    plan = got._jdf.queryExecution().toString()
    assert "Sort" not in plan and "Window" not in plan
    assert od.first_by_digest(df.limit(0), "key", ["a", "b"], 3).count() == 0
