import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.operators import ordering as od, selection


def expected(values, rank):
    ordered = sorted(values)
    value = ordered[rank - 1]
    return (value, sum(v < value for v in values), values.count(value))


RNG = random.Random(8)
CASES = {
    "double": [RNG.gauss(0, 1) * 10 ** RNG.randint(-30, 30) for _ in range(3000)],
    "bigint": [RNG.choice([7, 7, 7, RNG.randint(-(2**63), 2**63 - 1), 2**62 + RNG.randint(0, 9)]) for _ in range(3000)],
    "string": [RNG.choice(["", "z", "é", "\U0001f600", f"k{RNG.randint(0, 500)}"]) for _ in range(3000)],
    "date": [dt.date(2020, 1, 1) + dt.timedelta(RNG.randint(0, 900)) for _ in range(3000)],
    "decimal(20,4)": [Decimal(RNG.randint(-(10**15), 10**15)).scaleb(-4) for _ in range(3000)],
}


@pytest.mark.parametrize("kind", CASES)
def test_ranks_equal_a_sort_through_many_rounds(spark, kind):
    values = CASES[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, f"x {kind}").repartition(5)
    ranks = [1, 2, 700, 1500, 1501, 2999, 3000]
    got = selection.at_ranks(df, "x", ranks, 3000, sortable=5, sampled=40)
    assert got == {r: expected(values, r) for r in ranks}


def test_one_value_holds_nearly_all_rows(spark):
    values = [5.0] * 4000 + [float(i) for i in range(10)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    got = selection.at_ranks(df, "x", [3, 6, 2000, 4005, 4010], len(values), sortable=3, sampled=20)
    assert got == {r: expected(values, r) for r in (3, 6, 2000, 4005, 4010)}


def test_nan_and_infinity_come_last(spark):
    values = [float("nan")] * 40 + [math.inf] * 20 + [-math.inf] * 20 + [-0.0, 0.0] * 30 + [1.5] * 7
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    got = selection.at_ranks(df, "x", [1, 21, 80, 81, 88, 107, 108, 147], len(values), sortable=2, sampled=9)
    assert [got[r].value for r in (1, 21, 80, 81, 88, 107)] == [-math.inf, 0.0, 0.0, 1.5, math.inf, math.inf]
    assert all(math.isnan(got[r].value) and got[r][1:] == (107, 40) for r in (108, 147))


def test_ranks_that_do_not_exist_are_an_error(spark):
    with pytest.raises(ValueError):
        selection.at_ranks(spark.createDataFrame([(1,), (2,)], "x int"), "x", [3], 3)


def test_percentiles_by_rounds_equal_sparks(spark):
    values = [RNG.lognormvariate(0, 3) for _ in range(2000)] + [1.0] * 900
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(6)
    points = [0.0, 0.25, 0.5, 0.77, 0.9, 1.0]
    want = df.agg(F.percentile("x", F.array(*[F.lit(p) for p in points]))).first()[0]
    assert list(od.exact_percentiles(df, "x", points, sortable=20).first()) == pytest.approx(want)


def test_percentiles_write_no_table(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a table was written")

    monkeypatch.setattr("martloom.operators.windows.materialize", refuse)
    assert od.exact_percentiles(spark.range(1, 102), "id", [0.5, 0.9]).first()[:] == (51.0, 91.0)


@pytest.mark.parametrize("fraction", [0.0, 0.02, 0.1, 0.35, 0.6, 0.8, 1.0])
def test_split_with_nulls_and_ties_is_exact(spark, fraction):
    rows = [(None if i < 20 else 1 if i < 120 else i, i, {"m": i}) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, v long, m map<string,int>").repartition(4)
    first, rest = od.ordered_split(df, "k", fraction, sortable=10)
    cut = int(200 * fraction)
    assert sorted(r.v for r in first.collect()) == list(range(cut))
    assert sorted(r.v for r in rest.collect()) == list(range(cut, 200))


def test_split_is_a_filter_where_keys_differ(spark, monkeypatch):
    monkeypatch.setattr(od, "numbered", lambda *_: pytest.fail("rows were numbered"))
    df = spark.range(3000).select(F.format_string("c%05d", "id").alias("k"))
    first, rest = od.ordered_split(df, "k", 0.8, sortable=50)
    assert (first.count(), first.agg(F.max("k")).first()[0]) == (2400, "c02399")
    assert (rest.count(), rest.agg(F.min("k")).first()[0]) == (600, "c02400")
