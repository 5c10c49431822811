import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.functions import dates, labels, money as m, text as tx


def values(df, column="v"):
    return [r[column] for r in df.collect()]


def one_column(spark, items, kind, name="x"):
    return spark.createDataFrame([(i,) for i in items], f"{name} {kind}")


def test_bands_at_each_cut_and_one_step_either_side(spark):
    df = one_column(spark, [0, 499, 500, 501, 1999, 2000, 4999, 5000, None], "int")
    got = values(df.select(labels.clv_tier(F.col("x")).alias("v")))
    assert got == ["Bronze", "Bronze", "Silver", "Silver", "Silver", "Gold", "Gold", "Platinum", "Bronze"]
    df = one_column(spark, [180, 181, 365, 366], "int")
    assert values(df.select(labels.recency_risk(F.col("x")).alias("v"))) == ["Low", "Medium", "Medium", "High"]
    df = one_column(spark, [-1, 0, 1, 10, 11, 50, 51, 200, 201], "int")
    assert values(df.select(labels.stock_status(F.col("x")).alias("v"))) == [
        "Out of Stock", "Out of Stock", "Critical", "Critical", "Low", "Low", "Normal", "Normal", "Overstocked",
    ]
    df = one_column(spark, [3.4, 3.5, 4.49, 4.5], "double")
    assert values(df.select(labels.supplier_tier(F.col("x")).alias("v"))) == ["Tier3", "Tier2", "Tier2", "Tier1"]
    df = one_column(spark, [0.39, 0.4, 0.69, 0.7], "double")
    got = values(df.select(labels.churn_band(F.col("x")).alias("v")))
    assert got == ["Low (<40%)", "Medium (40-70%)", "Medium (40-70%)", "High (>=70%)"]


def test_labels_and_ranks(spark):
    df = one_column(spark, [0, 1, 9, None], "int")
    assert values(df.select(labels.label_lookup(F.col("x"), {0: "a", 1: "b"}).alias("v"))) == ["a", "b", "Unknown", "Unknown"]
    df = one_column(spark, ["VIP", "Premium", "Standard", "Basic", None], "string")
    assert values(df.select(labels.segment_score(F.col("x")).alias("v"))) == [4, 3, 2, 1, 1]


def test_cents_round_half_up_for_decimals_and_doubles(spark):
    df = one_column(spark, [Decimal("1.005"), Decimal("1.004"), Decimal("2.675")], "decimal(10,3)")
    assert values(df.select(m.cents("x").alias("v"))) == [101, 100, 268]
    df = one_column(spark, [0.1 + 0.2, 123456789.99, -5.25], "double")
    assert values(df.select(m.cents("x").alias("v"))) == [30, 12345678999, -525]


def test_divide_and_percent(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (4, 3), (1, 0)], "a long, b long")
    assert values(df.select(m.divide(F.col("a"), F.col("b")).alias("v"))) == [3, -3, 1, None]
    df = spark.createDataFrame([(1, 3), (2, 3), (0, 0)], "a long, b long")
    assert values(df.select(m.pct(F.col("a"), F.col("b")).alias("v"))) == [33.33, 66.67, None]


def test_net_revenue_floor_and_cancelled(spark):
    rows = [("Completed", 10000, 1000, 500), ("Completed", 1000, 0, 5000), ("Cancelled", 1000, 0, 0)]
    df = spark.createDataFrame(rows, "s string, g long, d long, r long")
    got = values(df.select(m.net_revenue(F.col("s"), F.col("g"), F.col("d"), F.col("r")).alias("v")))
    assert got == [8500, 0, 0]


def test_exact_line_discount_sum(spark):
    # three lines of 0.05 at 10%: rounding each would lose half of the discount
    df = spark.createDataFrame([(0.05, 0.1)] * 3, "line_total double, discount_pct double")
    assert df.agg(m.units_to_cents(F.sum(m.line_discount_units()))).first()[0] == 2


def test_rates_are_not_rounded(spark):
    df = spark.createDataFrame([(1_000_000.0, 0.33333), (10.0, 0.123456789)], "line_total double, discount_pct double")
    assert values(df.select(m.line_net().alias("v"))) == [66_667_000, 877]
    assert df.limit(1).agg(m.units_to_cents(F.sum(m.line_discount_units()))).first()[0] == 33_333_000


def test_halves_of_cents_and_what_is_no_amount(spark):
    df = one_column(spark, [1.005, -0.005, -1.005, None], "double")
    assert values(df.select(m.cents("x").alias("v"))) == [101, -1, -101, None]
    for bad in (float("nan"), float("inf"), 1e300):
        with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
            one_column(spark, [bad], "double").select(m.cents("x")).collect()


def test_dates(spark):
    df = one_column(spark, ["2024-02-29", "2024-02-30", "junk", None], "string")
    assert values(df.select(dates.as_date("x").alias("v"))) == [dt.date(2024, 2, 29), None, None, None]
    df = one_column(spark, [dt.date(2024, 5, 3), dt.date(2024, 5, 2)], "date")
    assert values(df.select(dates.since("x", dt.date(2024, 8, 1), 90).alias("v"))) == [True, False]
    assert values(df.select(dates.date_key("x").alias("v"))) == [20240503, 20240502]


def test_search_terms(spark):
    df = one_column(spark, ["How do I return the BIG red_box 1234 now, please please again more terms here?", "a b c", ""], "string")
    got = values(df.select(tx.search_terms(F.col("x")).alias("v")))
    assert got == [["return", "red_box", "1234", "please", "please", "again", "more", "terms"], [], []]


def test_keywords_are_whole_words_unless_phrases(spark):
    df = one_column(spark, ["passing", "pass the test", "to pass", "épass", "pass_it", "real-timely"], "string")
    assert values(df.select(tx.has_keyword(F.col("x"), "pass").alias("v"))) == [False, True, True, False, False, False]
    assert values(df.select(tx.has_any_keyword(F.col("x"), ["real-time", "test"]).alias("v"))) == [
        False, True, False, False, False, True,
    ]


def test_extractors(spark):
    df = one_column(spark, ["who is c0000042?", "C123", "last 3 weeks", "2 months of DOC00012, DOC00345", ""], "string")
    assert values(df.select(tx.customer_id_in(F.col("x")).alias("v"))) == ["C0000042", None, None, None, None]
    assert values(df.select(tx.period_days(F.col("x")).alias("v"))) == [7, 7, 21, 60, 7]
    assert values(df.select(tx.document_ids(F.col("x")).alias("v")))[3] == "DOC00012,DOC00345"
