import datetime as dt

import pytest
from pyspark.sql import functions as F

from martloom.streaming import live_sales as ls, managed
from martloom.streaming.events import EVENT_SCHEMA, land
from martloom.streaming.expectations import ORDER_EVENT_RULES, expect_or_drop

T0 = dt.datetime(2024, 1, 1, 23, 58)


def event(n, order, minutes, total=10.0, discount=1.0, channel="web", customer="c1", event_id=...):
    return (f"e{n}" if event_id is ... else event_id, order, customer, "s1", T0 + dt.timedelta(minutes=minutes), channel, total,
            discount, 0.5, "Completed", "test")


EVENTS = [
    event(1, "o1", 0), event(2, "o2", 0, 20.0), event(3, "o1", 5, 12.0),  # o1 moves to the next day
    event(4, "o3", 1, channel="store"), event(5, "o3", 0.5, 99.0, channel="store"),  # older after newer
    event(6, "o4", 2, customer=None), event(7, "o2", 0, 25.0, channel="mobile"),  # o2 changes channel
    event(1, "o1", 0),  # replayed
]


def frame(spark, rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def state(live):
    silver = sorted(map(str, live.silver().drop("_microbatch_id", "_processed_at").collect()))
    gold = sorted(map(str, live.gold().drop("last_updated").collect()))
    bronze = sorted(r.event_id for r in live.bronze().collect())
    return silver, gold, bronze


@pytest.fixture(scope="module")
def one_batch(spark, tmp_path_factory):
    live = ls.LiveSales(spark, str(tmp_path_factory.mktemp("one")))
    live.process(frame(spark, EVENTS), 0)
    return state(live)


def test_one_batch(one_batch):
    silver, gold, bronze = one_batch
    assert bronze == ["e1", "e2", "e3", "e4", "e5", "e6", "e7"]
    assert len(silver) == 4 and len(gold) == 4


@pytest.mark.parametrize("groups", [[[0, 1, 3, 5], [2, 4, 6, 7]], [[0], [1], [3, 4], [2, 6], [5, 7]], [[4, 2], [0, 1, 7], [6, 3, 5]]])
def test_any_split_and_order_gives_the_same_tables(spark, tmp_path, one_batch, groups):
    live = ls.LiveSales(spark, str(tmp_path))
    for i, members in enumerate(groups):
        live.process(frame(spark, [EVENTS[j] for j in members]), i)
    assert state(live) == one_batch


def test_replay_changes_nothing_and_a_retry_repairs_a_half_done_batch(spark, tmp_path, one_batch):
    live = ls.LiveSales(spark, str(tmp_path))
    live.process(frame(spark, EVENTS[:2]), 0)
    # the second batch fails after silver is written and before gold is
    refresh, live._refresh_gold = live._refresh_gold, lambda keys: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        live.process(frame(spark, EVENTS[2:]), 1)
    failed = live.metrics().where("microbatch_id = 1").first()
    assert (failed.status, failed.error_message) == ("FAILED", "lost")
    live._refresh_gold = refresh
    live.process(frame(spark, EVENTS[2:]), 1)
    assert state(live) == one_batch
    live.process(frame(spark, EVENTS[2:]), 1)
    assert state(live) == one_batch
    assert live.metrics().where("microbatch_id = 1").first().status == "SUCCEEDED"
    assert live.metrics().count() == 2


def test_minutes_left_empty_disappear(spark, tmp_path):
    live = ls.LiveSales(spark, str(tmp_path))
    live.process(frame(spark, [event(1, "o1", 0)]), 0)
    live.process(frame(spark, [event(2, "o1", 10)]), 1)
    assert [r.event_minute for r in live.gold().collect()] == [T0 + dt.timedelta(minutes=10)]
    assert live.silver().count() == 1


def test_stale_event_is_kept_in_bronze_only(spark, tmp_path):
    live = ls.LiveSales(spark, str(tmp_path))
    live.process(frame(spark, [event(1, "o1", 5)]), 0)
    live.process(frame(spark, [event(2, "o1", 1, 77.0)]), 1)
    assert live.bronze().count() == 2 and live.silver().first().order_total == 10.0
    assert live.metrics().where("microbatch_id = 1").first().silver_rows == 0


def test_available_now_resumes(spark, tmp_path):
    landing, live = str(tmp_path / "in"), ls.LiveSales(spark, str(tmp_path / "live"))
    land(frame(spark, EVENTS[:3]).coalesce(1), landing)
    live.run(landing)
    land(frame(spark, EVENTS[3:]).coalesce(1), landing)
    live.run(landing)
    live.run(landing)
    assert [(r.microbatch_id, r.input_rows) for r in live.metrics().orderBy("microbatch_id").collect()] == [(0, 3), (1, 5)]
    assert live.silver().count() == 4


BAD = [
    event(0, "x", 0, event_id=None), event(0, "x", 0, event_id=""), event(9, "x", 0, discount=11.0), event(9, "x", 0, total=0.0, discount=0.0),
    event(9, "x", 0, channel="kiosk"), ("e9", "x", "c", "s", None, "web", 1.0, 0.0, 0.0, "s", "t"), (None,) * 11,
]


def test_expectations_drop_unknown_outcomes(spark):
    df = spark.createDataFrame(BAD + [event(10, "ok", 0)], "event_id string, order_id string, customer_id string, store_id string,"
                               " event_time timestamp, channel string, order_total double, discount_amount double,"
                               " tax_amount double, status string, source string")  # fmt: skip
    assert [r.event_id for r in expect_or_drop(df, ORDER_EVENT_RULES).collect()] == ["e10"]


def test_managed_path(spark, tmp_path):
    landing = str(tmp_path / "in")
    land(frame(spark, [EVENTS[0], EVENTS[1], event(9, "x", 0, channel="kiosk")]), landing)
    first = managed.run(spark, landing, str(tmp_path / "m"))
    assert [(r.channel, r.order_count, r.revenue) for r in first.collect()] == [("web", 2, 28.0)]
    land(frame(spark, [EVENTS[3]]), landing)
    again = managed.run(spark, landing, str(tmp_path / "m"))
    assert sorted((r.channel, r.order_count) for r in again.collect()) == [("store", 1), ("web", 2)]


def test_hourly_slots(spark, tmp_path, one_batch):
    live = ls.LiveSales(spark, str(tmp_path), grain="hour")
    live.process(frame(spark, EVENTS), 0)
    assert live.gold().drop("last_updated", "event_slot").count() == 4
    assert {r.event_slot for r in live.silver().select(F.col("event_slot")).distinct().collect()} == {"2024-01-01-23", "2024-01-02-00"}
