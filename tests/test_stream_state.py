"""Indexes and sums of the order stream: what they read, and that failures and repeats leave no trace."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from martloom.operators import windows
from martloom.session import no_rows
from martloom.streaming import key_index, live_sales as ls, managed
from martloom.streaming.events import land
from martloom.streaming.key_index import KeyIndex
from tests.test_streaming import event, frame


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "k string")


def found(index, df, **kw):
    return sorted((r.k, r.v) for r in index.find(df, **kw).collect())


def test_index_keeps_the_latest_value_and_survives_repeats(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "i"), "k", "v", buckets=4, fold_after=2)
    rows = lambda *kv: spark.createDataFrame(list(kv), "k string, v string")
    assert found(index, keys(spark, "a", None)) == []
    index.put(rows(("a", "1"), ("b", "1"), (None, "1")), 0)
    index.put(rows(("a", "2")), 1)
    index.put(rows(("a", "2")), 1)
    assert found(index, keys(spark, "a", "b", "c", None)) == [("a", "2"), ("b", "1")]
    assert found(index, keys(spark, "a"), but=1) == [("a", "1")]
    for batch in range(2, 9):
        index.fold(batch)
        index.put(rows((f"n{batch}", "x"), ("b", str(batch))), batch)
    assert found(index, keys(spark, "a", "b", "n2", "n8")) == [("a", "2"), ("b", "8"), ("n2", "x"), ("n8", "x")]
    for folder in glob.glob(f"{tmp_path}/i/bucket=*"):
        assert len(glob.glob(f"{folder}/batch=*")) <= 2 * index.fold_after + 1


def test_fold_that_fails_before_the_old_entries_go(spark, tmp_path, monkeypatch):
    index = KeyIndex(spark, str(tmp_path / "i"), "k", "v", buckets=1, fold_after=2)
    for batch in range(4):
        index.put(spark.createDataFrame([("a", str(batch)), (f"n{batch}", "x")], "k string, v string"), batch)
    monkeypatch.setattr(key_index, "delete_path", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        index.fold(4)
    monkeypatch.undo()
    everything = keys(spark, "a", "n0", "n1", "n2", "n3")
    want = [("a", "3"), ("n0", "x"), ("n1", "x"), ("n2", "x"), ("n3", "x")]
    assert found(index, everything) == want
    index.fold(4)
    assert found(index, everything) == want and len(glob.glob(f"{tmp_path}/i/bucket=0/batch=*")) == 1


def test_a_look_up_opens_the_buckets_of_its_keys_only(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "i"), "k", buckets=16)
    index.put(keys(spark, *[f"k{n}" for n in range(200)]), 0)
    one = keys(spark, "k7")
    (bucket,) = index.buckets_of(one)
    assert {f.split("bucket=")[1].split("/")[0] for f in index.read([bucket]).inputFiles()} == {str(bucket)}
    assert index.find(one).count() == 1


def test_deltas_added_twice_count_once(spark, tmp_path):
    schema = key_index.state_schema("g string", ("n", "x"), "p string")


    def add(rows, batch):
        delta = spark.createDataFrame(rows, "g string, p string, n long, x long")
        delta = delta.withColumn("updated", F.current_timestamp())
        changed = key_index.add_deltas(spark, str(tmp_path / "s"), schema, delta, ["g"], ["n", "x"], ["p"], batch)
        return [(r.g, r.n, r.x, r.before_n) for r in changed.collect()]

    state = lambda: sorted((r.g or "", r.n, r.x) for r in spark.read.schema(schema).parquet(str(tmp_path / "s")).collect())
    first = [("a", "1", 2, 20), (None, "1", 1, 5), ("b", "2", 1, 1)]
    for _ in range(2):
        assert len(add(first, 0)) == 3
    assert state() == [("", 1, 5), ("a", 2, 20), ("b", 1, 1)]
    leave = [("a", "1", -2, -20)]
    assert add(leave, 5) == add(leave, 5) == [("a", 0, 0, 2)]
    assert add([(None, "1", 1, 1)], 6) == [(None, 2, 6, 1)]
    assert state() == [("", 2, 6), ("b", 1, 1)]  # the emptied sum went with the next batch


def recomputed(live):
    """Silver and KPIs from all events that the stream has taken."""
    silver = ls.silver_orders(live.bronze(), F.current_timestamp())
    gold = ls.minute_kpis(silver, F.current_timestamp()).drop("last_updated")
    drop = ("_microbatch_id", "_processed_at")
    return sorted(map(str, silver.drop(*drop).collect())), sorted(map(str, gold.collect()))


def written(live):
    silver = live.silver().drop("_microbatch_id", "_processed_at")
    gold = live.gold().drop("last_updated", "event_slot")
    return sorted(map(str, silver.collect())), sorted(map(str, gold.collect()))


STEPS = ["_add_to_bronze", "_plan_changes", "_add_to_sums", "_refresh_gold"]


def test_moves_late_rows_and_failures_after_every_write(spark, tmp_path):
    draw = random.Random(11)
    live = ls.LiveSales(spark, str(tmp_path))
    number = 0
    for batch in range(5):
        rows = []
        for _ in range(draw.randint(4, 9)):
            number += 1
            # no two events of an order at the same time, so the latest one is the same however batches are cut
            rows.append(event(number, f"o{draw.randint(1, 8)}", draw.choice((0, 1, 5, 2000)) + number / 1000, float(draw.randint(5, 90)),
                              channel=draw.choice(("web", "store")), customer=draw.choice(("c1", "c2", None))))
        rows.append(rows[0])
        if batch:
            step = STEPS[batch % len(STEPS)]
            whole = getattr(live, step)

            def broken(*args, whole=whole):
                whole(*args)
                raise RuntimeError("lost")

            setattr(live, step, broken)
            with pytest.raises(RuntimeError):
                live.process(frame(spark, rows), batch)
            setattr(live, step, whole)
        live.process(frame(spark, rows), batch)
    assert written(live) == recomputed(live)
    assert not glob.glob(f"{tmp_path}/work") and len(glob.glob(f"{tmp_path}/changes/batch=*")) == 1


def test_a_batch_reads_no_bronze_and_only_the_slots_of_its_orders(spark, tmp_path):
    live = ls.LiveSales(spark, str(tmp_path))
    days = 24 * 60
    live.process(frame(spark, [event(1, "o1", 0), event(2, "o2", 10 * days), event(3, "o3", 20 * days)]), 0)
    slots = {r.order_id: r.event_slot for r in live.silver().collect()}
    # whatever is read of these files is an error
    broken = glob.glob(f"{tmp_path}/bronze/_microbatch_id=0/*.parquet") + glob.glob(f"{tmp_path}/*/event_slot={slots['o3']}/**/*.parquet", recursive=True)
    assert len(broken) >= 4
    for name in broken:
        os.unlink(os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc"))
        with open(name, "wb") as out:
            out.write(b"not a table")
    live.process(frame(spark, [event(4, "o1", 10 * days + 1), event(1, "o1", 0)]), 1)
    now = ls.read_parts(spark, str(tmp_path / "silver"), ls.SILVER_SCHEMA, [f"event_slot={slots[o]}" for o in ("o1", "o2")])
    assert sorted((r.order_id, r.event_slot) for r in now.collect()) == [("o1", slots["o2"]), ("o2", slots["o2"])]
    assert live.metrics().where("microbatch_id = 1").first().bronze_rows == 1


def test_tables_from_before_the_indexes_are_adopted(spark, tmp_path):
    old = ls.LiveSales(spark, str(tmp_path))
    old.process(frame(spark, [event(1, "o1", 0), event(2, "o2", 0, customer="c2")]), 0)
    for path in (old.events.path, old.slots.path, *(old.paths[n] for n in ("changes", "totals", "customers"))):
        ls.delete_path(spark, path)
    live = ls.LiveSales(spark, str(tmp_path))
    live.process(frame(spark, [event(3, "o1", 5, 44.0), event(2, "o2", 0, customer="c2")]), 1)
    assert written(live) == recomputed(live) and live.bronze().count() == 3


def test_managed_kpis_of_three_runs_equal_one_pass(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "m")
    runs = [
        [event(1, "o1", 0), event(2, "o2", 0, 20.0), event(3, "o3", 1, channel="store")],
        [event(4, "o4", 3000, customer="c2"), event(5, "o5", 0, 7.0, customer="c2"), event(6, "o6", 1, channel="store", customer=None)],
        [event(7, "o7", -3000), event(8, "o1", 0, 12.0), event(9, "x", 0, channel="kiosk")],  # a row two days late
    ]
    for rows in runs:
        land(frame(spark, rows), landing)
        kpis = managed.run(spark, landing, root)
    silver = spark.read.schema(managed._silver_schema()).parquet(f"{root}/orders_silver_stream")
    want = managed.live_sales_minute(silver)
    assert sorted(map(str, kpis.select(want.columns).collect())) == sorted(map(str, want.collect())) and kpis.count() == 4
    last = {r.event_slot for r in ls.read_or_empty(spark, f"{root}/totals", ls.TOTAL_SCHEMA).where("batch = 2").collect()}
    assert len(last) == 2
    # the last batch again, as after a failure
    again = silver.where("event_id IN ('e7', 'e8')")
    managed.fold_minutes(spark, root, again, 2)
    now = ls.read_or_empty(spark, f"{root}/live_sales_minute", ls.GOLD_SCHEMA).select(want.columns)
    assert sorted(map(str, now.collect())) == sorted(map(str, want.collect()))


def test_whole_rows_of_a_batch_are_sorted_only_where_an_id_comes_twice(spark, tmp_path, monkeypatch):
    live = ls.LiveSales(spark, str(tmp_path))
    compared = []
    whole = ls.latest_by_key
    monkeypatch.setattr(ls, "latest_by_key", lambda df, *args: compared.append(sorted(str(r.event_id) for r in df.collect())) or whole(df, *args))
    rows = [event(n, f"o{n}", n) for n in range(1, 6)]
    live.process(spark.createDataFrame(rows, "event_id string, " + ls.SILVER_SCHEMA.split(", net_revenue")[0] + ", status string, source string"), 0)
    assert compared == [] and live.bronze().count() == 5
    schema = live.bronze().drop("_ingestion_ts", "_microbatch_id").schema
    twice = [event(6, "o6", 1), event(7, "o7", 1, 5.0), event(7, "o7", 2, 6.0), event(0, "o8", 1, event_id=None), event(0, "o8", 3, event_id=None)]
    live.process(spark.createDataFrame(twice, schema), 1)
    assert compared == [["None", "None", "e7", "e7"]]
    got = sorted((str(r.event_id), r.order_total, r.event_time) for r in live.bronze().where("_microbatch_id = 1").collect())
    want = [twice[i] for i in (4, 0, 2)]
    assert got == [(str(r[0]), r[6], r[4]) for r in want]


def test_latest_of_many_equals_latest_by_key(spark):
    draw = random.Random(5)
    pick = lambda *values: draw.choice((None, *values))
    rows = [(pick("a", "b", "", "c"), pick(0.0, -0.0, 1.5, float("nan")), pick("x", "y"), pick(1, 2)) for _ in range(300)]
    rows += [("alone", None, None, None), ("alone", None, None, 1)]
    df = spark.createDataFrame(rows, "k string, t double, e string, v int")
    got, want = (sorted(map(str, f(df, "k", ["t", "e"]).collect())) for f in (windows.latest_of_many, windows.latest_by_key))
    assert got == want and len(got) == 6
    # what is read first is grouped by hash: the sort comes after the rows have been left out
    plan = windows.latest_of_many(df, "k", ["t", "e"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortAggregate") < plan.index("LeftSemi") < plan.index("HashAggregate")


def test_an_index_without_entries_costs_no_shuffle(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "i"), "k")
    rows = keys(spark, "a", "b", None)
    fresh = ls.insert_absent(index.known(rows), rows, "k")
    assert "Exchange" not in fresh._jdf.queryExecution().executedPlan().toString() and fresh.count() == 3
    assert no_rows(spark, ls.BRONZE_SCHEMA).collect() == [] and [f.dataType for f in no_rows(spark, ls.GOLD_SCHEMA).schema] == [
        f.dataType for f in spark.createDataFrame([], ls.GOLD_SCHEMA).schema
    ]
    index.put(rows, 0)
    assert [r.k for r in ls.insert_absent(index.known(rows, but=0), rows, "k").orderBy("k").collect()] == [None, "a", "b"]
    assert [r.k for r in ls.insert_absent(index.known(rows), rows, "k").collect()] == [None]


def many_days(n):
    return [event(i, f"o{i}", i * 1440 + i % 3, 10.0 + i, customer=("c1", "c2", None)[i % 3], channel=("web", "store")[i % 2]) for i in range(n)]


def test_a_batch_of_many_days_writes_one_folder_for_each_and_reads_its_rows_three_times(spark, tmp_path, monkeypatch):
    landing, root = str(tmp_path / "in"), str(tmp_path / "m")
    land(frame(spark, many_days(40)).coalesce(1), landing)
    taken, whole = [], managed.fold_minutes

    def counted(session, place, batch, batch_id):
        taken.append((batch.columns, session.sparkContext.accumulator(0)))

        def seen(rows):
            for part in rows:
                taken[-1][1].add(part.num_rows)
                yield part

        whole(session, place, batch.mapInArrow(seen, batch.schema), batch_id)

    monkeypatch.setattr(managed, "fold_minutes", counted)
    kpis = managed.run(spark, landing, root)
    silver = spark.read.schema(managed._silver_schema()).parquet(f"{root}/orders_silver_stream")
    want = managed.live_sales_minute(silver)
    assert sorted(map(str, kpis.select(want.columns).collect())) == sorted(map(str, want.collect())) and kpis.count() == 40
    # one folder for each day that has known customers: no folders within it
    folders = {os.path.dirname(f) for f in glob.glob(f"{root}/{ls.CUSTOMERS}/**/*.parquet", recursive=True)}
    assert len(folders) == 27 and {os.path.dirname(f) for f in folders} == {f"{root}/{ls.CUSTOMERS}"}
    (columns, rows), = taken
    assert set(columns) == set(managed.KPI_COLUMNS) and rows.value <= 3 * 40


def test_counts_in_eight_folders_for_each_day_are_adopted(spark, tmp_path, monkeypatch):
    landing, root = str(tmp_path / "in"), str(tmp_path / "m")
    land(frame(spark, many_days(6)), landing)
    managed.run(spark, landing, root)
    counts = spark.read.schema(ls.CUSTOMER_SCHEMA).parquet(f"{root}/{ls.CUSTOMERS}")
    bucket = F.pmod(F.xxhash64("event_minute", "channel"), F.lit(8)).cast("int")
    counts.withColumn("kpi_bucket", bucket).write.partitionBy("event_slot", "kpi_bucket").parquet(f"{root}/customers")
    ls.delete_path(spark, f"{root}/{ls.CUSTOMERS}")
    late = [event(90, "o90", 0, customer="c1"), event(91, "o91", 0, customer="c9"), event(92, "o92", 9 * 1440)]
    land(frame(spark, late), landing)
    # the copy is made and the old folders are not yet gone
    with monkeypatch.context() as broken:
        broken.setattr(ls, "delete_path", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            managed.run(spark, landing, root)
    kpis = managed.run(spark, landing, root)
    want = managed.live_sales_minute(spark.read.schema(managed._silver_schema()).parquet(f"{root}/orders_silver_stream"))
    assert sorted(map(str, kpis.select(want.columns).collect())) == sorted(map(str, want.collect())) and kpis.count() == 7
    assert not os.path.exists(f"{root}/customers")


def test_a_batch_without_rows_changes_nothing(spark, tmp_path):
    none = no_rows(spark, managed._silver_schema())
    managed.fold_minutes(spark, str(tmp_path), none, 0)
    assert os.listdir(tmp_path) == []


def test_parts_that_exist(spark, tmp_path):
    root = str(tmp_path / "t")
    assert key_index.existing_parts(spark, root, ["p=1"]) == []
    key_index.write_parts(keys(spark, "a", "b").withColumn("p", F.col("k")), root, "p")
    assert key_index.existing_parts(spark, root, ["p=b", "p=c", "p=a"]) == [f"{root}/p=b", f"{root}/p=a"]
