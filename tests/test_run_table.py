import glob

import pytest

from martloom.sources.run_table import RunTable


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def both(table):
    return sorted(r.v for r in table.latest().collect()), sorted(r.v for r in table.history().collect())


def test_latest_and_history_change_together(spark, tmp_path):
    table = RunTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="no run"):
        table.latest()
    table.commit(rows(spark, "a", "b"))
    assert both(table) == (["a", "b"], ["a", "b"])
    table.commit(rows(spark, "c"), "run-2")
    table.commit(rows(spark, "other"), "run-2")
    assert both(RunTable(spark, str(tmp_path / "t/"))) == (["c"], ["a", "b", "c"])
    table.commit(rows(spark).limit(0))
    assert both(table) == ([], ["a", "b", "c"])


@pytest.mark.parametrize("step", ["write", "_swap"])
def test_a_failure_leaves_both_as_they_were_and_a_rerun_repairs(spark, tmp_path, monkeypatch, step):
    table = RunTable(spark, str(tmp_path / "t"))
    table.commit(rows(spark, "a"), "run-1")
    if step == "write":
        bad = rows(spark, "b").selectExpr("CAST(assert_true(v <> 'b', 'lost') AS STRING) AS v")
    else:
        bad = rows(spark, "b")
        monkeypatch.setattr(RunTable, "_swap", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        table.commit(bad, "run-2")
    monkeypatch.undo()
    assert both(table) == (["a"], ["a"])
    table.commit(rows(spark, "b"), "run-2")
    assert both(table) == (["b"], ["a", "b"])
    table.vacuum()
    assert both(table) == (["b"], ["a", "b"]) and len(glob.glob(f"{tmp_path}/t/data/*")) == 2


def test_two_writers_both_count(spark, tmp_path, monkeypatch):
    table, other = RunTable(spark, str(tmp_path / "t")), RunTable(spark, str(tmp_path / "t"))
    swap = RunTable._swap

    def late(self, number, runs):
        """Another writer commits between this one's look at the pointer and its swap."""
        monkeypatch.setattr(RunTable, "_swap", swap)
        other.commit(rows(spark, "theirs"))
        return swap(self, number, runs)

    monkeypatch.setattr(RunTable, "_swap", late)
    table.commit(rows(spark, "mine"))
    assert both(table) == (["mine"], ["mine", "theirs"])


def test_rows_of_a_repeated_run_are_not_computed(spark, tmp_path):
    table, built = RunTable(spark, str(tmp_path / "t")), []
    for _ in range(2):
        table.commit(lambda: built.append(1) or rows(spark, "a"), "run-1")
    assert both(table) == (["a"], ["a"]) and built == [1]
