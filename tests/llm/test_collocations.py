"""Collocations against plain counting of all phrases."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import collocations as co
from martloom.llm.common import table


def grams(rows, longest):
    found = Counter()
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^ \t]+", piece)
            found["und" if lang is None else lang, 0, ""] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    found["und" if lang is None else lang, n, " ".join(words[i : i + n])] += 1
    return found


def plain(rows, longest=3, least=10, top=2000, covered=50):
    f = grams(rows, longest)
    candidates = {k: v for k, v in f.items() if k[1] > 1 and v >= least}
    longer = Counter()
    for (lang, n, phrase), a in candidates.items():
        ws = phrase.split(" ")
        for size in range(2, n):
            for i in range(n - size + 1):
                key = lang, size, " ".join(ws[i : i + size])
                longer[key] = max(longer[key], a)
    by_lang = {}
    for (lang, n, phrase), a in candidates.items():
        ws = phrase.split(" ")
        cuts = []
        for k in range(1, n):
            left, right = f[lang, k, " ".join(ws[:k])], f[lang, n - k, " ".join(ws[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        if not longer[lang, n, phrase] or 100 * longer[lang, n, phrase] < covered * a:
            by_lang.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right))
    out = []
    for lang, found in by_lang.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, f[lang, 0, ""], -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(docs):
    return [(r.lang, r.text) for r in docs.select("lang", "text").collect()]


@pytest.fixture(scope="module")
def drawn():
    """Texts of a small vocabulary, with every separator, odd white space, repeats, and words that grow frequent late."""
    draw = random.Random(3)
    words = ["a", "B", "b", "é", "\U0001f600", "c\x00d", "x y", "Ä", "z" * 300, "in", "the", "of"]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\r", " \x0b ", "?", "\x0c", ";:", "!"]
    rows = []
    for _ in range(400):
        text = "".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randint(0, 40)))
        rows.append((draw.choice(["en", "en", "fr", None, "und", ""]), text))
    rows += [("en", "late phrase comes now")] * 12 + [(None, None), ("fr", ""), ("de", " .\n"), ("en", "one. piece. each")] * 3
    rows.append(("en", "long text of words, " * 5000 + "the " * 20_000))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "lang string, text string")
    return df.selectExpr("*", "1 AS f", "lang AS phrase", "lang AS shard", "1 AS words", "1 AS rank", "1 AS doc_id")


def test_collocations_of_the_documents(spark, small):
    docs = table(spark, small, "documents")
    want = plain(texts(docs))
    assert want and rows_of(co.collocations(docs)) == want


@pytest.mark.parametrize(
    ("shards", "buckets", "held", "longest"), [(1, 1 << 20, 1 << 20, 3), (4, 1 << 20, 500, 3), (3, 8, 5000, 3), (2, 1 << 16, 2000, 4), (2, 64, 900, 2)]
)
def test_any_number_of_shards_and_buckets_counts_the_same(spark, drawn, shards, buckets, held, longest):
    got = co.collocations(frame(spark, drawn), shards=shards, buckets=buckets, held=held, longest=longest, least=7)
    assert rows_of(got) == plain(drawn, longest, 7)


def test_top_and_cover(spark, drawn):
    got = co.collocations(frame(spark, drawn), top=5, covered=90, least=5)
    assert rows_of(got) == plain(drawn, 3, 5, 5, 90)


def test_phrases_become_active_when_both_subphrases_are_frequent(spark, monkeypatch):
    """Rows of one partition are dealt in turn: the first shard makes 'a b' active for the second one."""
    rows = [("en", "a b"), ("en", "a b"), ("en", "c c")] * 12
    started = {}
    mark = co._mark
    def seen(state, step, *rest):
        for r in state.collect():
            started.setdefault(r.phrase, (step, r.since))
        mark(state, step, *rest)
    monkeypatch.setattr(co, "_mark", seen)
    counts = co.phrase_counts(frame(spark, rows).coalesce(1), shards=3)
    assert started["a"] == (1, 1) and started["a b"] == (2, 2) and started["c"] == (3, 1) and started["c c"] == (6, 4)
    assert {(r.phrase, r.f) for r in counts.collect()} == {("", 72), ("a", 24), ("b", 24), ("c", 24), ("a b", 24), ("c c", 12)}


def test_phrases_and_texts_are_written_without_a_sort(spark, drawn, tmp_path, monkeypatch):
    """The files of the values of a partition column are open side by side, and the session's setting is put back."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    seen, write = [], co._write_parts
    monkeypatch.setattr(co, "_write_parts", lambda df, part, path: seen.append(part) or write(df, part, path))
    counts = co.phrase_counts(frame(spark, drawn), shards=2, least=7)
    assert set(seen) == {"shard", "going"} and counts.count() > 0 and spark.conf.get(name) == "0"
    # both values turn up again and again in one task: one file each all the same, where a sorted write would sort
    df = spark.range(1000, numPartitions=1).selectExpr("id % 2 AS part", "CAST(id AS STRING) AS phrase")
    write(df, "part", str(tmp_path / "w"))
    plans = [p for p in (spark.read.parquet(str(tmp_path / "w" / f"part={k}")).collect() for k in (0, 1))]
    assert [len(p) for p in plans] == [500, 500] and [r.phrase for r in plans[1][:3]] == ["1", "3", "5"]
    with pytest.raises(Exception, match="EXISTS"):
        write(df, "part", str(tmp_path / "w"))
    assert spark.conf.get(name) == "0"


def test_counter_falls_back_on_rows_where_codes_would_not_fit():
    columns = [np.array([5, 5, 1]), np.array([2, 2, 9])]
    small, n = co._distinct(columns, 10)
    large, m = co._distinct(columns, 1 << 40)
    assert [c.tolist() for c in small] == [c.tolist() for c in large] == [[1, 5], [9, 2]] and n.tolist() == m.tolist() == [1, 2]


def test_scores_of_large_counts_are_exact(spark):
    big = 999_999_999_999_999
    df = spark.range(1).select(co.score_of(F.lit(big), F.lit(big), F.lit(big)).alias("x"), co.score_of(F.lit(big - 1), F.lit(big), F.lit(big)).alias("y"))
    assert tuple(df.first()) == (1_000_000, 1_000_000 * (big - 1) ** 2 // big**2)


def test_no_rows(spark, empty):
    assert co.collocations(empty).count() == 0
    assert co.collocations(frame(spark, [(None, None), ("en", "")])).count() == 0


def test_sql_on_awkward_rows(spark, drawn, odd, tmp_path):
    rows = [r for r in drawn if "\x00" not in (r[1] or "")] * 2 + texts(odd)
    docs = frame(spark, rows)
    docs.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    got = con.execute(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({co.ORACLE})").fetchall()
    assert sorted(got) == plain(rows) == rows_of(co.collocations(docs))
