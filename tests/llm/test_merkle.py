"""The manifest against a plain Python one that builds every tree in memory."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from martloom.llm import merkle
from martloom.llm.common import table


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, text):
    return h("".join(framed(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def climb(leaves):
    """The root over `leaves` and, for each leaf, its (left, right) siblings level by level."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for path, i in zip(paths, at, strict=True):
            run = level[i // 8 * 8 : i // 8 * 8 + 8]
            path.append(("".join(run[: i % 8]), "".join(run[i % 8 + 1 :])))
        at = [i // 8 for i in at]
        level = [h("".join(level[k : k + 8])) for k in range(0, len(level), 8)]
    return level[0], paths


def plain(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r.lang, []).append((r, leaf_of(r, r.text)))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for found in by_lang.values():
        found.sort(key=lambda x: (x[0].doc_id is not None, x[0].doc_id or 0, x[1]))
    trees = [climb([leaf for _, leaf in by_lang[x]]) for x in langs]
    if not trees:
        return []
    root, above = climb([t[0] for t in trees])
    out = []
    for lang, (subroot, paths), upper in zip(langs, trees, above, strict=True):
        for (r, leaf), path in zip(by_lang[lang], paths, strict=True):
            text = r.text
            if r.doc_id is not None and text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            value = leaf_of(r, text)
            for left, right in path + upper:
                value = h(left + value + right)
            proof = h("".join(a + b for a, b in path + upper))
            out.append((r.doc_id, leaf, subroot, root, proof, value, value == root))
    return sorted(map(repr, out))


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_manifest_of_the_documents(spark, small):
    docs = table(spark, small, "documents")
    got = merkle.manifest(docs)
    assert rows_of(got) == plain(docs.collect())
    assert {r.verified for r in got.select("verified").distinct().collect()} == {True, False}


def many(spark):
    """Languages with 1, 8, 9, 64, 65, 513 documents, more than eight of them, repeats and equal subtrees."""
    sizes = {"a": 1, "b": 8, "c": 9, "d": 64, "é": 65, "": 2, None: 3, "\U0001f600": 1, "Z": 1, "big": 513, "same": 150}
    parts = None
    for k, (lang, n) in enumerate(sizes.items()):
        number = F.lit(7) if lang == "same" else F.col("id") + 1000 * k
        part = spark.range(n).select(
            number.cast("long").alias("doc_id"), F.concat(F.lit("Text É "), number.cast("string")).alias("text"),
            F.lit(lang).cast("string").alias("lang"), F.lit("s").alias("source"), F.lit(9).cast("long").alias("n_chars"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def test_trees_of_many_heights(spark):
    docs = many(spark)
    assert rows_of(merkle.manifest(docs)) == plain(docs.collect())


def test_awkward_rows_and_no_rows(odd, empty):
    assert rows_of(merkle.manifest(odd)) == plain(odd.collect())
    got = merkle.manifest(empty)
    assert got.count() == 0 and got.columns[:2] == ["doc_id", "leaf"]


@pytest.mark.parametrize("part", ["many", "odd", "empty", "one"])
def test_sql_on_awkward_rows(spark, odd, empty, part, tmp_path):
    docs = {"many": many(spark), "odd": odd, "empty": empty, "one": odd.limit(1)}[part]
    docs.select(*merkle.FIELDS).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    columns = "doc_id, leaf, subroot, root, proof_sha256, folded_root, verified"
    got = con.execute(f"SELECT {columns} FROM ({merkle.ORACLE})").fetchall()
    assert sorted(map(repr, got)) == plain(spark.read.parquet(str(tmp_path / "d")).collect())


def test_the_store_holds_each_digest_once_and_proves_single_leaves(spark):
    leaves = merkle.document_leaves(many(spark))
    store = merkle.build(spark, leaves.select("grp", "rank", "digest"))
    for part, height in (("trees", store.height), ("top", store.top_height)):
        for k in range(1, height + 1):
            nodes = store.nodes(part, k)
            assert nodes.count() == nodes.select("digest").distinct().count()
            assert nodes.where(merkle.digest(F.array_join(F.transform("children", merkle.hexed), "")) != F.col("digest")).count() == 0
    asked = leaves.where("grp = '=big' AND rank IN (0, 300, 512) OR grp = '=a'").select("grp", "rank")
    proved = merkle.prove(store, leaves, asked)
    roots = proved.select("grp", "rank", merkle.folded(F.col("digest"), F.col("segments")).alias("root")).collect()
    assert sorted((r.grp, r.rank) for r in roots) == [("=a", 0), ("=big", 0), ("=big", 300), ("=big", 512)]
    assert {bytes(r.root) for r in roots} == {store.root}


def test_a_row_repeated_many_times_fills_several_ranges(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(20_000).select(F.lit("g").alias("grp"), F.lit(1).alias("doc_id")).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = merkle.ranked(spark.read.parquet(path), "grp", ["doc_id"], "test")
        assert found.agg(F.count_distinct("rank"), F.min("rank"), F.max("rank")).first() == (20_000, 0, 19_999)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
