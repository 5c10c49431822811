"""Merkle manifest of a dataset as a content-addressed graph of digests.

Every node is stored once as digest -> children. A proof is read from that store alone:
the request for a leaf descends from the root by the base-8 digits of the leaf's rank,
collects the children it does not select, and the segments of the path, turned round,
are the proof from the leaf upwards. Requests that share a node descend together, so
the level above the leaves carries one row for eight leaves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.session import materialize, scratch_path

#: Children of a node.
FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_BITS = FANOUT.bit_length() - 1
#: Group key of a language: null comes before every text, '' included.
NO_LANG, SOME_LANG = "", "="
_TOP = "all"


def digest(value: Column) -> Column:
    """SHA-256 as 32 bytes; hex text is made where digests are hashed again or returned."""
    return F.unhex(F.sha2(value, 256))


def hexed(value: Column) -> Column:
    return F.lower(F.hex(value))


def framed(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, `:` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column | None = None) -> Column:
    """The digest of a document, with another text if one is given."""
    values = [text if name == "text" and text is not None else F.col(name) for name in FIELDS]
    return digest(F.concat(*[framed(v) for v in values]))


def tampered_text(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def chosen_for_tampering(doc_id: Column) -> Column:
    """Where 3 divides the crc32 of the decimal id; a null id has none."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def group_of(lang: Column) -> Column:
    """A text that is never null and sorts like the language, null first."""
    return F.coalesce(F.concat(F.lit(SOME_LANG), lang), F.lit(NO_LANG))


def ranked(rows: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """`rows` with `rank`, from 0, within `group` by `order` (nulls first).

    The rows are cut into ranges of the sort order. Rows that are equal in all of `order`
    are interchangeable: a number drawn per stored row cuts them as well, so that a row
    repeated any number of times fills several ranges. The ranges are written, and a rank is
    the place in the range plus the rows of the group in the ranges before it.
    `rows` must be a written table, whose scan gives every row the same number again.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    drawn = rows.withColumn("_tie", F.rand(7))
    cut = drawn.repartitionByRange(n, group, *order, "_tie").sortWithinPartitions(group, *order, "_tie").drop("_tie")
    cut = cut.withColumns({"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id()})
    cut = materialize(cut, label)
    totals = cut.groupBy(group, "_range").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    # a group has one row here for each range at most
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")
    shifts = totals.select(group, "_range", shift.alias("_shift"))
    return cut.join(shifts, [group, "_range"]).withColumn("rank", F.col("_place") + F.col("_shift")).drop("_range", "_place", "_shift")


@dataclass
class Store:
    """The written manifest: digest -> children by height, the subroots by group, and the root."""

    spark: SparkSession
    path: str
    #: Heights of the highest tree below a subroot, and of the tree over the subroots.
    height: int = 0
    top_height: int = 0
    root: bytes | None = None

    def nodes(self, part: str, height: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{part}/height={height}")

    def subroots(self) -> DataFrame:
        """grp, digest, leaves, height, rank (place among the subroots)."""
        return self.spark.read.parquet(f"{self.path}/subroots")


def _grow(spark: SparkSession, path: str, part: str, leaves: DataFrame) -> tuple[DataFrame, int]:
    """Write the trees over `leaves` (grp, rank, digest) level by level.

    Returns grp, digest, leaves, height of every tree's top and the greatest height. A
    group stops where one node is left. A level is one grouping of an eighth of the rows.
    """
    counts = materialize(leaves.groupBy("grp").agg(F.count("*").alias("leaves")), f"{part}-counts")
    # smallest height h with 8**h >= leaves: the number of base-8 digits of the last rank
    height = F.when(F.col("leaves") > 1, F.ceil(F.length(F.bin(F.col("leaves") - 1)) / _BITS)).otherwise(0).cast("int")
    counts = counts.withColumn("height", height)
    heights = {r[0] for r in counts.select("height").distinct().collect()}
    most = max(heights, default=0)
    tops = leaves.join(counts.where("height = 0"), "grp").select("grp", "digest", "leaves", "height")
    level = leaves
    for h in range(1, most + 1):
        if h - 1 in heights:
            level = level.join(counts.where(F.col("height") >= h).select("grp"), "grp", "left_semi")
        child = F.struct("rank", "digest")
        runs = level.groupBy("grp", F.shiftright("rank", _BITS).alias("run")).agg(
            F.transform(F.array_sort(F.collect_list(child)), lambda c: c["digest"]).alias("children")
        )
        parents = runs.select(
            "grp", F.col("run").alias("rank"), digest(F.array_join(F.transform("children", hexed), "")).alias("digest"), "children"
        )
        grown = materialize(parents, f"{part}-level")
        # equal subtrees, of repeated rows, are one record
        grown.groupBy("digest").agg(F.first("children").alias("children")).write.parquet(f"{path}/{part}/height={h}")
        level = grown.select("grp", "rank", "digest")
        tops = tops.unionByName(level.join(counts.where(F.col("height") == h), "grp").select("grp", "digest", "leaves", "height"))
    return tops, most


def build(spark: SparkSession, leaves: DataFrame, path: str | None = None) -> Store:
    """The manifest over `leaves` (grp, rank from 0 in the group, digest)."""
    store = Store(spark, path or scratch_path(spark, "manifest"))
    tops, store.height = _grow(spark, store.path, "trees", leaves)
    written = materialize(tops, "subroots")
    placed = ranked(written.withColumn("_all", F.lit(_TOP)), "_all", ["grp"], "subroot-ranges").drop("_all")
    placed.write.parquet(f"{store.path}/subroots")
    upper = store.subroots().select(F.lit(_TOP).alias("grp"), "rank", "digest")
    roots, store.top_height = _grow(spark, store.path, "top", upper)
    found = roots.select("digest").first()
    store.root = bytes(found[0]) if found else None
    return store


_SEGMENTS = "array<struct<left:binary,right:binary>>"


def _joined(children: Column) -> Column:
    return F.aggregate(children, F.lit(b""), lambda a, c: F.concat(a, c))


def _segment(children: Column, i: Column) -> Column:
    """What a path collects where it takes child `i` (from 0): the digests left and right of it."""
    left, right = F.slice(children, F.lit(1), i), F.slice(children, i + 2, F.lit(FANOUT))
    return F.struct(_joined(left).alias("left"), _joined(right).alias("right"))


def _step(frontier: DataFrame, nodes: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """All requests one level down: the record of each frontier digest, and one row for each of its children."""
    met = frontier.join(nodes, "digest")
    down = met.select("grp", "rank", "path", "children", *carried, F.posexplode("children").alias("digit", "child"))
    return down.select(
        "grp",
        (F.shiftleft("rank", _BITS) + F.col("digit")).alias("rank"),
        F.col("child").alias("digest"),
        F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path"),
        *carried,
    )


def _asked(frontier: DataFrame, requests: DataFrame | None, height: int) -> DataFrame:
    """Only the nodes above a requested leaf."""
    if requests is None:
        return frontier
    wanted = requests.select("grp", F.shiftright("rank", _BITS * height).alias("rank")).distinct()
    return frontier.join(wanted, ["grp", "rank"], "left_semi")


def descend(store: Store, requests: DataFrame | None = None) -> DataFrame:
    """From the root to the nodes one level above the leaves.

    Returns grp, rank (of the node in its level), children (null: the subroot is itself the
    leaf), subroot and path, whose first segment is the root's. `requests` holds grp and rank
    of leaves; without it every leaf is asked for.
    """
    start = store.spark.range(1).select(
        F.lit(_TOP).alias("grp"),
        F.lit(0).cast("long").alias("rank"),
        F.lit(store.root).alias("digest"),
        F.expr(f"cast(array() as {_SEGMENTS})").alias("path"),
    )
    for h in range(store.top_height, 0, -1):
        start = _step(start, store.nodes("top", h))
    subroots = store.subroots().select(F.col("grp").alias("g"), "rank", "height")
    entered = start.join(subroots, "rank").select(
        F.col("g").alias("grp"), F.lit(0).cast("long").alias("rank"), "digest", F.col("digest").alias("subroot"), "path", "height"
    )
    entered = materialize(entered, "subroot-paths")

    def at(height: int) -> DataFrame:
        return _asked(entered.where(F.col("height") == height).drop("height"), requests, height)

    found = at(0).withColumn("children", F.lit(None).cast("array<binary>")).drop("digest")
    frontier = None
    for h in range(store.height, 0, -1):
        frontier = at(h) if frontier is None else frontier.unionByName(at(h))
        if h > 1:
            frontier = _asked(_step(frontier, store.nodes("trees", h), ("subroot",)), requests, h - 1)
    if frontier is not None:
        found = found.unionByName(frontier.join(store.nodes("trees", 1), "digest").drop("digest"))
    return found


def _with_proof(rows: DataFrame, place: Column) -> DataFrame:
    """`segments` from the leaf upwards, for the leaf at `place` below the node of the row."""
    last = F.when(F.col("children").isNull(), F.expr(f"cast(array() as {_SEGMENTS})")).otherwise(
        F.array(_segment(F.col("children"), place))
    )
    return rows.withColumn("segments", F.reverse(F.concat("path", last))).drop("path", "children")


def proof_text(segments: Column) -> Column:
    """The siblings of the path, level by level, left to right, as hex text."""
    return F.array_join(F.transform(segments, lambda s: hexed(F.concat(s["left"], s["right"]))), "")


def folded(leaf: Column, segments: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(
        segments, leaf, lambda acc, s: digest(F.concat(hexed(s["left"]), hexed(acc), hexed(s["right"])))
    )


def document_leaves(docs: DataFrame) -> DataFrame:
    """doc_id, grp, rank, digest and, for the documents chosen for tampering, the digest of the tampered one."""
    changed = F.when(chosen_for_tampering(F.col("doc_id")), leaf_of(tampered_text(F.col("text"))))
    plain = docs.select("doc_id", group_of(F.col("lang")).alias("grp"), leaf_of().alias("digest"), changed.alias("tampered"))
    return ranked(materialize(plain, "leaves"), "grp", ["doc_id", "digest"], "leaf-ranges")


def prove(store: Store, leaves: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """The rows of `leaves` (all, or those of `requests`: grp, rank) with `subroot` and `segments`."""
    asked = leaves if requests is None else leaves.join(requests, ["grp", "rank"], "left_semi")
    rest = [c for c in leaves.columns if c not in ("grp", "rank")]
    # the leaves of a node travel together, so paths are shuffled once for eight leaves
    runs = asked.groupBy("grp", F.shiftright("rank", _BITS).alias("rank")).agg(F.collect_list(F.struct("rank", *rest)).alias("run"))
    met = descend(store, requests).join(runs, ["grp", "rank"])
    each = met.select("grp", "subroot", "path", "children", F.explode("run").alias("leaf")).select(
        "grp", "subroot", "path", "children", "leaf.*"
    )
    return _with_proof(each, (F.col("rank") % FANOUT).cast("int"))


def manifest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every document.

    The store is written to `path` (default: the shared scratch folder) and stays.

    Null values are hashed as `-`, an empty text as `0:`. Null ids come first in their
    language and are not tampered with. Rows with equal ids are ordered by their leaf digest;
    equal rows are leaves of their own with equal digests. An empty table gives no rows.
    Other columns of `docs` are not read.
    """
    spark = docs.sparkSession
    leaves = document_leaves(docs)
    store = build(spark, leaves.select("grp", "rank", "digest"), path)
    proved = prove(store, leaves)
    root = F.lit(store.root).cast("binary")
    out = proved.select(
        "doc_id",
        hexed(F.col("digest")).alias("leaf"),
        hexed(F.col("subroot")).alias("subroot"),
        hexed(root).alias("root"),
        F.sha2(proof_text(F.col("segments")), 256).alias("proof_sha256"),
        hexed(folded(F.coalesce("tampered", "digest"), F.col("segments"))).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: Levels that the comparison SQL writes out: 8**7 documents of a language and 8**3 languages.
SQL_LEVELS, SQL_TOP_LEVELS = 7, 3


def _framed_sql(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR, '-')"


def _levels_sql(prefix: str, levels: int) -> str:
    """Runs of siblings and the nodes above them, level by level; a group with one node keeps it."""
    text = ""
    for k in range(levels):
        text += f"""
{prefix}r{k} AS (SELECT g, pos // 8 AS run, list(d ORDER BY pos) AS ds FROM {prefix}{k} WHERE n > 1 GROUP BY g, pos // 8),
{prefix}{k + 1} AS (SELECT g, run AS pos, sha256(array_to_string(ds, '')) AS d, COUNT(*) OVER (PARTITION BY g) AS n FROM {prefix}r{k}
       UNION ALL SELECT g, pos, d, n FROM {prefix}{k} WHERE n = 1),"""
    return text


def _climb_sql(prefix: str, levels: int, first: str) -> str:
    """The documents one level up at a time: their place, proof text and folded digest."""
    text, before = "", first
    for k in range(levels):
        step = f"{prefix}c{k + 1}"
        text += f"""
{step} AS (SELECT * EXCLUDE (g, pos, proof, folded, lft, rgt, ds), g, CASE WHEN ds IS NULL THEN pos ELSE pos // 8 END AS pos,
       proof || coalesce(lft || rgt, '') AS proof, CASE WHEN ds IS NULL THEN folded ELSE sha256(lft || folded || rgt) END AS folded
       FROM (SELECT c.*, ds, array_to_string(ds[:pos % 8], '') AS lft, array_to_string(ds[pos % 8 + 2:], '') AS rgt
             FROM {before} c LEFT JOIN {prefix}r{k} r ON r.g = c.g AND r.run = c.pos // 8)),"""
        before = step
    return text


ORACLE = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, text, source, lang, n_chars,
         sha256({" || ".join(_framed_sql(f) for f in FIELDS)}) AS leaf,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda a, c: list_reduce([xor(a, c), 1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[],
             lambda v, o: xor(v >> 1, 3988292384 * (v & 1)))) AS crc FROM documents),
t AS (
  SELECT *, CASE WHEN xor(crc, 4294967295::BIGINT) % 3 = 0 THEN
           sha256({" || ".join(_framed_sql("low" if f == "text" else f) for f in FIELDS)}) ELSE leaf END AS start
  FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM d)),
c0 AS (
  SELECT doc_id, leaf, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         '' AS proof, start AS folded FROM t),
l0 AS (SELECT g, pos, leaf AS d, COUNT(*) OVER (PARTITION BY g) AS n FROM c0),{_levels_sql("l", SQL_LEVELS)}
u0 AS (SELECT 'all' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, d, COUNT(*) OVER () AS n, g AS own FROM l{SQL_LEVELS}),{
    _levels_sql("u", SQL_TOP_LEVELS)}{_climb_sql("l", SQL_LEVELS, "c0")}
e AS (SELECT c.doc_id, c.leaf, u0.d AS subroot, 'all' AS g, u0.pos, proof, folded FROM lc{SQL_LEVELS} c JOIN u0 ON u0.own = c.g),{
    _climb_sql("u", SQL_TOP_LEVELS, "e")}
f AS (SELECT c.*, u.d AS root FROM uc{SQL_TOP_LEVELS} c, u{SQL_TOP_LEVELS} u)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM f
"""
