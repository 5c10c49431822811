"""Phrase collocations by dynamic itemset counting.

The documents are dealt into shards, and the shards are scanned in a cycle, one a step.
Words are counted from the first step on. A longer phrase becomes active as soon as its
two subphrases, without its last and without its first word, have each been counted
often enough, in the middle of a cycle as well; from then on it is counted for
exactly one full cycle, so all lengths are counted side by side in the same scans. A
phrase that is frequent has frequent subphrases and so becomes active sooner or later:
its count is exact.

Which subphrases have reached the threshold is known to the tasks by hash buckets, a
table of fixed size. Phrases that share a bucket can only make another phrase active that
need not be: it is counted for a full cycle as well, and dropped if it is rare.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import bound_batches
from martloom.session import delete_path, materialize, no_rows, path_exists, scratch_path

#: Shards of a cycle.
SHARDS = 3
#: Words of the longest phrase, and the count that makes a phrase a candidate.
LONGEST, LEAST = 3, 10
#: Rows of each language that are returned.
TOP = 2000
#: A phrase inside a longer one that has at least this percentage of its count is dropped.
COVERED = 50
NO_LANG = "und"
#: Hash buckets for each length. The tasks hold one byte for each.
BUCKETS = 1 << 24
#: Bytes of text that a task counts at once.
HELD_BYTES = 8 << 20
#: Files that a task writes side by side, and bytes of their row groups.
OPEN_FILES, ROW_GROUP = 16, 32 << 20
#: Rows of an Arrow batch on the way back.
BATCH_OUT = 100_000

_FACTOR = 1_000_003
_COUNTS = "lang string, words int, phrase binary, since int, f bigint"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_SEPARATOR = re.compile(rb"[.,;:!?\x0a-\x0d]")

_KIND = np.zeros(256, np.uint8)  # 0: part of a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[list(_SEPARATORS)] = 2
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32


def bucket(lang: Column, phrase: Column, buckets: int = BUCKETS) -> Column:
    """Hash bucket of a phrase: its words' checksums folded into that of the language."""
    start = F.crc32(lang.cast("binary")) % buckets
    return F.aggregate(
        F.split(phrase, " "), start, lambda a, w: (a * _FACTOR + F.crc32(w.cast("binary"))) % buckets
    )


def _slices(text: bytes, limit: int) -> Iterator[bytes]:
    """A long text in parts that end at the end of a piece. A single piece stays whole."""
    start = 0
    while len(text) - start > limit:
        end = _SEPARATOR.search(text, start + limit)
        if end is None:
            break
        yield text[start : end.start()]
        start = end.end()
    yield text[start:] if start else text


def _distinct(columns: list[np.ndarray], base: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows of equally long columns of numbers below `base`, and how often each occurs."""
    if base ** len(columns) >= 1 << 62:
        rows, counts = np.unique(np.stack(columns, axis=1), axis=0, return_counts=True)
        return list(rows.T), counts
    code = columns[0].astype(np.int64)
    for c in columns[1:]:
        code = code * base + c
    code, counts = np.unique(code, return_counts=True)
    parts: list[np.ndarray] = []
    for _ in columns[1:]:
        code, last = np.divmod(code, base)
        parts.append(last)
    return [code, *reversed(parts)], counts


class Counter:
    """Counts of the active phrases of one language in one step."""

    def __init__(self, step: int, shards: int, longest: int, buckets: int, reached: dict[int, np.ndarray]) -> None:
        self.step, self.shards, self.longest, self.buckets, self.reached = step, shards, longest, buckets, reached

    def _words(self, texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Word numbers in order, the different words, and the piece that each word lies in."""
        raw = np.frombuffer(b"\n".join(texts), np.uint8)
        kind = _KIND[raw]
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = kind == 0
        edge = np.diff(inside)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        data = _LOWERED[raw[kind == 0]]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
        return coded.indices.to_numpy().astype(np.int64), coded.dictionary, piece

    def count(self, lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        ids, words, piece = self._words(texts)
        if not len(ids):
            return
        sums = np.fromiter((zlib.crc32(w) for w in words.to_pylist()), np.int64, len(words))
        first = (zlib.crc32(lang.encode()) % self.buckets * _FACTOR + sums) % self.buckets

        def folded(columns: list[np.ndarray]) -> np.ndarray:
            value = first[columns[0]]
            for c in columns[1:]:
                value = (value * _FACTOR + sums[c]) % self.buckets
            return value

        if self.step <= self.shards:
            yield from self._batches(lang, 0, pa.array([b""], pa.large_binary()), np.array([1]), np.array([len(ids)]))
            yield from self._batches(lang, 1, words, np.ones(len(words), np.int64), np.bincount(ids, minlength=len(words)))
        for n in range(2, self.longest + 1):
            # by place: the step at which the n - 1 words from here on had been counted often enough
            places = len(ids) - n + 1
            if places <= 0:
                return
            if n == 2:
                part = self.reached[1][first][ids]
            else:
                part = self.reached[n - 1][folded([ids[j : len(ids) - n + 2 + j] for j in range(n - 1)])]
            a, b = part[:places], part[1 : places + 1]
            since = np.maximum(a, b).astype(np.int64) + 1
            live = (a > 0) & (b > 0) & (piece[:places] == piece[n - 1 :]) & (since <= self.step) & (self.step < since + self.shards)
            at = np.flatnonzero(live)
            if not len(at):
                continue
            columns, counts = _distinct([ids[at + j] for j in range(n)], len(words))
            halves = [self.reached[n - 1][folded(c)] for c in (columns[:-1], columns[1:])]
            phrases = pc.binary_join_element_wise(*[words.take(pa.array(c)) for c in columns], pa.scalar(b" ", pa.large_binary()))
            yield from self._batches(lang, n, phrases, np.maximum(*halves).astype(np.int64) + 1, counts)

    @staticmethod
    def _batches(lang: str, n: int, phrases: pa.Array, since: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(phrases), BATCH_OUT):
            part = phrases.slice(k, BATCH_OUT)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang], pa.string()).take(pa.array(np.zeros(len(part), np.int8))),
                    pa.array(np.full(len(part), n, np.int32)),
                    part.cast(pa.binary()),
                    pa.array(since[k : k + BATCH_OUT].astype(np.int32)),
                    pa.array(counts[k : k + BATCH_OUT].astype(np.int64)),
                ],
                names=["lang", "words", "phrase", "since", "f"],
            )


def _counting(step: int, shards: int, longest: int, buckets: int, shared, held: int) -> Callable:
    """What a task does: hold texts by language up to `held` bytes, count them, go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(step, shards, longest, buckets, shared.value)
        waiting: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                for part in _slices(text.as_py(), held):
                    waiting.setdefault(lang, []).append(part)
                    size += len(part)
                    if size >= held:
                        for name, texts in waiting.items():
                            yield from counter.count(name, texts)
                        waiting, size = {}, 0
        for name, texts in waiting.items():
            yield from counter.count(name, texts)

    return run


def _deal(docs: DataFrame, shards: int, path: str) -> None:
    """Write (lang, text) in shards. Rows are dealt in turn, so the shards are even whatever the rows hold."""
    rows = docs.where("text IS NOT NULL").select(
        F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.col("text").cast("binary").alias("text")
    )
    turn = F.monotonically_increasing_id() % shards + 1
    _write_parts(rows.withColumn("shard", turn.cast("int")), "shard", path)


def _write_parts(df: DataFrame, part: str, path: str) -> None:
    """Write by a column of few values. A task keeps the file of each value open, so it need not sort its rows by the column.

    Texts and phrases hardly repeat, so no dictionary of them is tried; small row groups bound what the open files hold.
    """
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, str(max(int(before), OPEN_FILES)))
    try:
        plain = {f"parquet.enable.dictionary#{c}": "false" for c in ("phrase", "text")}
        df.write.options(**plain, **{"parquet.block.size": str(ROW_GROUP)}).partitionBy(part).parquet(path)
    finally:
        conf.set(name, before)


def phrase_counts(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, shards: int = SHARDS, buckets: int = BUCKETS, held: int = HELD_BYTES
) -> DataFrame:
    """lang, words, phrase, f of every phrase of 1 to `longest` words that occurs at least `least` times.

    The row with words = 0 and the phrase '' counts all words of the language.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    folder = scratch_path(spark, "shards")
    _deal(docs, shards, folder)
    text_schema = "lang string, text binary"
    state_schema = "lang string, words int, phrase string, since int, f bigint, reached int"
    reached = {n: np.zeros(buckets, np.uint8) for n in range(1, longest)}
    last = dict.fromkeys(reached, 0)
    paths: list[str] = []
    step = 0
    while step < shards or any(step < last[n] + shards for n in reached if last[n]):
        step += 1
        shard = f"{folder}/shard={(step - 1) % shards + 1}"
        texts = spark.read.schema(text_schema).parquet(shard) if path_exists(spark, shard) else no_rows(spark, text_schema)
        shared = spark.sparkContext.broadcast(reached)
        found = texts.mapInArrow(_counting(step, shards, longest, buckets, shared, held), _COUNTS).select(
            "lang", "words", F.col("phrase").cast("string").alias("phrase"), "since", "f", F.lit(None).cast("int").alias("reached")
        )
        if paths and path_exists(spark, f"{paths[-1]}/going=true"):
            found = found.unionByName(spark.read.schema(state_schema).parquet(f"{paths[-1]}/going=true"))
        merged = found.groupBy("lang", "words", "phrase").agg(
            F.min("since").alias("since"), F.sum("f").alias("f"), F.min("reached").alias("reached")
        )
        now = F.when(F.col("f") >= least, F.lit(step))
        state = merged.withColumn("reached", F.coalesce("reached", now)).withColumn("going", F.col("since") + (shards - 1) > step)
        # a phrase whose cycle is over leaves the scans; rare ones are forgotten
        path = scratch_path(spark, "phrases")
        _write_parts(state.where("going OR reached IS NOT NULL OR words = 0"), "going", path)
        shared.destroy()
        if paths:
            delete_path(spark, f"{paths[-1]}/going=true")
        paths.append(path)
        _mark(spark.read.schema(state_schema + ", going boolean").parquet(path), step, longest, buckets, reached, last)
    delete_path(spark, folder)
    done = [f"{p}/going=false" for p in paths if path_exists(spark, f"{p}/going=false")]
    out = spark.read.schema(state_schema).parquet(*done) if done else no_rows(spark, state_schema)
    return out.select("lang", "words", "phrase", "f")


def _mark(state: DataFrame, step: int, longest: int, buckets: int, reached: dict, last: dict) -> None:
    """Note the step in the buckets of the phrases that have just been counted often enough. At most `buckets` a length."""
    new = state.where((F.col("reached") == step) & F.col("words").between(1, longest - 1))
    places = new.select("words", bucket(F.col("lang"), F.col("phrase"), buckets).cast("int").alias("place")).distinct().toArrow()
    words, place = (places.column(c).to_numpy() for c in ("words", "place"))
    for n, table in reached.items():
        mine = place[words == n]
        fresh = mine[table[mine] == 0]
        if len(fresh):
            table[fresh] = step
            last[n] = step


def _part(phrase: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start, length), " ")


def score_of(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (l * r)) in whole numbers of up to 38 digits; counts have 15 at most."""
    a, left, right = (c.cast("decimal(15,0)") for c in (a, left, right))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right)


def collocations(docs: DataFrame, top: int = TOP, covered: int = COVERED, **counting) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the `top` phrases of each language.

    A null text has no words, a null language is `und`. Repeated rows count each for itself.
    Ties in score and count are broken by the phrase in byte order. A language without a
    candidate has no row, an empty table gives none. Ids are not read, nor are other columns.
    """
    counts = materialize(phrase_counts(docs, **counting), "phrase-counts")
    known = counts.where("words > 0").select("lang", "phrase", "f")
    candidates = counts.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "k",
        _part(F.col("phrase"), F.lit(1), F.col("k")).alias("head"),
        _part(F.col("phrase"), F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"),
    )
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    scored = scored.withColumn("score", score_of(F.col("a"), F.col("l"), F.col("r")))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = (
        candidates.where("words > 2")
        .withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
        .groupBy("lang", _part(F.col("phrase"), F.col("at"), F.col("size")).alias("phrase"))
        .agg(F.max("a").alias("longer"))
    )
    kept = best.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    # Spark keeps the first `top` of a language in every task before it shuffles
    first = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    sizes = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return first.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def _oracle() -> str:
    following = ", ".join(f"lead(w, {k}) OVER (PARTITION BY pid ORDER BY i) AS w{k}" for k in range(1, LONGEST))
    grams = " UNION ALL ".join(
        f"SELECT lang, {m} AS m, {' || chr(32) || '.join(['w', *[f'w{k}' for k in range(1, m)]])} AS phrase FROM x"
        + (f" WHERE w{m - 1} IS NOT NULL" if m > 1 else "")
        for m in range(1, LONGEST + 1)
    )
    return rf"""
WITH d AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
q AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
p AS (SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM q),
o AS (SELECT pid, lang, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM p),
x AS (SELECT *, {following} FROM o),
f AS (SELECT lang, m, phrase, COUNT(*) AS f FROM ({grams}) GROUP BY lang, m, phrase),
s AS (SELECT lang, SUM(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= {LEAST}),
cut AS (SELECT *, array_to_string(ws[:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail
        FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
scored AS (
  SELECT c.lang, c.phrase, c.a, k, h.f AS l, t.f AS r, ((1000000::HUGEINT * c.a * c.a) // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM cut c JOIN f h ON h.lang = c.lang AND h.phrase = head JOIN f t ON t.lang = c.lang AND t.phrase = tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, array_to_string(ws[i:i + z - 1], ' ') AS phrase, MAX(a) AS longer
  FROM (SELECT *, unnest(range(1, m - z + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS z FROM c)) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inner_ i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {COVERED} * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN s USING (lang) WHERE rank <= {TOP}
"""


ORACLE = _oracle()
