"""Mixing sources to target weights along a curriculum.

Each source has a weight that changes while training goes on. Its integral over the
training is the source's demand; inverting that integral turns "the n-th word taken
from this source" into a position in the training. Documents are sorted by position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import WORD, let

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Weight over the training, at equally spaced points, for each of WEIGHTS: heavy
#: sources come early, light ones late. Only the form counts; the area is the target.
SCHEDULES = ((1.5, 1.2, 0.3), (1.0, 1.0, 1.0), (0.3, 1.0, 1.7))
#: Words taken, as a share of all words.
SHARE = 1.5
#: A document is taken this often at most.
REPEATS = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, repeats: int) -> DataFrame:
    """Target words of each source, from (source, source_size).

    A source may give `repeats` times its size. Sorted by size over weight, the full
    sources come first; the level of the others is the largest one that they can hold.
    """
    named = sizes.withColumn(
        "turn", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    ).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("turn").cast("int") + 1))
    cap = F.col("source_size") * F.lit(float(repeats))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest, everything = (
        order.rowsBetween(Window.unboundedPreceding, -1),
        order.rowsBetween(0, Window.unboundedFollowing),
        Window.partitionBy(),
    )
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share))
        - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(float(repeats))
    ) / F.sum("weight").over(rest)
    levels = named.withColumn("cap", cap).withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    return levels.withColumn("level", F.max(fits).over(everything)).select(
        "source", "turn", F.least(F.col("cap"), F.col("level") * F.col("weight")).alias("target")
    )


def invert(schedule: Sequence[float], share: Column) -> Column:
    """The training position (0 to 1) at which this share of the schedule's area is reached."""
    step = 1.0 / (len(schedule) - 1)
    areas = [(a + b) / 2 * step for a, b in zip(schedule, schedule[1:], strict=False)]
    total = sum(areas)
    result, start = F.lit(1.0), total
    for k in range(len(areas) - 1, -1, -1):
        start -= areas[k]
        s0, slope = schedule[k], (schedule[k + 1] - schedule[k]) / step
        y = F.greatest(share * total - start, F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(s0 * s0) + 2 * slope * y, F.lit(0.0)))
        within = F.lit(k * step) + 2 * y / F.greatest(F.lit(s0) + root, F.lit(1e-300))
        result = F.when(share * total <= start + areas[k], within).otherwise(result)
    return F.least(F.greatest(result, F.lit(0.0)), F.lit(1.0))


def plan(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Sequence[float]] = SCHEDULES,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """`docs` (doc_id, text, source, anything else) with a struct column `__mix`.

    __mix: size, source_size, target, copies (array of taken words and position, one
    for each of `repeats` passes over the source) and taken.

    Within a source, documents come in the order of md5(doc_id); the passes follow each
    other until the target is reached, and the document at the target is cut there.
    That order is cut into 4096 parts by the first digits of the digest, so a source of
    any size is summed up by many tasks.

    Null text counts as empty (size 0, never taken); null source is a source of its
    own; null ids are ordered by their text's digest. Repeated rows are separate
    documents. Empty table: no rows. Columns whose names start with __mix are taken.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.coalesce("text", F.lit("")))))
    marked = docs.withColumn("__mix_key", key).withColumn("__mix_size", word_count(F.col("text")))
    part = F.substring("__mix_key", 1, 3)
    parts = (
        marked.select(F.col("source"), part.alias("part"), F.col("__mix_size").alias("size"))
        .groupBy("source", "part")
        .agg(F.sum("size").alias("size"))
    )
    sizes = parts.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = sizes.join(
        source_targets(sizes, weights, share, repeats).withColumnRenamed("source", "t_source"),
        F.col("source").eqNullSafe(F.col("t_source")),
    ).drop("t_source")
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        parts.withColumn("start", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
        .join(targets.withColumnRenamed("source", "t_source"), F.col("source").eqNullSafe(F.col("t_source")))
        .select(
            F.col("source").alias("__mix_source"), F.col("part").alias("__mix_p"),
            F.struct("start", "source_size", "target", "turn").alias("__mix_start"),
        )
    )
    in_part = (
        Window.partitionBy("source", "__mix_part")
        .orderBy("__mix_key", "doc_id", "__mix_size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = marked.withColumn("__mix_part", part).withColumn(
        "__mix_before", F.coalesce(F.sum("__mix_size").over(in_part), F.lit(0))
    )
    joined = summed.join(
        starts,
        F.col("source").eqNullSafe(F.col("__mix_source")) & (F.col("__mix_part") == F.col("__mix_p")),
        "left",
    )
    s = F.col("__mix_start")
    quota = F.round(s["target"]).cast("long")
    first = F.col("__mix_before") + s["start"]

    def copy(k: int) -> Column:
        taken = F.greatest(
            F.least(quota - first - k * s["source_size"], F.col("__mix_size")), F.lit(0).cast("long")
        )
        middle = (first + k * s["source_size"] + taken / 2) / F.greatest(quota, F.lit(1))
        at = F.lit(None).cast("double")
        for turn, schedule in enumerate(schedules):
            at = F.when(s["turn"] == turn, invert(schedule, middle)).otherwise(at)
        return F.struct(taken.alias("taken"), F.when(taken > 0, at).alias("position"))

    mixed = F.struct(
        F.col("__mix_size").alias("size"),
        s["source_size"].alias("source_size"),
        s["target"].alias("target"),
        F.array(*[copy(k) for k in range(repeats)]).alias("copies"),
    )
    return joined.withColumn("__mix", mixed).drop(
        "__mix_key", "__mix_size", "__mix_part", "__mix_before", "__mix_source", "__mix_p", "__mix_start"
    )


def mix(docs: DataFrame, **parameters) -> DataFrame:
    """One row per document, by training position: doc_id, size, source_size, target, taken, position, copies.

    position is that of the first copy; documents not taken come last, with null. The
    cases of `plan` apply.
    """
    planned = plan(docs.select("doc_id", "text", "source"), **parameters)
    m = F.col("__mix")
    taken = F.aggregate(m["copies"], F.lit(0).cast("long"), lambda a, c: a + c["taken"])
    return planned.select(
        "doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"),
        taken.alias("taken"), m["copies"][0]["position"].alias("position"), m["copies"].alias("copies"),
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its `words`-th word."""
    ends = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)
    return let(ends, lambda e: F.array_join(F.slice(e, 1, words.cast("int")), ""))


def training_set(docs: DataFrame, **parameters) -> DataFrame:
    """The mixed documents themselves, sorted by position: a row for each copy taken.

    Columns are those of `docs`. The one document of a source that its target cuts keeps
    its first words. Documents that are not taken are gone.
    """
    planned = plan(docs, **parameters)
    copies = planned.withColumn("__mix_copy", F.explode(F.filter(F.col("__mix")["copies"], lambda c: c["taken"] > 0)))
    c, m = F.col("__mix_copy"), F.col("__mix")
    cut = F.when(c["taken"] < m["size"], first_words(F.col("text"), c["taken"])).otherwise(F.col("text"))
    return copies.withColumn("text", cut).orderBy(c["position"], "doc_id").select(*docs.columns)
