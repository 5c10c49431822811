"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of slots. Only the slots, a few thousand
numbers, are balanced: a slot-to-shard map says where each slot lives, and
rebalancing edits that map. Maps are stored as versions, so a reader can tell
where a record lay before and after an edit, and only moved slots are copied.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.session import materialize, scratch_path

#: Number of virtual slots; what reaches the driver has this many rows at most.
SLOTS = 4096
#: Bytes a record takes besides its text.
RECORD_BYTES = 16
#: Equal records that are dealt out by one task.
REPEATS = 1000


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_BYTES).cast("long")


def even_map(slots: int, shards: int) -> list[int]:
    """The first version: slots dealt in turn."""
    return [s % shards for s in range(slots)]


def rebalance(shard_of: Sequence[int], weights: Sequence[int], shards: int) -> list[int]:
    """An edited map whose shards carry nearly equal weight.

    Moves one slot, or swaps two, between the fullest and the emptiest shard as
    long as that brings the two closer. Slots that are not touched stay where they
    are. `shards` may differ from the number the map was made for: new shards start
    empty, slots of removed shards are first put on the emptiest shard.
    """
    result = list(shard_of)
    load = [0] * shards
    members: list[set[int]] = [set() for _ in range(shards)]
    homeless = []
    for slot, shard in enumerate(result):
        if shard < shards:
            load[shard] += weights[slot]
            members[shard].add(slot)
        else:
            homeless.append(slot)

    def put(slot: int, shard: int) -> None:
        result[slot] = shard
        members[shard].add(slot)
        load[shard] += weights[slot]

    def take(slot: int) -> None:
        members[result[slot]].remove(slot)
        load[result[slot]] -= weights[slot]

    for slot in sorted(homeless, key=lambda s: (-weights[s], s)):
        put(slot, min(range(shards), key=lambda s: (load[s], s)))
    def step() -> bool:
        """One move or swap from the fullest shard that can give something to the emptiest."""
        low = min(range(shards), key=lambda s: (load[s], s))
        for high in sorted(range(shards), key=lambda s: (-load[s], s)):
            gap = load[high] - load[low]
            if gap <= 0:
                return False
            moves = [(weights[a], a, None) for a in members[high] if 0 < weights[a] < gap]
            moves += [
                (weights[a] - weights[b], a, b)
                for a in members[high]
                for b in members[low]
                if 0 < weights[a] - weights[b] < gap
            ]
            if not moves:
                continue  # one heavy slot: nothing of it can move
            _, a, b = min(moves, key=lambda m: (abs(2 * m[0] - gap), m[1], -1 if m[2] is None else m[2]))
            take(a)
            if b is not None:
                take(b)
                put(b, high)
            put(a, low)
            return True
        return False

    while step():
        pass
    return result


def map_frame(spark: SparkSession, version: int, shard_of: Sequence[int], first: Sequence[int]) -> DataFrame:
    """The map as a table: version, virtual slot, shard, rows of the shard before this slot."""
    rows = [{"v_slot": s, "shard": shard, "first": first[s]} for s, shard in enumerate(shard_of)]
    parsed = F.from_json(F.lit(json.dumps(rows)), "array<struct<v_slot:int,shard:int,first:bigint>>")
    return spark.range(1).select(F.explode(parsed).alias("r")).select(F.lit(version).alias("version"), "r.*")


def save_map(spark: SparkSession, root: str, version: int, shard_of: Sequence[int], rows: Sequence[int]) -> None:
    """Add a version; earlier ones stay. `rows` counts the records of each slot."""
    first, filled = [], {}
    for slot, shard in enumerate(shard_of):
        first.append(filled.get(shard, 0))
        filled[shard] = first[-1] + rows[slot]
    map_frame(spark, version, shard_of, first).coalesce(1).write.mode("errorifexists").parquet(f"{root}/v{version}")


def load_map(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{root}/v{version}")


def _with_turn(records: DataFrame) -> DataFrame:
    """The records with `turn`: 0, 1, 2, ... for equal ones.

    Equal records are counted, which combines before the shuffle, and made again from
    their number, REPEATS of them in a task: a record repeated any number of times is dealt
    to all slots like so many different ones, the same way in any run.
    """
    counted = records.groupBy(*records.columns).count()
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("count") - 1) / REPEATS).cast("long")))
    parts = counted.withColumn("part", part).repartition(*records.columns, "part")
    first = F.col("part") * REPEATS
    turn = F.explode(F.sequence(first, F.least(first + REPEATS, F.col("count")) - 1))
    return parts.withColumn("turn", turn).drop("count", "part")


def shard(docs: DataFrame, shards: int, root: str | None = None, slots: int = SLOTS) -> DataFrame:
    """Every document with its shard, so that the shards hold nearly the same bytes.

    Returns doc_id, size, text_crc32, law, shard, slot (position in the shard, without
    gaps), grown_shard (null: bytes decide here, not the id alone) and v_slot.
    `root` is the folder of the map versions: v0 deals the slots in turn, v1 is edited
    to the measured bytes.

    A null text has no bytes and the checksum of the empty text. Null ids are spread by
    the checksum. Rows that are equal in id, size and checksum are spread by their number.
    An empty table gives no rows. Other columns of `docs` are not read.
    """
    spark = docs.sparkSession
    root = root or scratch_path(spark, "slot-map")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    records = materialize(
        _with_turn(docs.select("doc_id", record_size(F.col("text")).alias("size"), crc.alias("text_crc32"))).withColumn(
            "v_slot", F.pmod(F.xxhash64("doc_id", "text_crc32", "turn"), F.lit(slots)).cast("int")
        ),
        "slots",
    )
    measured = records.groupBy("v_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    weights, rows = [0] * slots, [0] * slots
    for r in measured:
        weights[r.v_slot], rows[r.v_slot] = r.bytes, r.rows
    first = even_map(slots, shards)
    save_map(spark, root, 0, first, rows)
    save_map(spark, root, 1, rebalance(first, weights, shards), rows)
    # the map has `slots` rows whatever the input holds
    placed = records.join(F.broadcast(load_map(spark, root, 1)), "v_slot")
    turn = Window.partitionBy("v_slot").orderBy("doc_id", "text_crc32", "size", "turn")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.row_number().over(turn) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "v_slot",
    )
