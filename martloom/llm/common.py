"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One word: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows that a Python worker and the JVM hold at once.
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Send whole texts to Python in batches of BATCH_ROWS, or fewer where the session says so."""
    now = int(spark.conf.get(_BATCH_CONF))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row.

    A lambda of a higher-order function evaluates whatever it refers to for each
    element; bound as the variable of an outer lambda, the value is computed once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True for rows whose crc32(id as text) leaves `fold`. A null id has the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold
