"""Named input tables, read lazily from one Parquet file or folder per table."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.session import configure
from martloom.sources.retail_views import RETAIL_VIEWS, WAREHOUSES

STAR_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


class TableSet(Mapping[str, DataFrame]):
    """Tables built on first use, so a plan only touches what it names."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def replacing(self, **frames: DataFrame) -> TableSet:
        """The same set with some tables swapped or added."""
        out = TableSet({**self._builders, **{k: (lambda v=v: v) for k, v in frames.items()}})
        out._built = {k: v for k, v in self._built.items() if k not in frames}
        return out


def star_tables(spark: SparkSession, folder: str) -> TableSet:
    configure(spark)
    return TableSet({n: (lambda n=n: load_table(spark, folder, n)) for n in STAR_TABLES})


def retail_tables(spark: SparkSession, folder: str) -> TableSet:
    """The source tables of the retail model, mapped from the star-schema files."""
    star = star_tables(spark, folder)

    def build(text: str) -> DataFrame:
        text = text.replace("EXPLODE_WAREHOUSES", WAREHOUSES["spark"])
        used = {name: star[name] for name in set(re.findall(r"\{(\w+)\}", text))}
        return spark.sql(text, **used)

    return TableSet({name: (lambda text=text: build(text)) for name, text in RETAIL_VIEWS.items()})


def catalog_tables(spark: SparkSession, layers: Mapping[str, str]) -> TableSet:
    """Managed tables by short name, e.g. `{"orders": "retail_bronze.orders"}`."""
    return TableSet({name: (lambda full=full: spark.table(full)) for name, full in layers.items()})


_AS_OF: dict[tuple[str, str], dt.date] = {}


def latest_order_date(spark: SparkSession, folder: str) -> dt.date:
    """Default as-of date: the newest order date. One narrow scan per folder and session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _AS_OF:
        _AS_OF[key] = load_table(spark, folder, "orders").agg(F.max(F.col("o_orderdate").cast("date"))).first()[0]
    return _AS_OF[key]
