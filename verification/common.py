"""What every registered query starts from."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from martloom.plans.lakehouse import lakehouse
from martloom.sources.tables import TableSet, latest_order_date, retail_tables, star_tables


@dataclass
class Inputs:
    spark: SparkSession
    folder: str
    star: TableSet = field(init=False)
    source: TableSet = field(init=False)
    as_of: dt.date = field(init=False)
    t: TableSet = field(init=False)

    def __post_init__(self) -> None:
        self.star = star_tables(self.spark, self.folder)
        self.source = retail_tables(self.spark, self.folder)
        self.as_of = latest_order_date(self.spark, self.folder)
        self.t = lakehouse(self.spark, self.source, self.as_of)


class Registry:
    """Query name -> (Spark builder, comparison SQL or None)."""

    def __init__(self) -> None:
        self.queries: dict = {}
        self.oracle: dict[str, str] = {}

    def add(self, name: str, build, oracle: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Inputs(spark, folder))

        self.queries[name] = run
        if oracle is not None:
            self.oracle[name] = oracle
