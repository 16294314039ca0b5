"""Where query modules register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakemart.session import tune
from lakemart.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Source:
    """The tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        df = read_table(self.spark, self.folder, name)
        setattr(self, name, df)
        return df


def query(sql: str | None = None):
    """Register a function of (tables) under its own name, with its SQL."""

    def register(fn: Callable[[Source], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Source(tune(spark), folder))

        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register
