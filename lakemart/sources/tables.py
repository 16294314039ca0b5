"""Named tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_seed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV lookup with a header and declared types."""
    return spark.read.csv(path, header=True, schema=schema)
