"""Run log of loads, and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.merge import upsert


def empty_runs(spark: SparkSession) -> DataFrame:
    return spark.range(0).selectExpr("CAST(id AS STRING) AS model", "CAST(NULL AS TIMESTAMP) AS start_time")


def empty_completed(spark: SparkSession) -> DataFrame:
    return spark.range(0).selectExpr(
        "CAST(id AS STRING) AS model", "CAST(id AS STRING) AS raw_table", "CAST(NULL AS TIMESTAMP) AS start_time", "true AS execute"
    )


def start(runs: DataFrame, models: list[str], now: Column) -> DataFrame:
    """Note the start of loads; one row per model."""
    names = F.explode(F.array(*[F.lit(m) for m in models]))
    rows = runs.sparkSession.range(1).select(names.alias("model"), now.alias("start_time"))
    return upsert(runs, rows, ["model"])


def complete(completed: DataFrame, runs: DataFrame, models: list[str]) -> DataFrame:
    """Copy the start times of finished loads.  A new model is not yet allowed
    to be cleaned up; an operator sets ``execute`` once."""
    rows = runs.filter(F.col("model").isin(*models)).select(
        "model",
        F.regexp_replace("model", "^stg_", "").alias("raw_table"),
        "start_time",
        F.lit(False).alias("execute"),
    )
    return upsert(completed, rows, ["model"], keep=["execute", "raw_table"])


def watermark(completed: DataFrame, raw_table: str, default):
    """Start of the last completed load of a table."""
    row = completed.filter(F.col("raw_table") == raw_table).agg(F.max("start_time")).first()[0]
    return default if row is None else row


def retain(df: DataFrame, completed: DataFrame, raw_table: str, time: str = "dw_metadata_dbt_copied_at") -> DataFrame:
    """Rows that cleanup leaves: all, unless the table is released for it;
    then those copied since the last completed start, and undated ones."""
    allowed = completed.filter((F.col("raw_table") == raw_table) & F.col("execute"))
    limit = allowed.agg(F.max("start_time")).first()[0]
    return df if limit is None else df.filter((F.col(time) >= F.lit(limit)) | F.col(time).isNull())
