"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # parsing JSON is slow per byte, so small partitions are worth their task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    # a key that holds a large share of a table is split over tasks, even
    # where that costs one more exchange for the operator above the join
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a union that keeps its inputs' partitioning zips their partitions, and fails
    # where one input is itself a union and has more of them
    "spark.sql.unionOutputPartitioning": "false",
    # a task sorts what it reads, so its share stays the same however large the table:
    # many partitions, of which small ones are put together
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    # tables of many small buckets are listed by a few tasks, not by one for each directory
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # documents and digests take about half the disk of the default codec
    "spark.sql.parquet.compression.codec": "zstd",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that every job here relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "lakemart", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a session of one process may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="lakemart-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder.  All of an application's paths share
    one folder, which can be removed when the application has ended."""
    return f"{shared_folder(spark)}/lakemart/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store a frame in the shared folder so that later steps restart from it
    and do not recompute its inputs when an executor is lost."""
    spark = df.sparkSession
    context = spark.sparkContext
    folder = shared_folder(spark)
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(folder)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared folder and read it back.  Unlike a
    checkpoint the result has a known size, so Spark can choose to broadcast it."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
