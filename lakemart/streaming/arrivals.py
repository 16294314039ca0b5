"""File arrival as a stream.

Every run takes the files that arrived since the last one and then stops, so
a schedule of runs is the refresh cadence.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemart.sources.landing import explode_files


def arriving_files(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Whole-file texts with their paths; each file is seen once."""
    return (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
        .select("value", F.col("_metadata.file_path").alias("path"))
    )


def land_arrivals(
    spark: SparkSession, path: str, target: str, checkpoint: str, now: Column, files_per_batch: int = 1000
) -> StreamingQuery:
    """Append new files to the raw table as Parquet.

    A batch writes its own directory and replaces it when it is replayed
    after a failure, so a file is never landed twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        explode_files(batch, now).write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = (
        arriving_files(spark, path, files_per_batch)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def refresh_on_arrival(
    stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Run an idempotent step for every new batch, then stop."""
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start()
    query.awaitTermination()
    return query
