"""JSON-array files to raw rows: one row per array element.

File names carry the table, the export time and the source:
``<source>/<table>__<yyyy-MM-dd_HH.mm.ssX>__<anything>.json``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("data", T.StringType()),
        T.StructField("dw_metadata_source_timestamp_at", T.TimestampType()),
        T.StructField("dw_metadata_dbt_copied_at", T.TimestampType()),
        T.StructField("dw_metadata_filename", T.StringType()),
        T.StructField("dw_metadata_file_row_number", T.IntegerType()),
    ]
)


def empty_raw(spark: SparkSession) -> DataFrame:
    """A raw table before its first file."""
    return spark.createDataFrame([], ENVELOPE)


def label(path: Column) -> Column:
    """Path part that names table and time: the file, or the folder of its parts."""
    return F.url_decode(F.element_at(F.filter(F.split(path, "/"), lambda p: p.contains("__")), -1))


def file_name(path: Column) -> Column:
    """Path from the label on, without the folders before it."""
    parts = F.split(F.url_decode(path), "/")
    place = F.array_position(parts, label(path)).cast("int")
    return F.array_join(F.slice(parts, place, F.size(parts)), "/")


def source_of(path: Column) -> Column:
    """Folder that holds the file (or the folder of its parts)."""
    parts = F.split(F.url_decode(path), "/")
    place = F.array_position(parts, label(path)).cast("int")
    return F.when(place > 1, F.try_element_at(parts, place - 1))


def table_of(path: Column) -> Column:
    return F.split_part(label(path), F.lit("__"), F.lit(1))


def exported_at(path: Column) -> Column:
    return F.to_timestamp(F.split_part(label(path), F.lit("__"), F.lit(2)), "yyyy-MM-dd_HH.mm.ssX")


def _envelope(rows: DataFrame, now: Column) -> DataFrame:
    return rows.select(
        "data",
        exported_at(F.col("path")).alias("dw_metadata_source_timestamp_at"),
        now.alias("dw_metadata_dbt_copied_at"),
        file_name(F.col("path")).alias("dw_metadata_filename"),
        F.col("number").cast("int").alias("dw_metadata_file_row_number"),
        source_of(F.col("path")).alias("source"),
        table_of(F.col("path")).alias("raw_table"),
    )


def explode_files(files: DataFrame, now: Column) -> DataFrame:
    """Whole-file texts (columns ``value`` and ``path``) to raw rows.

    An empty file counts as an empty array.
    """
    body = F.when(F.trim("value") == "", F.lit("[]")).otherwise(F.col("value"))
    rows = files.select("path", F.posexplode(F.from_json(body, "array<string>")).alias("pos", "data"))
    return _envelope(rows.withColumn("number", F.col("pos") + 1), now)


def land_files(spark: SparkSession, path: str, now: Column) -> DataFrame:
    """Read array files; one file is one task, so export large tables in
    chunks (see ``lakemart.sinks.chunks``)."""
    files = (
        spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).load(path)
        .select("value", F.col("_metadata.file_path").alias("path"))
    )
    return explode_files(files, now)


def land_element_lines(spark: SparkSession, path: str, now: Column) -> DataFrame:
    """Read huge array files whose lines hold whole elements: one, several, or
    none where separators stand on lines of their own.

    Lines are split over tasks like any text file; a line that is not a list of
    whole objects is refused.  Elements are numbered as they come out of a file
    block; the few block counts are summed up per file and joined back, so no
    file is ordered as a whole.
    """
    lines = (
        spark.read.format("text").option("recursiveFileLookup", True).load(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
        )
    )
    # what stands between the separators of the array and its brackets
    core = F.regexp_replace("value", r"^[\s,\[]+|[\s,\]]+$", "")
    whole = core.startswith("{") & core.endswith("}")
    listed = F.from_json(F.concat(F.lit("["), core, F.lit("]")), "array<string>", {"mode": "FAILFAST"})
    refused = F.raise_error(F.concat(F.lit("not a list of whole objects: "), F.col("path"))).cast("array<string>")
    none = F.array().cast("array<string>")
    elements = lines.select("path", "block", F.explode(F.when(core == "", none).when(whole, listed).otherwise(refused)).alias("data"))
    marked = elements.withColumn("line", F.monotonically_increasing_id()).withColumn("slot", F.shiftright("line", 33))
    blocks = marked.groupBy("path", "block", "slot").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("first"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "path", "block", "slot", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")
    )
    numbered = marked.join(offsets, ["path", "block", "slot"]).withColumn(
        "number", F.col("line") - F.col("first") + F.col("offset") + 1
    )
    return _envelope(numbered, now)
