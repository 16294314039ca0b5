"""CSV export of published tables with a manifest."""

from __future__ import annotations

import csv
import gzip
import io
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakemart.sinks.versions import Tables

#: The part that holds the column names.
HEADER = "header.csv.gz"


def export_csv(df: DataFrame, path: str) -> None:
    """One compressed CSV file in parts, to a path that is not there yet.

    Every part is a member of one gzip stream, and only the first has a header: the
    parts one after the other, in the order of `parts_of`, are the file, and no
    task has to read or write all of it.
    """
    df.write.mode("errorifexists").option("header", False).option("compression", "gzip").option("quoteAll", False).option(
        "escape", '"'
    ).csv(path)
    names = io.StringIO()
    csv.writer(names, lineterminator="\n").writerow(df.columns)
    write_bytes(df.sparkSession, f"{path}/{HEADER}", gzip.compress(names.getvalue().encode("utf-8")))


def read_export(spark: SparkSession, path: str, parts: list[str], schema: T.StructType) -> DataFrame:
    """The rows of the listed parts of an export."""
    return spark.read.schema(schema).csv([f"{path}/{p}" for p in parts if p != HEADER], escape='"')


def parts_of(spark: SparkSession, path: str) -> list[str]:
    """Names of the written parts, in order, the header first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [s.getPath().getName() for s in found]
    return [n for n in names if n == HEADER] + sorted(n for n in names if n.startswith("part-"))


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.create(fs_path, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_bytes(spark, path, text.encode("utf-8"))


def export_layers(tables: Tables, layers: list[str], target: str) -> dict[str, dict]:
    """Export every table of the layers, their schemas, and one manifest per
    layer: ``{schema: {key, version}, tables: [{key, version, parts}]}``.

    Each export of a table goes to a folder of its version, whose parts the
    manifest lists, so an earlier export stays whole until the manifest that
    names the new one is written.
    """
    spark = tables.spark
    manifests = {}
    for layer in layers:
        schemas, entries = {}, []
        for name in tables.names(layer):
            df = tables.read(name)
            version = tables.version(name)
            key = f"{layer.rstrip('_')}/{name}.csv.gz/v={version}-{uuid.uuid4().hex[:8]}"
            export_csv(df, f"{target}/{key}")
            schemas[name] = df.schema.jsonValue()
            entries.append({"key": key, "version": version, "parts": parts_of(spark, f"{target}/{key}")})
        schema_key = f"{layer.rstrip('_')}/schema.json"
        write_text(spark, f"{target}/{schema_key}", json.dumps(schemas))
        version = max((e["version"] for e in entries), default=0)
        manifests[layer] = {"schema": {"key": schema_key, "version": version}, "tables": entries}
        write_text(spark, f"{target}/{layer.rstrip('_')}/manifest.json", json.dumps(manifests[layer]))
    return manifests
