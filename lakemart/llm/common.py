"""Helpers the corpus operators share."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakemart import session
from lakemart.session import tune
from lakemart.sources.tables import read_table

#: Rows in one Arrow batch; documents can be long, so batches are kept small.
BATCH_ROWS = 1000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared folder and read it back; the shuffle files
    of the steps before it are let go."""
    out = session.stored(df, name)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, wherever they run; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        file = Path(tempfile.mkdtemp(prefix="lakemart-code-"), f"{package.name}.zip")
        with zipfile.ZipFile(file, "w") as out:
            for module in sorted(package.rglob("*.py")):
                out.write(module, module.relative_to(package.parent))
        context.addPyFile(str(file))
        _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Set a session up for Python workers and Arrow batches of documents."""
    ship(spark)
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder."""
    return read_table(prepare(spark), folder, name)


_resident: dict[object, object] = {}


def resident(key: object, make: Callable[[], object]) -> object:
    """What a Python worker keeps from task to task: one object at a time, so the
    caches of one operator do not stay beside the work of the next."""
    if key not in _resident:
        _resident.clear()
        _resident[key] = make()
    return _resident[key]


def release() -> None:
    """Let go what the worker has kept for another operator."""
    if _resident:
        _resident.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()


def per_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, Iterable]], added: str, keep: list[str] | None = None) -> DataFrame:
    """Add columns that a function computes from each Arrow batch.

    `keep` names the columns of the input that stay (all by default); a kept
    column that has the name of an added one is replaced.
    """
    new = T.StructType.fromDDL(added)
    names = {f.name.lower() for f in new}
    kept = [f for f in df.schema if f.name.lower() not in names and (keep is None or f.name in keep)]
    schema = T.StructType([*kept, *new])
    arrow = to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                columns = [batch.column(f.name) for f in kept] + [pa.array(out[f.name], type=f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column as strings; null counts as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def gapless(df: DataFrame, by: list[str], order: list[str], name: str, rows_per_cell: int = 2_000) -> DataFrame:
    """Number the rows of each group from 0 without gaps.

    A group may hold any share of the table: its rows are dealt by a hash over as
    many cells as its size asks for, each cell is numbered by itself, and the
    sizes of the cells before it are added.  Only the table of cell sizes, which
    has about one row for `rows_per_cell` rows, is sorted by group.  `df` is read
    several times, so it should be a stored table.
    """
    keys = [f"_{c}" for c in by]
    named = [F.col(c).alias(k) for c, k in zip(by, keys)]
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(by, keys)]
    cells = F.ceil(F.count(F.lit(1)) / rows_per_cell).alias("_cells")
    wanted = stored(df.groupBy(*named).agg(cells), "cells")
    dealt = df.join(wanted, same).withColumn("_cell", F.pmod(F.xxhash64(*order), F.col("_cells"))).drop("_cells")
    before = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(*keys, F.col("_cell").alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    place = Window.partitionBy(*by, "_cell").orderBy(*order)
    numbered = dealt.drop(*keys).withColumn("_row", F.row_number().over(place) - 1)
    joined = numbered.join(starts, [F.col("_cell") == F.col("_at"), *same])
    return joined.withColumn(name, (F.col("_start") + F.col("_row")).cast("long")).drop("_cell", "_at", "_start", "_row", *keys)


__all__ = ["BATCH_ROWS", "gapless", "per_batch", "prepare", "release", "resident", "ship", "stored", "table", "texts"]
