"""Change history: versions per key and the current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.keys import newest, surrogate_key
from lakemart.operators.latest import first_per_key, newest_per_key
from lakemart.operators.merge import matching, upsert

# metadata of the first delivery, kept when a history row is merged again
FIRST_SEEN = [
    "dw_metadata_dbt_copied_at",
    "dw_metadata_file_row_number",
    "dw_metadata_filename",
    "dw_metadata_source_timestamp_at",
    "dw_metadata_dw_stored_at",
]
COPIED = "dw_metadata_dbt_copied_at"


def one_copy(stage: DataFrame, keys: list[str], together: str | None = None, digest: tuple[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Of repeated deliveries of one key keep the last copied.  File name and
    row number make the choice between equal copies definite.

    ``together`` names a column by which the rows are shuffled, so that picking the
    newest version by that column needs no shuffle of its own: a column of the key, or
    one that a digest of the key is made of.  ``digest`` is a surrogate key with the
    columns it is made of; digests do not compress, so the shuffle carries the columns.
    """
    tie_break = [newest(c) for c in ("dw_metadata_filename", "dw_metadata_file_row_number") if c in stage.columns]
    rows = stage
    if together and digest:
        name, made = digest[0], surrogate_key(*digest[1])
        rows = stage.drop(name).repartition(made if together == name else F.col(together)).withColumn(name, made).select(*stage.columns)
    elif together:
        rows = stage.repartition(together)
    keys = keys if together is None or together in keys else [together, *keys]
    return first_per_key(rows, keys, newest(COPIED), *tie_break)


def merge_history(target: DataFrame | None, stage: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """Next version of a history table after one load."""
    batch = one_copy(stage, keys).withColumn("dw_metadata_dw_stored_at", now)
    return batch if target is None else upsert(target, batch, keys, FIRST_SEEN)


def hash_columns(df: DataFrame, prefix: str = "dw_metadata_") -> list[str]:
    """Content columns in name order: all but the metadata."""
    return sorted(c for c in df.columns if not c.startswith(prefix))


def hashed(stage: DataFrame, keys: list[str], now: Column) -> DataFrame:
    content = hash_columns(stage)
    return one_copy(stage, keys).withColumns(
        {
            "dw_metadata_hash": surrogate_key(*content),
            "dw_metadata_key": surrogate_key(*keys),
            "dw_metadata_timestamp": F.coalesce("dw_metadata_source_timestamp_at", COPIED),
            "dw_metadata_dw_stored_at": now,
        }
    )


def append_changes(target: DataFrame | None, stage: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """Append the rows whose content hash the history does not hold yet.

    The hash list is that of the whole table, so a change back to any earlier
    content is not recorded.
    """
    batch = hashed(stage, keys, now)
    if target is None:
        return batch
    # a hash is never NULL, so "not in" is a plain anti join; the stored hashes
    # are cut down to the incoming ones first
    known = matching(target.select("dw_metadata_hash"), batch, ["dw_metadata_hash"])
    fresh = batch.join(known, ["dw_metadata_hash"], "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def current_rows(history: DataFrame) -> DataFrame:
    """Latest version per key of a hashed history."""
    return newest_per_key(history, ["dw_metadata_key"], "dw_metadata_timestamp", "dw_metadata_dw_stored_at")
