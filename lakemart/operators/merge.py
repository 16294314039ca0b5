"""Target-table changes as DataFrames: the result is the next table version.

Matching uses anti and semi joins against the incoming keys.  When the batch
is a stored frame that is small, Spark broadcasts its keys and the target is
only scanned, never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def align(df: DataFrame, like: DataFrame) -> DataFrame:
    """Column order of the target, with its new columns appended."""
    return df.select(*like.columns, *[c for c in df.columns if c not in like.columns])


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Append; columns missing on either side are filled with NULL."""
    return target.unionByName(batch, allowMissingColumns=True)


def refuse_repeats(batch: DataFrame, keys: list[str]) -> DataFrame:
    """No rows, in the columns of the batch; reading them fails if a key repeats.
    Only keys are shuffled.  Rows with a NULL in the key match nothing and may repeat."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = batch.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    refused = F.raise_error(F.concat(F.lit(f"repeated key in a merge on {', '.join(keys)}: "), shown)).cast("boolean")
    none = counts.filter(F.when(F.col("_n") > 1, refused).otherwise(F.lit(False)))
    return none.select(*[F.col(f.name) if f.name in keys else F.lit(None).cast(f.dataType).alias(f.name) for f in batch.schema])


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], keep: list[str] | None = None) -> DataFrame:
    """Update matched rows, insert the others; a batch that has a key twice is refused.

    ``keep`` lists the columns in which a matched row keeps its old value.
    """
    none = refuse_repeats(batch, keys)
    keep = [c for c in keep or [] if c in target.columns and c in batch.columns and c not in keys]
    untouched = target.join(batch.select(*keys), keys, "left_anti")
    if keep:
        old = matching(target, batch, keys).select(
            *keys, F.lit(True).alias("_matched"), *[F.col(c).alias(f"_old_{c}") for c in keep]
        )
        batch = batch.join(old, keys, "left").withColumns(
            {c: F.when(F.col("_matched"), F.col(f"_old_{c}")).otherwise(F.col(c)) for c in keep}
        ).drop("_matched", *[f"_old_{c}" for c in keep])
    return untouched.unionByName(batch, allowMissingColumns=True).unionByName(none, allowMissingColumns=True)


def replace_keys(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Delete the rows of all incoming keys, then insert the batch.  Keys may
    repeat on both sides."""
    return target.join(batch.select(*keys), keys, "left_anti").unionByName(batch, allowMissingColumns=True)


def replace_changed(target: DataFrame, changed: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Delete the rows of the changed keys, then append; a changed key without
    new rows disappears."""
    return target.join(changed.select(*keys), keys, "left_anti").unionByName(batch, allowMissingColumns=True)


def purge(target: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """Delete the rows that match a condition frame."""
    return target.join(doomed.select(*keys), keys, "left_anti")


def mark_deleted(
    target: DataFrame,
    batch: DataFrame,
    parent: list[str],
    keys: list[str],
    flag: str = "poistettu",
    changed: DataFrame | None = None,
) -> DataFrame:
    """Re-delivered parents: their old rows are flagged as deleted unless the
    batch brings them again.  ``changed`` names the parents if some come
    without rows."""
    parents = (batch if changed is None else changed).select(*parent).distinct().withColumn("_again", F.lit(True))
    flagged = target.join(parents, parent, "left").withColumn(
        flag, F.when(F.col("_again"), F.lit(True)).otherwise(F.col(flag))
    ).drop("_again")
    return upsert(flagged, batch, keys)


def matching(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows of the incoming keys.  A small batch is broadcast, so what
    is joined afterwards is as small as the batch, not as the target."""
    return target.join(batch.select(*keys), keys, "left_semi")


def only_newer(batch: DataFrame, target: DataFrame, keys: list[str], time: str, target_time: str | None = None) -> DataFrame:
    """Drop incoming rows that are not newer than the stored row of their key."""
    stored = matching(target, batch, keys).select(*keys, F.col(target_time or time).alias("_stored"))
    newer = F.col("_stored").isNull() | (F.col(time) > F.col("_stored"))
    return batch.join(stored, keys, "left").filter(newer).drop("_stored")


def above(df: DataFrame, time: str, mark, inclusive: bool = False, or_null: bool = False, overlap: Column | None = None) -> DataFrame:
    """Rows past a high-water mark, optionally from a margin before it."""
    limit = F.lit(mark)
    if overlap is not None:
        limit = limit - overlap
    keep = F.col(time) >= limit if inclusive else F.col(time) > limit
    return df.filter(keep | F.col(time).isNull() if or_null else keep)


def high_water_mark(target: DataFrame | None, time: str, default):
    """Newest time stored in the target, or the default for an empty one.

    Read eagerly, so that the filter is a constant that reaches the scan.
    """
    if target is None:
        return default
    value = target.agg(F.max(time)).first()[0]
    return default if value is None else value
