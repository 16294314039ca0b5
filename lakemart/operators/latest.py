"""Pick one version, or the newest versions, of every key.

``row_number() = 1`` and ``rank() = 1`` filters are planned by Spark with a
group limit before the exchange: every task sends at most one row (or the
tied rows) of a key, so a key that holds much of the table costs no more
shuffle than a small one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.keys import as_col, newest

_N = "_position"


def first_per_key(df: DataFrame, keys: list[Column | str], *order: Column) -> DataFrame:
    """First row of each key in the given order (DISTINCT ON)."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_N, F.row_number().over(window)).filter(F.col(_N) == 1).drop(_N)


def newest_per_key(df: DataFrame, keys: list[Column | str], *times: str) -> DataFrame:
    """Row with the newest times per key, NULL times winning."""
    return first_per_key(df, keys, *[newest(t) for t in times])


def newest_with_ties(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Rows for which no row of the same key is strictly newer.

    Equal newest rows all stay, and so do rows without a time, or without a
    key, since neither can be compared with another row.
    """
    comparable = F.col(time).isNotNull()
    for key in keys:
        comparable = comparable & F.col(key).isNotNull()
    window = Window.partitionBy(*keys).orderBy(F.col(time).desc())
    ranked = df.filter(comparable).withColumn(_N, F.rank().over(window)).filter(F.col(_N) == 1).drop(_N)
    return ranked.unionByName(df.filter(~comparable))


def rows_at_maximum(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows whose value equals the maximum of their key."""
    window = Window.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last())
    ranked = df.withColumn(_N, F.rank().over(window)).filter(F.col(_N) == 1).drop(_N)
    return ranked.filter(F.col(value).isNotNull())


def with_maximum_flag(df: DataFrame, keys: list[str], value: str, flag: str) -> DataFrame:
    """Mark the rows whose value equals the maximum of their key.

    The maximum is a partially aggregated group-by joined back, not a window
    over whole groups; a hot key is split by the adaptive skew join.
    """
    top = df.groupBy(*[as_col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max(value).alias("_top"))
    match = [as_col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = df.join(top, match, "left")
    return joined.withColumn(flag, F.col(value) == F.col("_top")).drop("_top", *[f"_k{i}" for i in range(len(keys))])


def last_of_peers(df: DataFrame, keys: list[str], order: str, value: str, out: str, *ties: str) -> DataFrame:
    """Running last value in the default frame: the frame ends with the rows
    that share the order value, so it is the last value among those peers in the
    order of `ties`.  NULL keys and NULL order values are peers of their own."""
    names = {c: f"_k{i}" for i, c in enumerate([*keys, order])}
    last = df.groupBy(*[F.col(c).alias(n) for c, n in names.items()]).agg(F.max(F.struct(*(ties or [value]), F.col(value).alias("_last"))).alias("_top"))
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return df.join(last, same, "left").withColumn(out, F.col("_top._last")).drop("_top", *names.values())
