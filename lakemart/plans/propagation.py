"""Changed rows pushed along the models.

Every write keeps the rows that appeared or vanished.  A model may say what its
rows follow from: a unit, which is one of its columns, and for each input the way
from the input's rows to units.  Then only the units that changed rows lead to are
derived again, from the input rows that lead to these units.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.session import stored

Read = Callable[[str], DataFrame]

#: Column that carries units and the values on the way to them.
VALUE = "_value"


def holding(df: DataFrame, values: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """Rows whose column holds one of the values."""
    return df.join(values.withColumnRenamed(VALUE, column), column, how)


def same_keys(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on all columns of `keys`, NULL being a key like any other."""
    renamed = keys.select(*[F.col(c).alias(f"_key_{c}") for c in keys.columns])
    return df.join(renamed, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in keys.columns], how)


@dataclass(frozen=True)
class Way:
    """From rows of an input to units: the input's column, and hops over other
    tables as (table, column that has the value, column of the next value)."""

    column: str
    hops: tuple[tuple[str, str, str], ...] = ()

    def first(self, rows: DataFrame) -> DataFrame:
        return rows.select(F.col(self.column).alias(VALUE))

    def units(self, rows: DataFrame, read: Read) -> DataFrame:
        """Units that rows of the input lead to."""
        values = self.first(rows).distinct()
        for table, column, onward in self.hops:
            found = read(table).select(F.col(column).alias(VALUE), F.col(onward).alias("_next")).join(values, VALUE, "left_semi")
            values = found.select(F.col("_next").alias(VALUE)).distinct()
        return values

    def rows(self, df: DataFrame, units: DataFrame, read: Read) -> DataFrame:
        """Rows of the input that lead to the units, the same hops walked back."""
        values = units
        for table, column, onward in reversed(self.hops):
            back = read(table).select(F.col(column).alias("_back"), F.col(onward).alias(VALUE)).join(values, VALUE, "left_semi")
            values = back.select(F.col("_back").alias(VALUE)).distinct()
        return self.among(df, values)

    def among(self, df: DataFrame, values: DataFrame) -> DataFrame:
        return holding(df, values, self.column)


@dataclass(frozen=True)
class Listed(Way):
    """A way that starts with several values in each row: `column` is the key of the
    row, and `values` makes a column of one value a row."""

    values: Callable[[], Column] | None = None

    def first(self, rows: DataFrame) -> DataFrame:
        return rows.select(self.values().alias(VALUE))

    def among(self, df: DataFrame, values: DataFrame) -> DataFrame:
        keys = df.select(self.column, self.values().alias(VALUE)).join(values, VALUE, "left_semi").select(self.column).distinct()
        return df.join(keys, self.column, "left_semi")


def way(column: str, *hops: str) -> Way:
    """``way("haku_oid", "applications haku_oid hakemus_oid")``"""
    return Way(column, tuple(tuple(h.split()) for h in hops))


@dataclass(frozen=True)
class Derivation:
    """The unit of a model and the ways to it.  An input without a way is read
    whole, and a change of it derives the whole model again.

    For rows of one unit the model must read no input rows but those that lead to it.
    """

    unit: str
    ways: dict[str, tuple[Way, ...]]

    def covers(self, changed: list[str]) -> bool:
        return all(name in self.ways for name in changed)

    def units(self, changes: dict[str, DataFrame], read: Read) -> DataFrame:
        """Units that the changed rows of the inputs lead to.  Hops go over what the
        tables on the way hold now and over the rows that they lost."""
        over = lambda name: read(name).unionByName(changes[name]) if name in changes else read(name)
        led = [w.units(rows, over) for name, rows in changes.items() for w in self.ways[name]]
        return stored(reduce(DataFrame.unionByName, led).distinct(), "units")

    def reader(self, units: DataFrame, read: Read) -> Read:
        """Inputs cut down to what leads to the units."""

        def cut(name: str) -> DataFrame:
            if name not in self.ways:
                return read(name)
            whole, ways = read(name), self.ways[name]
            if len(ways) == 1:
                return ways[0].rows(whole, units, read)
            # a row that several ways reach is there once
            found = [w.rows(whole, units, read).select(F.col(w.column).alias(VALUE)) for w in ways]
            return holding(whole, reduce(DataFrame.unionByName, found).distinct(), ways[0].column)

        return cut


def difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that only one of two frames of the same columns has, as often as it has
    them more."""
    columns = new.columns
    both = old.select(*columns).withColumn("_n", F.lit(-1)).unionByName(new.withColumn("_n", F.lit(1)))
    counts = both.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    return counts.withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.abs("_n").cast("int")))).select(*columns)


def fingerprint(df: DataFrame) -> str:
    """Content of a small table that has no versions, whatever the order of its rows."""
    h = F.xxhash64(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    n, x, s = df.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first()
    return f"{n}:{x}:{s}"
