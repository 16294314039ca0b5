"""Which hashes a history may hold already, without reading the history.

Beside every write stands a Bloom filter of the hashes that it added, as rows of
four 64-bit words.  All bits of a hash are in one row, so a hash asks one row of a
filter.  A hash one of whose bits is missing in every filter is new; only the others
are looked up in the history itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.session import stored
from lakemart.sinks.versions import Tables

#: Bits for each hash, and words of a row; a hash sets two bits in each word, so about 1 in 400 is taken for known.
BITS, WORDS = 16, 4


def _row(value: Column, size: int) -> Column:
    """The row of a filter of so many bits in which all bits of a hash are."""
    return F.pmod(F.xxhash64(value, F.lit(0)), F.lit(size // (64 * WORDS)).cast("long"))


def _bits(value: Column, word: int) -> Column:
    """The bits of a hash in one word of its row."""
    places = F.xxhash64(value, F.lit(1))
    first, second = (F.shiftright(places, 12 * word + n).bitwiseAND(F.lit(63)).cast("int") for n in (0, 6))
    one = F.lit(1).cast("long")
    return F.call_function("shiftleft", one, first).bitwiseOR(F.call_function("shiftleft", one, second))


def filter_of(hashes: DataFrame, column: str) -> DataFrame:
    """(size, word, bits0, bits1, ...) of the filter of a column; equal hashes count once."""
    n = hashes.count()
    size = 64 * WORDS
    while size < BITS * n:
        size *= 2
    held = hashes.select(_row(F.col(column), size).alias("word"), *[_bits(F.col(column), w).alias(f"bits{w}") for w in range(WORDS)])
    words = held.groupBy("word").agg(*[F.bit_or(f"bits{w}").alias(f"bits{w}") for w in range(WORDS)])
    return words.select(F.lit(size).cast("long").alias("size"), "*")


def maybe_known(hashes: DataFrame, column: str, filters: DataFrame) -> DataFrame:
    """The hashes that some filter (write, size, word, bits0, ...) has all bits of."""
    sizes = [r[0] for r in filters.select("size").distinct().collect()]  # powers of two, so a few dozen at most
    asked = [hashes.select(column, F.lit(size).cast("long").alias("size"), _row(F.col(column), size).alias("word")) for size in sizes]
    if not asked:
        return hashes.limit(0).select(column)
    hit = filters.join(reduce(DataFrame.unionByName, asked), ["size", "word"])
    for w in range(WORDS):
        wanted = _bits(F.col(column), w)
        hit = hit.filter(F.col(f"bits{w}").bitwiseAND(wanted) == wanted)
    return hit.select(column).distinct()


class Known:
    """A stored history of rows with a hash, and the filters beside it."""

    def __init__(self, tables: Tables, name: str, column: str):
        self.tables, self.name, self.column = tables, name, column
        self.filters = f"{name}_filter"

    def fresh(self, batch: DataFrame) -> tuple[DataFrame, int]:
        """Rows of the batch whose hash the history does not hold, and how many hashes
        had to be looked up in it; it is not read if there are none."""
        if not self.tables.exists(self.name):
            return batch, 0
        hashes = batch.select(self.column).distinct()
        suspected = stored(maybe_known(hashes, self.column, self.tables.read(self.filters)), "suspected")
        looked_up = suspected.count()
        if not looked_up:
            return batch, 0
        held = self.tables.read(self.name).select(self.column).join(suspected, self.column, "left_semi").distinct()
        return batch.join(held, self.column, "left_anti"), looked_up

    def add(self, rows: DataFrame) -> None:
        """Store new rows.  The filter comes first: without its rows it only makes
        some hashes be looked up in vain."""
        rows = stored(rows, self.name)
        hashes = rows.select(self.column).distinct()
        write = (self.tables.version(self.filters) or 0) + 1
        self.tables.add(self.filters, filter_of(hashes, self.column).withColumn("write", F.lit(write).cast("long")))
        self.tables.add(self.name, rows)
