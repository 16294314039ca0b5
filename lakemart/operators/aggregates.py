"""Aggregates used by the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.session import stored


def count_where(condition: Column) -> Column:
    """How many rows meet a condition; unknown counts as not met."""
    return F.sum(F.when(condition, 1).otherwise(0))


def sum_where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def any_set(flag: Column) -> Column:
    """Whether the 0/1 flag is set in any row of the group."""
    return F.sum(flag.cast("int")) > 0


def distinct_records(condition: Column | None, *fields: Column) -> Column:
    """Set of distinct records that meet a condition, empty if none does,
    in a fixed order."""
    row = F.struct(*fields)
    return F.array_sort(F.collect_set(row if condition is None else F.when(condition, row)))


def dense_numbers(values: DataFrame, column: str, name: str) -> DataFrame:
    """Each distinct value with a number of its own, from 0 without gaps.

    Every task numbers its values, and the few counts of the tasks before it are
    added; nothing is sorted.  NULL gets no number.
    """
    known = values.filter(F.col(column).isNotNull()).select(column).distinct()
    marked = stored(known.withColumn("_id", F.monotonically_increasing_id()), "numbers")
    slot, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = marked.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_n"))
    # one row for each task
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return marked.withColumn("_slot", slot).join(starts, "_slot").select(column, (F.col("_start") + place).alias(name))


def bitmaps(rows: DataFrame, cells: list[str], number: str) -> DataFrame:
    """Who is in each cell, exactly: bitmaps of dense numbers, one for each run of 32768
    of them.  Partial bitmaps are made before the shuffle, so a person costs one bit
    however often they occur.  Worth it where cells hold a good part of the numbers."""
    known = rows.filter(F.col(number).isNotNull())
    return known.groupBy(*cells, F.bitmap_bucket_number(number).alias("run")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def rolled_up(bits: DataFrame, cells: list[str]) -> DataFrame:
    """The same for fewer, larger cells: bitmaps are united, no row is read again."""
    return bits.groupBy(*cells, "run").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(bits: DataFrame, cells: list[str], name: str) -> DataFrame:
    """Distinct numbers of each cell."""
    return bits.groupBy(*cells).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))


def object_per_key(df: DataFrame, keys: list[str], name: str, value: str, order: str, out: str) -> DataFrame:
    """JSON object of name/value rows per key; of a repeated name the row that
    is last in ``order`` stays.

    Names are made unique in a partially aggregated pass first, so the list
    collected per key is as long as its object, however often names repeat.
    """
    unique = df.groupBy(*keys, name).agg(F.max_by(value, order).alias(value))
    entries = F.array_sort(F.collect_list(F.struct(name, value)))
    return unique.groupBy(*keys).agg(F.to_json(F.map_from_entries(entries), {"ignoreNullFields": "false"}).alias(out))
