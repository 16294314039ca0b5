"""Join forms that keep to equality keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.operators.latest import first_per_key

def keep_matching(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """EXISTS / IN."""
    return left.join(right.select(*keys), keys, "left_semi")


def drop_matching(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """NOT EXISTS."""
    return left.join(right.select(*keys), keys, "left_anti")


def not_in(left: DataFrame, column: str, right: DataFrame, other: str) -> DataFrame:
    """``column NOT IN (SELECT other ...)`` with its NULL rules.

    Any NULL on the right makes the result empty; a NULL on the left passes
    only when the right is empty.  Spelled as an anti join plus two scalar
    facts about the right side, so no nested loop is planned.
    """
    facts = right.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(other).isNull()).alias("nulls"))
    nothing = facts.select(F.col("n") == 0).scalar()
    clean = facts.select(F.col("nulls") == 0).scalar()
    unmatched = left.join(right.select(F.col(other).alias(column)), [column], "left_anti")
    return unmatched.filter(nothing | (clean & F.col(column).isNotNull()))


def full_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join whose key columns are coalesced."""
    return left.join(right, keys, "full")


def either_equal(
    left: DataFrame, right: DataFrame, first: tuple[str, str], second: tuple[str, str]
) -> DataFrame:
    """Join on ``first OR second``: two equality joins, the second without the
    pairs that the first has already found."""
    one = F.col(first[0]) == F.col(first[1])
    two = F.col(second[0]) == F.col(second[1])
    return left.join(right, one).unionByName(
        left.join(right, two).filter(~F.coalesce(one, F.lit(False)))
    )


def member_of(left: DataFrame, key: str, right: DataFrame, members: str, how: str = "inner") -> DataFrame:
    """Pair a row with each row whose array column holds its key.

    The array is exploded without repeats, so the pairing is an equality join.
    """
    exploded = right.withColumn("_member", F.explode(F.array_distinct(F.col(members))))
    return left.join(exploded, F.col(key) == F.col("_member"), how).drop("_member")


def first_match(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, *order: Column
) -> DataFrame:
    """Left join with the first matching row (LEFT LATERAL ... LIMIT 1)."""
    best = first_per_key(right, [right_key], *order)
    return left.join(best, F.col(left_key) == F.col(right_key), "left")


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row, as scalar
    subqueries."""
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})
