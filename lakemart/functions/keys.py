"""Surrogate keys and NULL-aware ordering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: text that stands for NULL inside a surrogate key
NULL_TEXT = "_dbt_utils_surrogate_key_null_"


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def key_text(*parts: Column | str) -> Column:
    """The text form of the parts, joined with '-'."""
    return F.concat_ws("-", *[F.coalesce(as_col(p).cast("string"), F.lit(NULL_TEXT)) for p in parts])


def surrogate_key(*parts: Column | str) -> Column:
    """md5 over the text form of the parts, joined with '-'."""
    return F.md5(key_text(*parts))


def newest(value: Column | str) -> Column:
    """Descending order in which NULL comes first, as in the source database."""
    return as_col(value).desc_nulls_first()


def oldest(value: Column | str) -> Column:
    """Ascending order in which NULL comes last, as in the source database."""
    return as_col(value).asc_nulls_last()
