"""Text functions with the NULL rules of the source database."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart.functions.keys import as_col


def find(value: Column | str, pattern: str, group: int = 0) -> Column:
    """First match of a pattern, NULL (not '') where nothing matches."""
    value = as_col(value)
    return F.when(value.rlike(pattern), F.regexp_extract(value, pattern, group))


def replace_first(value: Column | str, pattern: str, replacement: str) -> Column:
    """Replace only the first match; regexp_replace alone replaces all."""
    groups_safe = f"(?s)^(.*?)(?:{pattern})"
    return F.regexp_replace(as_col(value), groups_safe, "$1" + replacement)


def join_present(*parts: Column | str) -> Column:
    """Concatenate, NULL parts count as empty text."""
    return F.concat(*[F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts])


def plain_number(value: Column | str) -> Column:
    """Text of a double without a trailing '.0', so 180.0 reads '180'."""
    value = as_col(value)
    whole = value == F.floor(value)
    return F.when(whole, value.cast("decimal(38,0)").cast("string")).otherwise(value.cast("string"))


def code_value(uri: Column | str) -> Column:
    """Code part of a versioned code uri: 'set_code#2' gives 'code'."""
    return F.split_part(F.split_part(as_col(uri), F.lit("_"), F.lit(2)), F.lit("#"), F.lit(1))


def code_uri(uri: Column | str) -> Column:
    """Uri without its version: 'set_code#2' gives 'set_code'."""
    return F.split_part(as_col(uri), F.lit("#"), F.lit(1))


def code_version(uri: Column | str) -> Column:
    """Version of a versioned code uri, NULL where there is none."""
    return F.nullif(F.split_part(as_col(uri), F.lit("#"), F.lit(2)), F.lit("")).cast("int")


def strip_json_list(value: Column | str) -> Column:
    """A JSON array of texts as one comma-separated text."""
    return F.array_join(F.from_json(as_col(value), "array<string>"), ",")
