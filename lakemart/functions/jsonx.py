"""JSON text as a column type.

Documents stay JSON text between jobs.  A document is parsed once per job with
``from_json`` and a declared shape; single-path helpers serve the rare lookup.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart.functions.keys import as_col


def _path(keys: tuple[str | int, ...]) -> str:
    return "$" + "".join(f"[{k}]" if isinstance(k, int) else f"['{k}']" for k in keys)


def at(value: Column | str, *keys: str | int) -> Column:
    """Text, or JSON text of an object or array, at a path; NULL if absent."""
    return F.get_json_object(as_col(value), _path(keys))


def elements(value: Column | str) -> Column:
    """Elements of a JSON array: texts unquoted, objects as JSON text."""
    return F.from_json(as_col(value), "array<string>")


def records(value: Column | str, shape: str) -> Column:
    """Typed records of a JSON array of objects."""
    return F.from_json(as_col(value), f"array<struct<{shape}>>")


def record(value: Column | str, shape: str) -> Column:
    return F.from_json(as_col(value), f"struct<{shape}>")


def entries(value: Column | str) -> Column:
    """Top-level entries of a JSON object; nested values as JSON text."""
    return F.from_json(as_col(value), "map<string,string>")


def keys_of(value: Column | str) -> Column:
    return F.json_object_keys(as_col(value))


def has_key(value: Column | str, key: Column | str) -> Column:
    """Whether a JSON object has a top-level key, also if its value is null."""
    key = F.lit(key) if isinstance(key, str) else key
    return F.array_contains(keys_of(value), key)


def has_any_key(value: Column | str, keys: list[str]) -> Column:
    return F.arrays_overlap(keys_of(value), F.array(*[F.lit(k) for k in keys]))


def has_element(value: Column | str, element: Column | str) -> Column:
    """Whether a JSON array of texts holds the given text."""
    element = F.lit(element) if isinstance(element, str) else element
    return F.array_contains(elements(value), element)


def holds(value: Column | str, text: Column | str) -> Column:
    """Whether an array of texts holds a text, or an object has it as a key."""
    return F.coalesce(has_element(value, text), has_key(value, text))


def array_of(documents: Column) -> Column:
    """JSON array out of an array column of JSON texts; NULL stays as null."""
    return F.concat(
        F.lit("["), F.array_join(F.transform(documents, lambda d: F.coalesce(d, F.lit("null"))), ","), F.lit("]")
    )


def length(value: Column | str) -> Column:
    return F.json_array_length(as_col(value))


def value_of(value: Column | str, key: Column) -> Column:
    """Value under a key that is itself a column."""
    return F.try_element_at(entries(value), key)


def build(**fields: Column) -> Column:
    """JSON object that keeps NULL fields."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})


def build_named(fields: list[tuple[str, Column]], keep_nulls: bool = True) -> Column:
    return F.to_json(
        F.struct(*[c.alias(n) for n, c in fields]), {"ignoreNullFields": "false" if keep_nulls else "true"}
    )


def to_array(value: Column) -> Column:
    """JSON text of an array column, keeping NULL fields of its records."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def canonical(value: Column | str) -> Column:
    """Same text for equal documents: keys sorted, spaces removed."""
    return F.to_json(F.parse_json(as_col(value)))


def translated(value: Column | str) -> Column:
    """The three languages of a name object as a struct."""
    return record(value, "fi string, sv string, en string")


def names(fi: Column | str, sv: Column | str, en: Column | str) -> Column:
    """Three-language name object in which a missing language borrows another."""
    fi, sv, en = as_col(fi), as_col(sv), as_col(en)
    return build(en=F.coalesce(en, fi, sv), sv=F.coalesce(sv, fi, en), fi=F.coalesce(fi, sv, en))
