"""Documents parsed once, at landing, into VARIANT values.

A stage then reads its fields out of the stored binary value and parses no text.
JSON null stays apart from a field that is not there: as JSON text it is 'null', and
NULL only where the path leads nowhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.keys import as_col
from lakemart.sources.shred import TYPES, Field, Shape, finish

DOCUMENT = "data"


def landed(raw: DataFrame) -> DataFrame:
    """Raw rows with their documents parsed; text that is no JSON is refused here."""
    return raw.withColumn(DOCUMENT, F.parse_json(DOCUMENT))


def _segment(step: str | int) -> str | None:
    """Path segment of a key or an index; None for a key that no path can hold."""
    if isinstance(step, int):
        return f"[{step}]"
    quote = next((q for q in "'\"" if q not in step and "?" not in step), None)
    return f"[{quote}{step}{quote}]" if quote and step else None


def at(document: Column | str, *steps: str | int, kind: str = "variant") -> Column:
    """Value at a path as a type; NULL for JSON null (but for the type variant), for a
    path that leads nowhere, and in a null document."""
    value, path = as_col(document), "$"
    for step in steps:
        segment = _segment(step)
        if segment is None:
            inner = F.try_variant_get(value, path, "map<string,variant>")
            value, path = F.try_element_at(inner, F.lit(step)), "$"
        else:
            path += segment
    return F.variant_get(value, path, kind)


def is_there(document: Column | str, *steps: str | int) -> Column:
    """Whether the path leads to a value, JSON null included."""
    return at(document, *steps).isNotNull()


def is_null(document: Column | str, *steps: str | int) -> Column:
    """Whether the path leads to JSON null; not so where it leads nowhere."""
    return F.is_variant_null(at(document, *steps))


def json_text(document: Column | str, *steps: str | int) -> Column:
    """JSON text of what is at the path, keys in order: 'null' for JSON null, NULL for
    a path that leads nowhere."""
    return F.to_json(at(document, *steps))


def elements(document: Column | str, *steps: str | int) -> Column:
    """Elements of an array at a path, each a document of its own."""
    return at(document, *steps, kind="array<variant>")


def read(document: Column | str, f: Field) -> Column:
    if f.type == "json":
        return json_text(document, *f.path)
    # a text field may hold an object, which it shows as JSON text, or a number
    if TYPES[f.type] == "string":
        return at(document, *f.path, kind="string")
    return at(document, *f.path, kind="string").cast(TYPES[f.type])


def shred(landed_rows: DataFrame, shape: Shape, now: Column) -> DataFrame:
    """Typed columns and load metadata of every document, read from its VARIANT value.

    The same fields as from text, save that a JSON field keeps JSON null as 'null'.
    Shapes that work on the text of the document get it back from the value.
    """
    if not isinstance(landed_rows.schema[DOCUMENT].dataType, T.VariantType):
        raise TypeError(f"{DOCUMENT} is not a VARIANT column; land the rows first")
    df = landed_rows.withColumnRenamed(DOCUMENT, "_document")
    text = F.to_json("_document")
    if shape.before:
        df = shape.before(df.withColumn(DOCUMENT, text).drop("_document")).withColumn("_document", F.parse_json(DOCUMENT))
    elif shape.keep_document or shape.derive:
        df = df.withColumn(DOCUMENT, text)
    df = df.withColumns({f.column: read("_document", f) for f in shape.fields}).drop("_document")
    return finish(df, shape, now)
