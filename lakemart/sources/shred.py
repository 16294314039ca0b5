"""JSON documents to typed columns from a declared field list."""

from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.keys import surrogate_key

METADATA = [
    "dw_metadata_source_timestamp_at",
    "dw_metadata_stg_stored_at",
    "dw_metadata_dbt_copied_at",
    "dw_metadata_filename",
    "dw_metadata_file_row_number",
]

# type word of a field list -> Spark type
TYPES = {
    "text": "string",
    "uuid": "string",
    "json": "string",
    "int": "int",
    "bigint": "bigint",
    "float": "double",
    "bool": "boolean",
    "date": "date",
    "time": "timestamp",
    "time_ntz": "timestamp_ntz",
}


LANGUAGES = ("fi", "sv", "en")


@dataclass(frozen=True)
class Field:
    column: str
    path: tuple[str, ...]
    type: str


def fields(text: str) -> list[Field]:
    """Field list from words ``path/in/document[:type][=column]``.

    The column is the last path part in lower case unless given, the type is
    text unless given.  A path that ends in ``/*`` stands for the three
    languages of a translated text: ``nimi/*`` gives nimi_fi, nimi_sv, nimi_en.
    """
    found = []
    for word in text.split():
        rest, _, column = word.partition("=")
        path, _, kind = rest.partition(":")
        steps = tuple(path.split("/"))
        if steps[-1] == "*":
            name = column or steps[-2].lower()
            found += [Field(f"{name}_{lang}", (*steps[:-1], lang), kind or "text") for lang in LANGUAGES]
        else:
            found.append(Field(column or steps[-1].lower(), steps, kind or "text"))
    return found


@dataclass(frozen=True)
class Shape:
    """How a raw table becomes a typed one."""

    raw: str
    fields: list[Field]
    key: tuple[str, tuple[str, ...]] | None = None
    keep_document: bool = False
    before: Callable[[DataFrame], DataFrame] | None = None
    derive: Callable[[DataFrame, Column], dict[str, Column]] | None = None
    keep: Callable[[], Column] | None = None
    drop: tuple[str, ...] = field(default=())
    metadata: bool = True


def _schema(paths: list[tuple[str, ...]]) -> T.StructType:
    tree: dict = {}
    for path in paths:
        node = tree
        for key in path:
            node = node.setdefault(key, {})

    def build(node: dict) -> T.StructType:
        return T.StructType([T.StructField(k, build(v) if v else T.StringType()) for k, v in node.items()])

    return build(tree)


def parse(document: Column, wanted: list[Field], df: DataFrame) -> DataFrame:
    """Parse each document once and read all fields out of the result.

    A path that is wanted both whole and in parts (``values`` and
    ``values/x``) is parsed as text first and its parts from that text.
    """
    whole = {f.path for f in wanted}
    inner: dict[tuple[str, ...], list[Field]] = {}
    outer: list[Field] = []
    for f in wanted:
        split = next((f.path[:i] for i in range(1, len(f.path)) if f.path[:i] in whole), None)
        if split:
            inner.setdefault(split, []).append(f)
        else:
            outer.append(f)
    df = df.withColumn("_doc", F.from_json(document, _schema([f.path for f in outer])))
    values = {f.column: _read("_doc", f.path) for f in outer}
    for i, (prefix, parts) in enumerate(inner.items()):
        name = f"_part{i}"
        text = F.expr(_read("_doc", prefix))
        df = df.withColumn(name, F.from_json(text, _schema([p.path[len(prefix):] for p in parts])))
        values |= {p.column: _read(name, p.path[len(prefix):]) for p in parts}
    kept = [f"`{c}`" for c in df.columns if c not in values and c != "_doc" and not c.startswith("_part")]
    return df.selectExpr(*kept, *[f"CAST({values[f.column]} AS {TYPES[f.type]}) AS `{f.column}`" for f in wanted])


def _read(root: str, path: tuple[str, ...]) -> str:
    return ".".join(f"`{key}`" for key in (root, *path))


def shred(raw: DataFrame, shape: Shape, now: Column) -> DataFrame:
    """Typed columns and load metadata of every document."""
    df = shape.before(raw) if shape.before else raw
    return finish(parse(F.col("data"), shape.fields, df), shape, now)


def finish(df: DataFrame, shape: Shape, now: Column) -> DataFrame:
    """Derived columns, key, filter and metadata of rows whose fields have been read."""
    names = [f.column for f in shape.fields]
    if shape.derive:
        derived = shape.derive(df, now)
        df = df.withColumns(derived)
        names += [n for n in derived if n not in names]
    if shape.key:
        name, parts = shape.key
        df = df.withColumn(name, surrogate_key(*parts))
        names = [name] + names
    if shape.keep:
        df = df.filter(shape.keep())
    df = df.withColumn("dw_metadata_stg_stored_at", now)
    names = [n for n in names if n not in shape.drop]
    return df.select(*names, *(["data"] if shape.keep_document else []), *(METADATA if shape.metadata else []))
