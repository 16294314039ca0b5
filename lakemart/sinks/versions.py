"""Tables as numbered directories and one list of what is current.

Every write is a new directory: ``v=…`` holds the whole table, ``a=…`` rows
added to it, ``p=…`` partitions that replace earlier ones.  After its files a
write puts down a list, ``live=…``, of all paths that make up the table from then
on, with their sizes and the columns.  A write can also keep the rows that it made
appear or vanish (``c=…``) and what it was made from.  A write counts when its list is there, so
readers never see a half-written one and keep reading the old contents while a
load runs; they read one small list and neither look into directories nor open
files to learn the columns.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators import buckets

WHOLE, ADDED, REPLACED, CHANGED, LIVE = "v", "a", "p", "c", "live"
PART = "_part"
#: Bytes of the files of a bucket above which it is split.
BUCKET_BYTES = 128 << 20
#: A bucket is not split if one part would keep more of its rows than this: one key fills it.
LARGEST_PART = 0.75


class ProtectedHistory(RuntimeError):
    pass


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _listing(spark: SparkSession, path: str) -> list[str]:
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target))


def _delete(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.delete(target, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it is there whole or not at all."""
    folder, name = path.rsplit("/", 1)
    part, fs = _path(spark, f"{folder}/_{name}-{uuid.uuid4().hex}")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not fs.rename(part, _path(spark, path)[0]):
        raise FileExistsError(path)


def get_text(spark: SparkSession, path: str) -> str:
    target, fs = _path(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@dataclass(frozen=True)
class Held:
    """Files that are part of a table: the write they came with, their partition
    (None for a directory of its own), where they are, and their bytes."""

    write: int
    part: str | None
    path: str
    size: int


@dataclass(frozen=True)
class Live:
    """What makes up a table, and how it came about.

    `number` counts the lists and `content` the writes that changed rows; `previous` is
    the content before.  `changes` says where the rows are that appeared or vanished:
    an empty text for none, None where that was not kept.  `notes` is the writer's.
    """

    number: int
    content: int
    previous: int | None
    schema: T.StructType
    held: tuple[Held, ...]
    changes: str | None
    notes: dict

    def to_json(self) -> str:
        rows = [[h.write, h.part, h.path, h.size] for h in self.held]
        more = {"previous": self.previous, "changes": self.changes, "notes": self.notes}
        return json.dumps({"schema": self.schema.jsonValue(), "held": rows, **more})

    @staticmethod
    def from_json(number: int, content: int, text: str) -> Live:
        read = json.loads(text)
        held = tuple(Held(*row) for row in read["held"])
        return Live(number, content, read["previous"], T.StructType.fromJson(read["schema"]), held, read["changes"], read["notes"])


def widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both; one that both have must have one type."""
    known = {f.name: f for f in old}
    for f in new:
        if f.name in known and known[f.name].dataType.simpleString() != f.dataType.simpleString():
            raise ValueError(f"column {f.name} was {known[f.name].dataType.simpleString()} and is now {f.dataType.simpleString()}")
    return T.StructType([*old, *[f for f in new if f.name not in known]])


class Tables:
    """Named tables below one root; ``prefix`` keeps environments apart.

    One writer at a time changes a table; any number may read it.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", bucket_bytes: int = BUCKET_BYTES):
        self.spark, self.root, self.prefix, self.bucket_bytes = spark, root.rstrip("/"), prefix, bucket_bytes

    def folder(self, name: str) -> str:
        return f"{self.root}/{self.prefix}{name}"

    def names(self, start: str = "") -> list[str]:
        """Tables in name order, optionally of one layer."""
        plain = [n[len(self.prefix):] for n in _listing(self.spark, self.root) if n.startswith(self.prefix)]
        return [n for n in plain if n.startswith(start) and self.exists(n)]

    def _numbered(self, name: str) -> list[tuple[int, str]]:
        found = [n.split("=") for n in _listing(self.spark, self.folder(name)) if n.split("=")[0] in (WHOLE, ADDED, REPLACED, CHANGED, LIVE)]
        return sorted((int(number.split(".")[0]), kind) for kind, number in found)

    def _lists(self, name: str) -> list[tuple[int, int]]:
        """Number and content of every list, in order."""
        found = [n.removeprefix(f"{LIVE}=").split(".") for n in _listing(self.spark, self.folder(name)) if n.startswith(f"{LIVE}=")]
        return sorted((int(number), int(content)) for number, content in found)

    def _at(self, number: int, kind: str) -> str:
        return f"{kind}={number:09d}"

    def _list(self, name: str, number: int, content: int) -> Live:
        return Live.from_json(number, content, get_text(self.spark, f"{self.folder(name)}/{self._at(number, LIVE)}.{content:09d}"))

    def live(self, name: str) -> Live | None:
        """What makes up the table now; None before its first complete write."""
        lists = self._lists(name)
        return self._list(name, *lists[-1]) if lists else None

    def _known(self, name: str) -> Live:
        found = self.live(name)
        if found is None:
            raise LookupError(f"no complete version of table {name}")
        return found

    def version(self, name: str) -> int | None:
        """Number of the last write that changed the table."""
        lists = self._lists(name)
        return lists[-1][1] if lists else None

    def exists(self, name: str) -> bool:
        return bool(self._lists(name))

    def _frame(self, name: str, live: Live, held: list[Held]) -> DataFrame:
        if not held:
            return self.spark.createDataFrame([], live.schema)
        return self.spark.read.schema(live.schema).parquet(*[f"{self.folder(name)}/{h.path}" for h in held])

    def read(self, name: str, parts: list[str] | None = None) -> DataFrame:
        """The table, or only the named partitions of it."""
        live = self._known(name)
        chosen = None if parts is None else set(parts)
        return self._frame(name, live, [h for h in live.held if chosen is None or h.part is None or h.part in chosen])

    def newest(self, name: str, column: str):
        """Largest value of a column in the last write that has one.

        Loads only ever add later times, so older writes need not be read.
        """
        live = self._known(name)
        for write in sorted({h.write for h in live.held}, reverse=True):
            value = self._frame(name, live, [h for h in live.held if h.write == write]).agg(F.max(column)).first()[0]
            if value is not None:
                return value
        return None

    def _next(self, name: str) -> int:
        return max((n for n, _ in self._numbered(name)), default=0) + 1

    def _sizes(self, name: str, directory: str) -> dict[str | None, int]:
        """Bytes of the files of each partition of a directory."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{self.folder(name)}/{directory}")
        part = F.regexp_extract("path", f"/{directory}/{PART}=([^/]+)/", 1)
        sizes = files.groupBy(F.url_decode(part).alias("part")).agg(F.sum("length").alias("n")).collect()
        return {r["part"] or None: r["n"] for r in sizes}

    def _commit(
        self, name: str, live: Live | None, number: int, schema: T.StructType, held: list[Held], notes: dict | None, changes: DataFrame | str | None
    ) -> DataFrame:
        if isinstance(changes, DataFrame):
            path = self._at(number, CHANGED)
            changes.write.mode("errorifexists").parquet(f"{self.folder(name)}/{path}")
            changes = path
        now = Live(number, number, live.content if live else None, schema, tuple(held), changes, notes or {})
        self._put(name, now)
        return self._frame(name, now, held)

    def keep_changes(self, name: str, rows: DataFrame) -> tuple[str, DataFrame]:
        """Write rows that appeared or vanished before the write they belong to, which is
        then given their place; they are read from there meanwhile."""
        path = self._at(self._next(name), CHANGED)
        rows.write.mode("errorifexists").parquet(f"{self.folder(name)}/{path}")
        return path, self.spark.read.schema(rows.schema).parquet(f"{self.folder(name)}/{path}")

    def drop_changes(self, name: str, path: str) -> None:
        """Remove changes that belong to no write."""
        _delete(self.spark, f"{self.folder(name)}/{path}")

    def _put(self, name: str, live: Live) -> None:
        put_text(self.spark, f"{self.folder(name)}/{self._at(live.number, LIVE)}.{live.content:09d}", live.to_json())

    def note(self, name: str, notes: dict) -> None:
        """Replace the notes; the rows are as they were."""
        live = self._known(name)
        self._put(name, replace(live, number=self._next(name), notes=notes))

    def notes(self, name: str) -> dict:
        live = self.live(name)
        return live.notes if live else {}

    def changes_since(self, name: str, content: int) -> list[str] | None:
        """Where the rows are that appeared or vanished since a content of the table;
        None if that is not known any more."""
        lists = {c: n for n, c in self._lists(name)}
        at, found = max(lists, default=None), []
        while at is not None and at > content:
            live = self._list(name, lists[at], at) if at in lists else None
            if live is None or live.changes is None:
                return None
            found += [live.changes] if live.changes else []
            at = live.previous
        return found if at == content else None

    def changed_rows(self, name: str, found: list[str]) -> DataFrame:
        live = self._known(name)
        return self._frame(name, live, [Held(0, None, path, 0) for path in found])

    def _write(self, name: str, df: DataFrame, kind: str) -> tuple[int, Held]:
        number = self._next(name)
        directory = self._at(number, kind)
        df.write.mode("errorifexists").parquet(f"{self.folder(name)}/{directory}")
        return number, Held(number, None, directory, sum(self._sizes(name, directory).values()))

    def write(self, name: str, df: DataFrame, notes: dict | None = None, compare: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> DataFrame:
        """Write the whole table; the frame may read the current one.  With `compare`
        the rows that differ are kept as changes, and without any the table stays."""
        live = self.live(name)
        number, held = self._write(name, df, WHOLE)
        changes = None
        if compare and live and live.schema.simpleString() == df.schema.simpleString():
            fresh = self._frame(name, replace(live, schema=df.schema), [held])
            changes = compare(self._frame(name, live, list(live.held)), fresh)
            path = f"{self.folder(name)}/{self._at(number, CHANGED)}"
            changes.write.mode("errorifexists").parquet(path)
            if self.spark.read.schema(live.schema).parquet(path).isEmpty():
                for gone in (held.path, self._at(number, CHANGED)):
                    _delete(self.spark, f"{self.folder(name)}/{gone}")
                self.note(name, notes or {})
                return self.read(name)
            changes = self._at(number, CHANGED)
        return self._commit(name, live, number, df.schema, [held], notes, changes)

    def add(self, name: str, df: DataFrame, notes: dict | None = None) -> DataFrame:
        """Write rows to be read with those that are there."""
        live = self.live(name)
        schema = widened(live.schema, df.schema) if live else df.schema
        number, held = self._write(name, df, ADDED)
        return self._commit(name, live, number, schema, [*(live.held if live else ()), held], notes, held.path)

    def add_any(self, name: str, df: DataFrame) -> bool:
        """Add the rows of a frame, which is read once; without any the table stays as it is."""
        live = self._known(name)
        schema = widened(live.schema, df.schema)
        number, held = self._write(name, df, ADDED)
        if self._frame(name, replace(live, schema=schema), [held]).isEmpty():
            _delete(self.spark, f"{self.folder(name)}/{held.path}")
            return False
        self._commit(name, live, number, schema, [*live.held, held], None, held.path)
        return True

    def parts(self, name: str) -> list[str]:
        """Values of the partitions that the table has rows of."""
        live = self.live(name)
        return sorted(h.part for h in live.held if h.part is not None) if live else []

    def _write_parts(
        self, name: str, df: DataFrame, part: Column, write: int, number: int, order: tuple[str, ...] = (),
        gather: bool = True, made: dict[str, Column] | None = None,
    ) -> list[Held]:
        gathered = df.withColumn(PART, part)
        if gather:
            # rebalancing gathers the rows of a partition but splits a large one over tasks
            gathered = gathered.drop(*(made or {})).hint("rebalance", F.col(PART)).withColumns(made or {}).select(*df.columns, PART)
        if order:
            gathered = gathered.sortWithinPartitions(PART, *order)
        directory = self._at(number, REPLACED)
        gathered.write.mode("errorifexists").partitionBy(PART).parquet(f"{self.folder(name)}/{directory}")
        escaped = {unquote(n.removeprefix(f"{PART}=")): n for n in _listing(self.spark, f"{self.folder(name)}/{directory}") if n.startswith(f"{PART}=")}
        return [Held(write, p, f"{directory}/{escaped[p]}", n) for p, n in self._sizes(name, directory).items() if p is not None]

    def _base(self, name: str, fresh: bool) -> Live | None:
        """What the other partitions are taken from."""
        live = None if fresh else self.live(name)
        if live and any(h.part is None for h in live.held):
            if not self._frame(name, live, [h for h in live.held if h.part is None]).isEmpty():
                raise ValueError(f"{name} was written whole and has no partitions to replace")
            live = replace(live, held=tuple(h for h in live.held if h.part is not None))
        return live

    def replace_parts(
        self, name: str, df: DataFrame, part: Column, touched: list[str] | None = None, fresh: bool = False,
        notes: dict | None = None, changes: DataFrame | None = None, made: dict[str, Column] | None = None,
    ) -> DataFrame:
        """Write whole partitions; the others stay where they are.  A partition
        that is named in `touched` and has no rows left becomes empty.  With `fresh`
        the frame is the whole table.  Columns in `made` are not shuffled but made
        out of the others."""
        live = self._base(name, fresh)
        schema = widened(live.schema, df.schema) if live else df.schema
        number = self._next(name)
        new = self._write_parts(name, df, part, number, number, made=made)
        gone = {h.part for h in new} | set(touched or ())
        kept = [h for h in (live.held if live else ()) if h.part not in gone]
        return self._commit(name, self.live(name), number, schema, [*kept, *new], notes, changes)

    def bucket_of(self, name: str, columns: tuple[str, ...]) -> Column:
        """The bucket in which a row of the table is stored."""
        return buckets.bucket_of(columns, buckets.directory(self.parts(name)))

    def replace_buckets(
        self, name: str, df: DataFrame, columns: tuple[str, ...], touched: list[str] | None = None, fresh: bool = False,
        notes: dict | None = None, changes: DataFrame | str | None = None, order: tuple[str, ...] = (),
        made: dict[str, Column] | None = None,
    ) -> DataFrame:
        """Write whole buckets of a table that is dealt by the hash of a key.

        A bucket whose files pass `bucket_bytes` is split by its next bits before the
        write counts; the buckets that the load did not touch keep their files.  Rows
        are in `order` within the files of a bucket.
        """
        live = self._base(name, fresh)
        kept = {h.part: h for h in live.held} if live else {}
        schema = widened(live.schema, df.schema) if live else df.schema
        known = buckets.directory(kept)
        write = number = self._next(name)
        # one bucket for all rows: nothing has to be brought together
        rows = self._write_parts(name, df, buckets.bucket_of(columns, known), write, write, order, known != [buckets.ROOT], made)
        new = {h.part: h for h in rows}
        kept = {p: h for p, h in kept.items() if p not in new and p not in (touched or ())}
        deeper = {p: buckets.steps(h.size, self.bucket_bytes, p) for p, h in new.items()}
        deeper = {p: by for p, by in deeper.items() if by > 0}
        if deeper:
            written = Live(write, write, None, schema, tuple(new.values()), None, {})
            deeper = self._divisible(name, written, columns, deeper)
        if deeper:
            number += 1
            crowded = self._frame(name, written, [new.pop(p) for p in deeper])
            children = [child for p, by in deeper.items() for child in buckets.split(p, by)]
            # the rest of the directory only completes the bits; no row goes there
            finer = buckets.bucket_of(columns, buckets.directory(children))
            new |= {h.part: h for h in self._write_parts(name, crowded, finer, write, number, order, made=made)}
        return self._commit(name, self.live(name), number, schema, [*kept.values(), *new.values()], notes, changes)

    def _divisible(self, name: str, live: Live, columns: tuple[str, ...], deeper: dict[str, int]) -> dict[str, int]:
        """Those of the crowded buckets that a split divides; a bucket that one key
        fills stays as it is."""
        if not deeper:
            return {}
        rows = self._frame(name, live, [h for h in live.held if h.part in deeper])
        children = [child for p, by in deeper.items() for child in buckets.split(p, by)]
        parent, child = (buckets.bucket_of(columns, buckets.directory(names)) for names in (deeper, children))
        counts = rows.groupBy(parent.alias("parent"), child.alias("child")).agg(F.count(F.lit(1)).alias("n"))
        shares = counts.groupBy("parent").agg((F.max("n") / F.sum("n")).alias("largest")).collect()
        largest = {r["parent"]: r["largest"] for r in shares}
        return {p: by for p, by in deeper.items() if largest[p] <= LARGEST_PART}

    def prune(self, name: str, keep: int = 3) -> list[str]:
        """Remove what the last `keep` changes of a table no longer read, and earlier
        writes that were never completed.  A reader that opened the table more than
        `keep` changes ago loses its files."""
        newest = {content: number for number, content in self._lists(name)}
        current = dict(sorted(newest.items())[-(keep + 1):])
        expired = [(n, c) for n, c in self._lists(name) if current.get(c) != n]
        if not expired:
            return []
        used = [self._list(name, n, c) for c, n in current.items()]
        needed = {h.path for live in used for h in live.held} | {live.changes for live in used if live.changes}
        directories = {p.split("/")[0] for p in needed}
        old = {h.path for n, c in expired for h in self._list(name, n, c).held} - needed
        gone = sorted({p.split("/")[0] if p.split("/")[0] not in directories else p for p in old})
        # writes without a list that a later one has overtaken, what splits have left, and changes before
        first = min(current.values())
        gone += [d for d in (self._at(n, kind) for n, kind in self._numbered(name) if kind != LIVE and n < first) if d not in directories and d not in gone]
        gone += [f"{self._at(n, LIVE)}.{c:09d}" for n, c in expired]
        for path in gone:
            _delete(self.spark, f"{self.folder(name)}/{path}")
        return [f"{self.folder(name)}/{path}" for path in gone]

    def rebuild(self, name: str, df: DataFrame, history: bool = False, **options) -> DataFrame:
        """Full refresh; refused for history that exists already."""
        if history and self.exists(name):
            raise ProtectedHistory(f"{name} holds history and is not rebuilt")
        return self.write(name, df, **options)


def month_of(time: str) -> Column:
    """Partition of a history row: the month of its change time."""
    return F.coalesce(F.date_format(time, "yyyy-MM"), F.lit("undated"))


def view(df: DataFrame, name: str) -> str:
    """Publish a frame under a name for SQL."""
    df.createOrReplaceTempView(name)
    return name


def clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Order by range over tasks: files in order, and ordered inside."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)
