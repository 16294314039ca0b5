"""Huge JSON array files in any layout, read by many tasks.

Spark's text reader cuts a file into pieces that end with a closing brace, wherever
these stand, and hands each task the pieces of one block of bytes.  A task does not
know whether its block starts inside a string, nor how deep it is nested.  The first
scan therefore describes each block under both hypotheses: whether it ends inside a
string, by how much it changes the depth, and how many commas stand at each depth.
Composed in file order these say how every block really starts and how many elements
come before it.  The second scan cuts the elements out; one that runs over blocks is
put together from its parts.

The package has to be on the Python path of the executors.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import stored
from lakemart.sources.landing import _envelope

END = "}"
#: Start states that are broadcast at once, about 100 bytes each; more are read in several rounds.
STATES = 500_000
QUOTE, ESCAPE, COMMA = ord('"'), ord("\\"), ord(",")
_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1
_MARK = _STEP != 0
_MARK[COMMA] = True


class NotAnArray(ValueError):
    pass


def marks(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of brackets and commas, whether an odd number of quotes stands before
    each, and whether an odd number stands in all.  Escaped quotes do not count."""
    quotes = np.flatnonzero(text == QUOTE)
    slashes = text == ESCAPE
    if slashes.any():
        places = np.arange(len(text))
        other = np.maximum.accumulate(np.where(slashes, -1, places))
        before = np.where(quotes > 0, quotes - 1 - other[np.maximum(quotes - 1, 0)], 0)
        quotes = quotes[before % 2 == 0]
    at = np.flatnonzero(_MARK[text])
    return at, (np.searchsorted(quotes, at) & 1).astype(bool), len(quotes) & 1


class Described:
    """What a block does to the state, under both hypotheses."""

    def __init__(self) -> None:
        self.odd, self.depth, self.commas, self.opened = 0, [0, 0], [Counter(), Counter()], [Counter(), Counter()]
        self.head = b""

    def add(self, text: bytes) -> None:
        if len(self.head) < 1:
            self.head = text.lstrip()[:1]
        raw = np.frombuffer(text, np.uint8)
        at, inside, odd = marks(raw)
        for guess in (0, 1):
            seen = at[inside == bool(guess ^ self.odd)]
            steps = _STEP[raw[seen]]
            depth = self.depth[guess] + np.cumsum(steps, dtype=np.int64)
            for kind, counts in ((0, self.commas[guess]), (1, self.opened[guess])):
                found, n = np.unique(depth[steps == kind], return_counts=True)
                counts.update(dict(zip(found.tolist(), n.tolist())))
            self.depth[guess] += int(steps.sum(dtype=np.int64))
        self.odd ^= odd

    def row(self) -> tuple:
        pairs = [[(d, n, self.opened[g][d]) for d, n in sorted((self.commas[g] | {d: self.commas[g][d] for d in self.opened[g]}).items())] for g in (0, 1)]
        # a blank start may go on in the next block; only another character is wrong
        return (self.odd, *self.depth, *pairs, self.head in (b"", b"[", b"}"))


class Cut:
    """Elements of a block whose start state is known."""

    def __init__(self, inside: bool, depth: int, commas: int) -> None:
        self.inside, self.depth, self.number = inside, depth, commas + 1
        self.begun, self.whole = [], False
        self.out: list[tuple[int, bool, bytes]] = []

    def _end(self, text: bytes) -> None:
        self.out.append((self.number, self.whole, b"".join([*self.begun, text])))
        self.begun = []

    def add(self, text: bytes) -> None:
        raw = np.frombuffer(text, np.uint8)
        at, quoted, odd = marks(raw)
        at = at[quoted == self.inside]
        steps = _STEP[raw[at]]
        after = self.depth + np.cumsum(steps, dtype=np.int64)
        cuts = np.flatnonzero(((steps == 0) & (after == 1)) | ((steps == 1) & (after == 1)) | ((steps == -1) & (after == 0)))
        start, within = 0, self.depth >= 1
        for k in cuts.tolist():
            place = int(at[k])
            if within:
                self._end(text[start:place])
            within = steps[k] >= 0
            self.number += int(steps[k] == 0)
            self.whole, start = True, place + 1
        if within:
            self.begun.append(text[start:])
        self.depth = int(after[-1]) if len(after) else self.depth
        self.inside ^= bool(odd)

    def taken(self) -> list[tuple[int, bool, bytes]]:
        out, self.out = self.out, []
        return out

    def last(self) -> list[tuple[int, bool, bytes]]:
        return [(self.number, False, b"".join(self.begun))] if self.begun else []


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, bytes]]:
    """(file, block), first row and text of each run of pieces of one block."""
    paths, blocks = batch.column("path").to_pylist(), batch.column("block").to_pylist()
    pieces = batch.column("value").cast(pa.binary()).to_pylist()
    start = 0
    for i in range(1, len(pieces) + 1):
        if i == len(pieces) or (paths[i], blocks[i]) != (paths[start], blocks[start]):
            yield (paths[start], blocks[start]), start, b"}".join(pieces[start:i]) + b"}"
            start = i


_DESCRIBED = (
    "path string, block long, odd int, depth0 long, depth1 long, at0 array<struct<depth:long,commas:long,opened:long>>, "
    "at1 array<struct<depth:long,commas:long,opened:long>>, starts boolean"
)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at = pa.list_(pa.struct([(n, pa.int64()) for n in ("depth", "commas", "opened")]))
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), at, at, pa.bool_()]
    names = [f.split()[0] for f in _DESCRIBED.split(", ")]

    def row(key: tuple[str, int], block: Described) -> pa.RecordBatch:
        odd, depth0, depth1, at0, at1, starts = block.row()
        listed = [[dict(zip(("depth", "commas", "opened"), x)) for x in found] for found in (at0, at1)]
        values = [*key, odd, depth0, depth1, *listed, starts]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    key, block = None, Described()
    for batch in batches:
        for now, _, text in _runs(batch):
            if now != key:
                if key is not None:
                    yield row(key, block)
                key, block = now, Described()
            block.add(text)
    if key is not None:
        yield row(key, block)


def _compose(blocks: pa.Table) -> pa.Table:
    """Start state of every block of one file, in order."""
    rows = sorted(blocks.to_pylist(), key=lambda r: r["block"])
    inside, depth, commas, opened, out = 0, 0, 0, 0, []
    for r in rows:
        out.append((r["path"], r["block"], bool(inside), depth, commas))
        if depth == 0 and opened == 0 and not r["starts"]:
            raise NotAnArray(f"not a JSON array: {r['path']}")
        here = next((c for c in r[f"at{inside}"] if c["depth"] == 1 - depth), {"commas": 0, "opened": 0})
        commas, opened = commas + here["commas"], opened + here["opened"]
        depth, inside = depth + r[f"depth{inside}"], inside ^ r["odd"]
    # the last piece is not followed by a brace, which is counted all the same
    if inside or depth != -1 or opened > 1:
        raise NotAnArray(f"JSON array does not end where its file does: {rows[0]['path']}")
    columns = [*zip(*out), [commas] * len(out)]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "block", "inside", "depth", "commas", "total"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = ["path", "block", "total", "number", "whole"], [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]

    def rows(key: tuple[str, int], total: int, found: list) -> Iterator[pa.RecordBatch]:
        if found:
            number, whole, texts = zip(*found)
            columns = [[key[0]] * len(found), [key[1]] * len(found), [total] * len(found), number, whole]
            data = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*[pa.array(c, k) for c, k in zip(columns, kinds)], data], names=[*names, "data"])

    key, total, block = None, 0, None
    for batch in batches:
        for now, first, text in _runs(batch):
            if now != key:
                if key is not None:
                    yield from rows(key, total, block.last())
                key, total = now, batch.column("total")[first].as_py()
                block = Cut(*(batch.column(c)[first].as_py() for c in ("inside", "depth", "commas")))
            block.add(text)
            yield from rows(key, total, block.taken())
    if key is not None:
        yield from rows(key, total, block.last())


def land_arrays(spark: SparkSession, path: str, now: Column, states: int = STATES) -> DataFrame:
    """Rows of array files of any layout: one line, pretty-printed, or anything
    between.  Gives the rows and numbers of ``land_files``, but splits a file over
    tasks like any text.

    The unit that is not split is the text up to the next closing brace, so elements
    should be objects, or short.  A file that is not one whole array is refused; an
    empty one counts as an empty array.
    """
    pieces = (
        spark.read.format("text").option("recursiveFileLookup", True).option("lineSep", END).load(path)
        .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    )
    described = pieces.mapInArrow(_describe, _DESCRIBED)
    start = "path string, block long, inside boolean, depth long, commas long, total long"
    starts = stored(described.groupBy("path").applyInArrow(_compose, start), "starts")
    rounds = -(-starts.count() // states)
    parts = None
    for k in range(rounds):
        # rows keep their order only beside a broadcast, which is bounded by `states`
        mine = F.pmod(F.xxhash64("path"), F.lit(rounds)) == k if rounds > 1 else F.lit(True)
        read = pieces.filter(mine).join(F.broadcast(starts.filter(mine)), ["path", "block"])
        found = read.mapInArrow(_cut, "path string, block long, total long, number long, whole boolean, data string")
        parts = found if parts is None else parts.unionByName(found)
    if parts is None:
        parts = spark.createDataFrame([], "path string, block long, total long, number long, whole boolean, data string")
    over = parts.filter("NOT whole").groupBy("path", "total", "number").agg(F.array_sort(F.collect_list(F.struct("block", "data"))).alias("p"))
    joined = over.select("path", "total", "number", F.array_join(F.transform("p", lambda x: x["data"]), "").alias("data"))
    elements = parts.filter("whole").select("path", "total", "number", "data").unionByName(joined)
    blank = F.trim(F.regexp_replace("data", r"\s", "")) == ""
    # an empty array has one blank place; FAILFAST refuses any other
    elements = elements.filter(~(blank & (F.col("total") == 0)))
    compact = F.from_json(F.concat(F.lit("["), "data", F.lit("]")), "array<string>", {"mode": "FAILFAST"})
    refused = F.raise_error(F.concat(F.lit("empty element in "), F.col("path"))).cast("array<string>")
    return _envelope(elements.select("path", "number", F.get(F.when(blank, refused).otherwise(compact), F.lit(0)).alias("data")), now)
