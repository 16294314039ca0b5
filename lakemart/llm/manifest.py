"""Merkle manifest of a table, its digests stored in van Emde Boas layout.

The leaves of a tree are cut into aligned subtrees of HEIGHT levels of runs.  Each
is one block: its nodes stand in one byte string, at places given by splitting the
subtree at half its height again and again (the upper half first, then each lower
one).  Address arithmetic alone finds a node, for construction and for siblings.
The roots of the blocks are the leaves of the next blocks, until one is left.

Every language is a tree; the roots of the trees are the leaves of one more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import prepare, stored

FANOUT, HEIGHT = 8, 4
#: Rows of one range of the order, which are numbered together.
RANGE_ROWS = 20_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree of the trees' roots.
TOP = ""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# -- layout ------------------------------------------------------------------


def slots(levels: int, fanout: int = FANOUT) -> int:
    """Nodes of a complete tree of so many levels of nodes."""
    return (fanout**levels - 1) // (fanout - 1)


def address(levels: int, depth: int, index: np.ndarray, fanout: int = FANOUT) -> np.ndarray:
    """Places of the nodes with these numbers at a depth of a tree of so many levels."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(top, depth, index, fanout)
    span = fanout ** (depth - top)
    return slots(top, fanout) + index // span * slots(levels - top, fanout) + address(levels - top, depth - top, index % span, fanout)


def steps(n: int, fanout: int = FANOUT) -> int:
    """Runs that are hashed on the way from one of n leaves to the root."""
    out = 0
    while n > 1:
        n, out = -(-n // fanout), out + 1
    return out


def _sha(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def build(leaves: np.ndarray, height: int, fanout: int = FANOUT) -> bytes:
    """The digests of a block in its layout, cut after the last one in use.

    `leaves` is an array of 32 bytes a row; `height` levels of runs stand above it.
    """
    levels, counts = height + 1, [len(leaves)]
    for _ in range(height):
        counts.append(-(-counts[-1] // fanout))
    places = [address(levels, height - up, np.arange(c), fanout) for up, c in enumerate(counts)]
    nodes = np.zeros((max(int(p.max()) for p in places) + 1, 32), np.uint8)
    nodes[places[0]] = leaves
    for up in range(1, levels):
        text = nodes[places[up - 1]].tobytes().hex().encode()
        run = 64 * fanout
        made = b"".join(_sha(text[at : at + run]) for at in range(0, len(text), run))
        nodes[places[up]] = np.frombuffer(made, np.uint8).reshape(-1, 32)
    return nodes.tobytes()


def level(nodes: np.ndarray, height: int, up: int, first: int, last: int, fanout: int = FANOUT) -> bytes:
    """Hex text of the nodes first to last - 1, `up` levels above a block's leaves."""
    return nodes[address(height + 1, height - up, np.arange(first, last), fanout)].tobytes().hex().encode()


def above(nodes: bytes, height: int, n: int, fanout: int = FANOUT) -> list[list[tuple[int, bytes]]]:
    """For each leaf of a block, the runs on its way to the block's root: its place
    in the run, and the digests of the run."""
    held = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
    ways: list[list[tuple[int, bytes]]] = [[] for _ in range(n)]
    count, width = n, 64 * fanout
    for up in range(height):
        text = level(held, height, up, 0, count, fanout)
        runs = [text[at : at + width] for at in range(0, len(text), width)]
        span = fanout**up
        for leaf, way in enumerate(ways):
            node = leaf // span
            way.append((node % fanout, runs[node // fanout]))
        count = len(runs)
    return ways


def proof(way: list[tuple[int, bytes]]) -> str:
    """Digest of all siblings on the way, left to right and level by level."""
    found = hashlib.sha256()
    for place, run in way:
        found.update(run[: 64 * place])
        found.update(run[64 * place + 64 :])
    return found.hexdigest()


def fold(leaf: str, way: list[tuple[int, bytes]]) -> str:
    """The root that a leaf and the siblings on its way give."""
    for place, run in way:
        leaf = hashlib.sha256(run[: 64 * place] + leaf.encode() + run[64 * place + 64 :]).hexdigest()
    return leaf


# -- leaves ------------------------------------------------------------------


def leaf_digest(**replaced: Column) -> Column:
    """Digest of a row's fields, each with its length in bytes; a null one is a dash."""
    parts = []
    for name in FIELDS:
        value = replaced.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def tampered_digest() -> Column:
    """Digest of a row after tampering: A-Z of every third text become lower case."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return F.when(chosen, leaf_digest(text=F.translate("text", _UPPER, _LOWER))).otherwise(leaf_digest())


def ascending(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number the rows of each tree from 0 in ascending order, with the tree's size n.

    Rows are dealt by ranges of the whole order, so a tree may hold any share of
    them; each range is numbered by itself from where the ranges before it end.
    """
    ranges = max(1, -(-df.count() // RANGE_ROWS))
    dealt = stored(df.repartitionByRange(ranges, "tree", *order).withColumn("_range", F.spark_partition_id()), name)
    sizes = dealt.groupBy("tree", "_range").agg(F.count(F.lit(1)).alias("_n"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("tree", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(tree).alias("n"))
    place = F.row_number().over(Window.partitionBy("tree", "_range").orderBy(*order)) - 1
    numbered = dealt.withColumn("_at", place).join(starts, ["tree", "_range"])
    return numbered.withColumn("index", (F.col("_start") + F.col("_at")).cast("long")).drop("_range", "_start", "_at")


# -- blocks ------------------------------------------------------------------

_BLOCK = "tree string, stage int, block long, n long, height int, leaves int, nodes binary, root string"


def _blocks(leaves: DataFrame, stage: int, height: int) -> DataFrame:
    """Blocks of one stage out of (tree, n, index, digest); n is the tree's number
    of leaves at this stage."""

    def run(table: pa.Table) -> pa.Table:
        tree, n, block = (table[c][0].as_py() for c in ("tree", "n", "block"))
        order = np.argsort(table["index"].to_numpy())
        digests = table["digest"].to_pylist()
        rows = np.frombuffer(bytes.fromhex("".join(digests[i] for i in order)), np.uint8).reshape(-1, 32)
        own = min(height, steps(n))
        nodes = build(rows, own)
        made = [tree, stage, block, n, own, len(rows), nodes, nodes[:32].hex()]
        return pa.table({f.split()[0]: [x] for f, x in zip(_BLOCK.split(", "), made)}, schema=_arrow(_BLOCK))

    span = FANOUT**height
    dealt = leaves.select("tree", "n", F.expr(f"index div {span}").alias("block"), "index", "digest")
    return stored(dealt.groupBy("tree", "n", "block").applyInArrow(run, _BLOCK), f"blocks-{stage}")


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


def _grow(leaves: DataFrame, height: int) -> list[DataFrame]:
    """Blocks of all stages of the trees of (tree, n, index, digest)."""
    stages = [_blocks(leaves, 0, height)]
    while True:
        more = stages[-1].filter(F.col("n") > FANOUT**height)
        if more.isEmpty():
            return stages
        up = more.select("tree", F.ceil(F.col("n") / FANOUT**height).cast("long").alias("n"), F.col("block").alias("index"), F.col("root").alias("digest"))
        stages.append(_blocks(up, len(stages), height))


def _roots(stages: list[DataFrame], height: int) -> DataFrame:
    """(tree, digest): root of the one block that a tree ends in."""
    ends = [b.filter(F.col("n") <= FANOUT**height).select("tree", F.col("root").alias("digest")) for b in stages]
    out = ends[0]
    for e in ends[1:]:
        out = out.unionByName(e)
    return out


@dataclass(frozen=True)
class Manifest:
    """Stored leaves (tree, n, index, digest and what was kept beside them), blocks of
    every stage of the trees and of the tree of roots, and the root of all."""

    leaves: DataFrame
    stages: list[DataFrame]
    top: list[DataFrame]
    roots: DataFrame
    root: str | None
    height: int

    def blocks(self) -> DataFrame:
        """All blocks as one table, as it is kept beside the data."""
        out = self.stages[0]
        for b in [*self.stages[1:], *self.top]:
            out = out.unionByName(b)
        return out


def make_manifest(docs: DataFrame, keep: dict[str, Column] | None = None, height: int = HEIGHT) -> Manifest:
    """Digests of all rows and of the trees above them.

    Trees are languages, null before all others and else by their bytes; leaves
    ascend by doc_id (null first), equal ids by digest.  Repeated rows are leaves of
    their own.  An empty table has no root.  Columns other than those hashed are not
    read.  `keep` adds columns to the leaves.
    """
    prepare(docs.sparkSession)
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))
    rows = docs.select(tree.alias("tree"), "doc_id", leaf_digest().alias("digest"), *[c.alias(n) for n, c in (keep or {}).items()])
    # rows that are equal in all of these are told apart by where they were stored
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "digests")
    leaves = stored(ascending(rows, ["doc_id", "digest", "_row"], "ranges").drop("_row"), "leaves")
    stages = _grow(leaves, height)
    ends = stored(_roots(stages, height).select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "digest"), "ends")
    roots = stored(ascending(ends, ["name"], "roots"), "roots")
    top = _grow(roots, height)
    root = _roots(top, height).first()
    return Manifest(leaves, stages, top, roots, root["digest"] if root else None, height)


_WAY = "tree string, block long, subroot string, places array<int>, runs array<string>"


def _ways(blocks: DataFrame, way: DataFrame, height: int) -> DataFrame:
    """Ways of the leaves of these blocks, out of those of the blocks themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                first = r["block"] * FANOUT**height
                found = above(r["nodes"], r["height"], r["leaves"])
                rows = [(r["tree"], first + i, r["subroot"], [p for p, _ in w] + r["places"], [t.decode() for _, t in w] + r["runs"]) for i, w in enumerate(found)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _arrow(_WAY))], schema=_arrow(_WAY))

    return blocks.join(way, ["tree", "block"]).mapInArrow(run, _WAY)


def _descend(stages: list[DataFrame], way: DataFrame, height: int) -> DataFrame:
    """Ways of the blocks of the lowest stage, from those of the trees (tree, subroot,
    places, runs)."""
    whole = FANOUT**height
    last = lambda b: b.filter(F.col("n") <= whole).select("tree", F.lit(0).cast("long").alias("block")).join(way, "tree")
    found = last(stages[-1])
    for stage in reversed(range(1, len(stages))):
        # trees that end in the stage below start there
        found = stored(_ways(stages[stage], found, height).unionByName(last(stages[stage - 1])), f"ways-{stage}")
    return found.select(*[f.split()[0] for f in _WAY.split(", ")])


_PROVED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def prove(manifest: Manifest, presented: str) -> DataFrame:
    """Hold the digest that a kept column presents for each leaf against the root.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root and verified; the
    siblings come from the stored blocks.  A block of at most FANOUT^height leaves
    is the unit of work, whatever the size of its tree.
    """
    height, root = manifest.height, manifest.root
    spark = manifest.leaves.sparkSession
    if root is None:
        return spark.createDataFrame([], _PROVED)
    start = spark.createDataFrame([(TOP, None, [], [])], "tree string, subroot string, places array<int>, runs array<string>")
    over = _descend(manifest.top, start, height)
    trees = manifest.roots.select(F.lit(TOP).alias("tree"), "index", F.col("name"), "digest")
    of_tree = stored(
        _ways(manifest.top[0], over, height).join(trees.withColumnRenamed("index", "block"), ["tree", "block"]).select(
            F.col("name").alias("tree"), F.col("digest").alias("subroot"), "places", "runs"
        ),
        "tree-ways",
    )
    ways = _descend(manifest.stages, of_tree, height)
    blocks = stored(manifest.stages[0].join(ways, ["tree", "block"]).select("tree", "block", "height", "leaves", "nodes", "subroot", "places", "runs"), "held")
    span = FANOUT**height

    def run(rows: pa.Table, block: pa.Table) -> pa.Table:
        b = block.to_pylist()[0]
        beyond = [(p, t.encode()) for p, t in zip(b["places"], b["runs"])]
        found = above(b["nodes"], b["height"], b["leaves"])
        out: list[list] = [[] for _ in range(7)]
        columns = (rows[c].to_pylist() for c in ("doc_id", "index", "digest", presented))
        for doc_id, index, leaf, shown in zip(*columns):
            way = found[index % span] + beyond
            folded = fold(shown, way)
            for column, value in zip(out, (doc_id, leaf, b["subroot"], root, proof(way), folded, folded == root)):
                column.append(value)
        return pa.table([pa.array(c, f.type) for c, f in zip(out, _arrow(_PROVED))], schema=_arrow(_PROVED))

    dealt = manifest.leaves.select("tree", F.expr(f"index div {span}").alias("block"), "doc_id", "index", "digest", presented)
    return dealt.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(run, _PROVED)


def verify_tampered(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The manifest of `docs`, held against the rows after tampering: every third
    text (by the checksum of its id) has its A-Z in lower case.

    Null texts stay; rows without an id are not tampered with.  See make_manifest for
    nulls, ties, repeated rows and empty tables.  Texts are hashed whole.
    """
    return prove(make_manifest(docs, {"presented": tampered_digest()}, height), "presented")
