"""Near-duplicate vectors of one label by cross-polytope hashing.

A vector is turned by three rounds of random signs and a fast Hadamard transform;
its hash is the nearest vertex of the cross-polytope, that is the largest component
in absolute value with its sign.  Several hashes make the bucket of a table.  Each
vector is held in its own bucket of every table and asks there and in the next most
likely ones (multiprobe).  What meets in a bucket is compared exactly; a pair that
meets several times counts at its first meeting only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import per_batch, prepare, stored
from lakemart.llm.minhash import components

LEAST = 0.93
#: Tables, and buckets asked in each, by the number of hashes that make a bucket.
#: Of pairs at the least cosine about 1 in 10^5 is missed with 64 components.
TABLES, PROBES = (4, 6, 8), (4, 8, 24)
#: Vectors of one label that a bucket should hold on average, at most.
PER_BUCKET = 64
#: Rows of one side that are compared in one piece; a larger bucket is cut into cells.
CELL = 2048
#: Rows of the groups that tasks work on, and rows compared with a cell at once.
GROUP_ROWS, ROWS_AT_ONCE = 8192, 128
SEED = 11


def hashes_for(n: int, dim: int) -> int:
    """Hashes that make a bucket, so that n vectors of a label fill buckets evenly."""
    vertices = 2 * _width(dim)
    return min(len(TABLES), max(1, math.ceil(math.log(max(1, n / PER_BUCKET), vertices))))


def _width(dim: int) -> int:
    return max(2, 1 << (dim - 1).bit_length())


def turned(vectors: np.ndarray, which: int) -> np.ndarray:
    """The vectors, padded with zeros, after three rounds of signs and Hadamard transform."""
    n, dim = vectors.shape
    width = _width(dim)
    draw = np.random.default_rng([SEED, which, width])
    out = np.zeros((n, width))
    out[:, :dim] = vectors
    for _ in range(3):
        out *= draw.choice([-1.0, 1.0], width)
        step = 1
        while step < width:
            pairs = out.reshape(n, width // (2 * step), 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
            step *= 2
        out /= math.sqrt(width)
    return out


def buckets(vectors: np.ndarray, hashes: int) -> np.ndarray:
    """Buckets of each vector: (row, table, probe); probe 0 is the one it is held in."""
    tables, probes = TABLES[hashes - 1], PROBES[hashes - 1]
    vertices = 2 * _width(vectors.shape[1])
    out = np.empty((len(vectors), tables, probes), np.int64)
    for t in range(tables):
        lost, bucket = np.zeros((len(vectors), 1)), np.zeros((len(vectors), 1), np.int64)
        for h in range(hashes):
            y = turned(vectors, t * len(TABLES) + h)
            ends = np.concatenate([y, -y], axis=1)
            likely = np.argsort(-ends, axis=1, kind="stable")[:, : min(probes, vertices)]
            far = np.take_along_axis(ends, likely, axis=1)
            far = (far[:, :1] - far) ** 2
            # the likeliest combinations with the vertices of the hashes before
            lost = (lost[:, :, None] + far[:, None, :]).reshape(len(vectors), -1)
            bucket = (bucket[:, :, None] * vertices + likely[:, None, :]).reshape(len(vectors), -1)
            first = np.argsort(lost, axis=1, kind="stable")[:, :probes]
            lost, bucket = np.take_along_axis(lost, first, axis=1), np.take_along_axis(bucket, first, axis=1)
        # fewer vertices than probes: the rest asks nowhere new
        out[:, t] = np.pad(bucket, ((0, 0), (0, probes - bucket.shape[1])), mode="edge")
    return out


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two each, so that squares neither overflow nor vanish."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with the same row of b."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def similar(a: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and of b whose cosine is at least `least`.  Products by blocks decide
    all but the closest calls, which are measured in one fixed order."""
    lengths = [np.sqrt((x * x).sum(axis=1)) for x in (a, b)]
    rough = (a / lengths[0][:, None]) @ (b / lengths[1][:, None]).T
    i, j = np.nonzero(rough >= least - 1e-9)
    near = rough[i, j] < least + 1e-9
    keep = np.ones(len(i), bool)
    keep[near] = cosines(a[i[near]], b[j[near]]) >= least
    return i[keep], j[keep]


def _kinds(dim: int, hashes: int, single: bool) -> tuple[type, type]:
    """Number types of buckets and components in a packed row."""
    return (np.int32 if (2 * _width(dim)) ** hashes < 1 << 31 else np.int64), (np.float32 if single else np.float64)


def _places(vectors: DataFrame, most: int, single: bool) -> DataFrame:
    """A row for each bucket that a vector is held in or asks, with all its buckets."""

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"places": [], "packed": []}
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        made: list = [None] * len(dims)
        values = batch.column("embedding")
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            block = scaled(np.array([values[int(i)].values.to_numpy(zero_copy_only=False) for i in rows]))
            hashes = hashes_for(most, int(dim))
            number, component = _kinds(int(dim), hashes, single)
            for i, v, b in zip(rows, block.astype(component), buckets(block, hashes)):
                # a bucket asked twice for want of vertices is asked once
                places = [(t, x, p == 0) for t, row in enumerate(b.tolist()) for p, x in enumerate(row) if x not in row[:p]]
                made[i] = places, b.astype(number).tobytes() + v.tobytes()
        for places, packed in made:
            out["places"].append(places)
            out["packed"].append(packed)
        return out

    added = "places array<struct<table:int,bucket:long,own:boolean>>, packed binary"
    placed = per_batch(vectors, run, added, ["label", "dim", "node", "copies"])
    return placed.select("label", "dim", "node", "copies", "packed", F.explode("places").alias("p")).select(
        "label", "dim", "node", "copies", "packed", "p.table", "p.bucket", "p.own"
    )


def _dealt(placed: DataFrame, cell: int, group_rows: int) -> DataFrame:
    """Rows with the cell of their bucket and the group that a task works on.

    In a crowded bucket those held are cut into cells and those that ask into others;
    each cell of one side meets each of the other, wherever these run.
    """
    key = ["label", "dim", "table", "bucket"]
    sizes = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("asking"), F.count_if("own").alias("held"))
    sizes = stored(sizes, "bucket-sizes")
    crowded = sizes.filter(F.greatest("asking", "held") > cell).select(
        *key, F.ceil(F.col("held") / cell).cast("int").alias("held_cells"), F.ceil(F.col("asking") / cell).cast("int").alias("ask_cells")
    )
    rows = placed.join(crowded, key, "left")
    number = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.coalesce(n, F.lit(1))).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1)
    # a row asks in one cell of its side, against all cells of those held, and is held likewise
    asks = F.transform(every(F.col("held_cells")), lambda c: F.struct(number(F.col("ask_cells"), 1).alias("ask"), c.alias("hold"), F.lit(True).alias("asks")))
    holds = F.transform(every(F.col("ask_cells")), lambda c: F.struct(c.alias("ask"), number(F.col("held_cells"), 2).alias("hold"), F.lit(False).alias("asks")))
    # only a bucket that holds one and is asked by another can give a pair
    able = sizes.filter("held > 0 AND asking > 1").select(*key)
    rows = rows.join(able, key, "left_semi")
    rows = rows.withColumn("c", F.explode(F.when(F.col("own"), F.concat(asks, holds)).otherwise(asks)))
    total = sizes.agg(F.coalesce(F.sum(F.col("asking") + F.col("held")), F.lit(0)).alias("n")).first()["n"]
    groups = max(1, -(-int(total) // group_rows))
    group = F.pmod(F.xxhash64(*key, "c.ask", "c.hold"), F.lit(groups))
    return rows.select("label", "dim", "node", "copies", "packed", "table", "bucket", "c.ask", "c.hold", "c.asks", group.alias("group"))


def _compare(most: int, single: bool, least: float):
    """Links inside the cells of a group: for each node the vectors it is linked to,
    and the smallest node that it hangs together with in its cell."""

    def run(rows: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        column = {c: rows[c].to_numpy(zero_copy_only=False) for c in ("label", "dim", "table", "bucket", "ask", "hold", "node", "copies", "asks")}
        packed = rows["packed"].combine_chunks()
        cell = [column[c] for c in ("label", "dim", "table", "bucket", "ask", "hold")]
        order = np.lexsort([column["node"], *cell])
        new = np.ones(len(order), bool)
        new[1:] = np.any([c[order][1:] != c[order][:-1] for c in cell], axis=0)
        starts = np.flatnonzero(new)
        for start, end in zip(starts, np.append(starts[1:], len(order))):
            own = order[start:end]
            asking, held = own[column["asks"][own]], own[~column["asks"][own]]
            if len(asking) and len(held):
                dim, table = int(column["dim"][own[0]]), int(column["table"][own[0]])
                found = _cell([packed[int(i)].as_buffer() for i in asking], [packed[int(i)].as_buffer() for i in held], column["node"][asking], column["node"][held], dim, table, hashes_for(most, dim), single, least)
                if found is not None:
                    out.append(_summed(*found, column["node"], column["copies"], asking, held))
        done = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out) if out else [()] * 3)]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("node", "links", "root"), done)})

    return run


def _cell(asking: list, held: list, ask_nodes: np.ndarray, held_nodes: np.ndarray, dim: int, table: int, hashes: int, single: bool, least: float):
    """Positions (in asking, in held) of the links that this cell has to count."""
    tables, probes = TABLES[hashes - 1], PROBES[hashes - 1]
    number, component = _kinds(dim, hashes, single)
    read = lambda rows: np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
    places = tables * probes * np.dtype(number).itemsize
    sides = [read(asking), read(held)]
    vectors = [np.ascontiguousarray(x[:, places:]).view(component).astype(np.float64) for x in sides]
    asked = [np.ascontiguousarray(x[:, :places]).view(number).reshape(-1, tables, probes) for x in sides]
    i_all, j_all = [], []
    for at in range(0, len(asking), ROWS_AT_ONCE):
        i, j = similar(vectors[0][at : at + ROWS_AT_ONCE], vectors[1], least)
        i = i + at
        keep = ask_nodes[i] != held_nodes[j]
        # at the first table in which either asks the other's bucket the pair counts
        for t in range(table):
            met = (asked[0][i, t] == asked[1][j, t, :1]).any(axis=1) | (asked[1][j, t] == asked[0][i, t, :1]).any(axis=1)
            keep &= ~met
        # and once, if both ask
        both = (asked[1][j, table] == asked[0][i, table, :1]).any(axis=1)
        keep &= ~both | (ask_nodes[i] < held_nodes[j])
        i_all.append(i[keep])
        j_all.append(j[keep])
    i, j = np.concatenate(i_all), np.concatenate(j_all)
    return (i, j) if len(i) else None


def _summed(i: np.ndarray, j: np.ndarray, nodes: np.ndarray, copies: np.ndarray, asking: np.ndarray, held: np.ndarray):
    """(node, links, root) of one cell."""
    ends = [nodes[asking][i], nodes[held][j]]
    known, at = np.unique(np.concatenate(ends), return_inverse=True)
    a, b = at[: len(i)], at[len(i) :]
    links = np.zeros(len(known), np.int64)
    np.add.at(links, a, copies[held][j])
    np.add.at(links, b, copies[asking][i])
    root = np.arange(len(known))
    while True:
        low = np.minimum(root[a], root[b])
        step = root.copy()
        np.minimum.at(step, a, low)
        np.minimum.at(step, b, low)
        step = step[step]
        if (step == root).all():
            return known, links, known[root]
        root = step


def near_vectors(vectors: DataFrame, least: float = LEAST, cell: int = CELL, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Per row of `vectors`: vec_id, n_links, component_id and kept.

    Rows of one label and length are linked if their cosine, in double precision, is
    at least `least`.  n_links counts the other rows linked directly, component_id is
    the smallest id that links reach, and a row is kept if that is its own.  Candidates
    come from hashing; nothing below the bound is linked.  Rows without a label, and
    vectors that are null, empty or zero or hold a null or a component that is not
    finite, stand alone.  Equal vectors are compared as one.  Rows that repeat an id
    are rows of their own; rows without an id take no part, and have no component.  An
    empty table gives no rows; other columns are not read.
    """
    prepare(vectors.sparkSession)
    e = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", e.alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    fit = F.coalesce(finite & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    rows = stored(rows.withColumn("fit", fit).withColumn("row", F.monotonically_increasing_id()), "rows")
    usable = rows.filter("fit")
    classes = usable.groupBy("label", "embedding").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"))
    classes = stored(classes.withColumn("dim", F.size("embedding")), "classes")
    # labels of any type go by a number
    labels = stored(classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).withColumn("number", F.monotonically_increasing_id()), "labels")
    most = labels.agg(F.max("n")).first()[0] or 0
    numbered = classes.join(labels.drop("n"), "label").drop("label").withColumnRenamed("number", "label")
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    placed = stored(_places(numbered, most, single), "places")
    met = _dealt(placed, cell, group_rows)
    found = stored(met.groupBy("group").applyInArrow(_compare(most, single, least), "node long, links long, root long"), "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    hung = components(found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    judged = classes.select("node", "copies", "least_id").join(links, "node", "left").join(hung, "node", "left")
    judged = stored(judged.select("node", "least_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("label", "node").alias("root")), "judged")
    least_id = judged.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = classes.select("label", "embedding", "node").join(judged.join(least_id, "root").select("node", "n_links", "component_id"), "node")
    known = usable.select("row", "label", "embedding").join(of_class, ["label", "embedding"]).select("row", "n_links", "component_id")
    out = rows.select("row", "vec_id").join(known, "row", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )

