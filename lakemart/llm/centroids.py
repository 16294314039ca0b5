"""Clustering of whole-number vectors around centroids, by the threshold algorithm.

For every dimension the centroids' values stand in a sorted list.  From the value
of a vector each list is walked outward, the nearer side first.  Every centroid
met on the way is measured exactly.  A centroid that no list has shown yet is in
each dimension at least as far as the entry just taken there, so the walk ends
when the sum of these squared frontier distances strictly exceeds the best exact
distance: what comes later can neither be nearer nor tie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import per_batch, prepare, stored

CLUSTERS, ROUNDS, DIM, SCALE, SALT = 8, 10, 64, 1024, "3:"


def largest(dim: int) -> int:
    """Components below this in absolute value have squared distances that fit into a long."""
    return 1 << ((62 - (4 * dim - 1).bit_length()) // 2)


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller), squared distance, and
    entries taken of each list, for every row of `points`."""
    n, (k, dim) = len(points), centroids.shape
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, axis=0)
    at = np.arange(dim)
    right = np.empty((n, dim), np.int64)
    for d in range(dim):
        right[:, d] = np.searchsorted(lists[:, d], points[:, d])
    left = right - 1
    none = np.iinfo(np.int64).max
    best, which, depth = np.full(n, none), np.zeros(n, np.int64), np.zeros(n, np.int64)
    seen = np.zeros((n, k), bool)
    walking = np.arange(n)
    while len(walking):
        x, low, high = points[walking], left[walking], right[walking]
        below = np.where(low >= 0, x - lists[np.maximum(low, 0), at], none)
        above = np.where(high < k, lists[np.minimum(high, k - 1), at] - x, none)
        down = below <= above
        frontier = np.minimum(below, above)
        met = np.zeros((len(walking), k), bool)
        met[np.arange(len(walking))[:, None], order[np.where(down, low, high), at]] = True
        row, centroid = np.nonzero(met & ~seen[walking])
        seen[walking[row], centroid] = True
        exact = ((x[row] - centroids[centroid]) ** 2).sum(axis=1)
        found = np.full(met.shape, none)
        found[row, centroid] = exact
        first = found.argmin(axis=1)
        least = found[np.arange(len(walking)), first]
        better = (least < best[walking]) | ((least == best[walking]) & (least < none) & (first < which[walking]))
        best[walking[better]], which[walking[better]] = least[better], first[better]
        depth[walking] += 1
        left[walking] -= down
        right[walking] += ~down
        ended = ((frontier**2).sum(axis=1) > best[walking]) | seen[walking].all(axis=1)
        walking = walking[~ended]
    return which, best, depth


def _points(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def on_grid(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id, point): the vectors that take part, as whole numbers floor(scale * x)."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < largest(dim) / scale))
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter((F.size(e) == dim) & F.coalesce(finite, F.lit(False)))
    return kept.select("vec_id", F.transform(e, lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("point"))


def seeds(grid: DataFrame, k: int = CLUSTERS, salt: str = SALT) -> np.ndarray:
    """The points of the ids with the k smallest hashes, in the order of the hashes."""
    hashed = grid.filter("vec_id IS NOT NULL").select(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256).alias("h"), "point")
    return np.array([r["point"] for r in hashed.orderBy("h", "point").limit(k).collect()], np.int64)


def _moved(grid: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round.  Each task adds up the points of a cluster, so
    a row for each task, cluster and dimension is shuffled."""
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            points = _points(batch.column("point"), dim)
            which = nearest(points, centroids)[0]
            n += np.bincount(which, minlength=len(centroids))
            for c in np.unique(which):
                sums[c] += points[which == c].sum(axis=0)
        held = np.flatnonzero(n)
        columns = [pa.array(held, pa.int32()), pa.array(n[held], pa.int64()), pa.array(list(sums[held]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "sums"])

    parts = grid.select("point").mapInArrow(run, "cluster int, n long, sums array<long>")
    rows = parts.select("cluster", "n", F.posexplode("sums").alias("d", "x")).groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    out = centroids.copy()
    for r in rows.collect():  # clusters x dimensions
        out[r["cluster"], r["d"]] = r["x"] // r["n"]
    return out


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, salt: str = SALT) -> DataFrame:
    """Per vector that takes part: vec_id, cluster, distance, cluster_inertia,
    inertia and centroid_sha256.

    Vectors take part that have `dim` components, none null or not finite, as whole
    numbers floor(scale * x).  A component of 2^27 / scale and more (for 64 dimensions)
    makes distances that no long holds; such vectors take no part either.  Rows that
    repeat an id are vectors like any other (as seeds, ordered by their points); rows
    without an id are clustered but seed no centroid.  With fewer than `k` vectors
    each is a centroid.  Sums beyond a long are null.  Null, empty and longer vectors
    give no row, an empty table gives none, and other columns are not read.  Between
    rounds only the centroids pass through the driver, `k` times `dim` numbers.
    """
    spark = prepare(vectors.sparkSession)
    grid = stored(on_grid(vectors, dim, scale), "grid")
    centroids = seeds(grid, k, salt)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        moved = _moved(grid, centroids)
        if (moved == centroids).all():  # every further round gives the same
            break
        centroids = moved

    def run(batch: pa.RecordBatch) -> dict:
        which, best, _ = nearest(_points(batch.column("point"), dim), centroids)
        return {"cluster": which, "distance": best}

    assigned = stored(per_batch(grid, run, "cluster int, distance long", ["vec_id"]), "assigned")
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda x: x if x < 1 << 63 else None
    facts = [
        (c, fits(s), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sums.items()
    ]
    named = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(named), "cluster").select(*[f.split()[0] for f in schema.split(", ")])
