import hashlib
import math

import numpy as np

from lakemart.llm import centroids as C


def plain(rows, k=8, rounds=10, dim=64):
    """(vec_id, cluster, distance, cluster_inertia, inertia, sha) by comparing with every centroid."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    hashed = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in hashed[:k]]
    if not centroids:
        return []

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        where = [n for _, n in assign()]
        for n in range(len(centroids)):
            own = [v for (_, v), w in zip(kept, where) if w == n]
            if own:
                centroids[n] = [sum(column) // len(own) for column in zip(*own)]
    last = assign()
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i, n, d, sum(e for e, m in last if m == n), sum(e for e, _ in last), sha[n]) for (i, _), (d, n) in zip(kept, last)), key=repr
    )


def as_rows(df):
    return sorted(map(tuple, df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def test_threshold_walk_is_exact():
    rng = np.random.default_rng(2)
    for k, dim, spread in [(8, 64, 500), (1, 3, 5), (40, 2, 4), (200, 3, 1000), (8, 1, 3)]:
        centroids = rng.integers(-spread, spread, (k, dim))
        centroids[-1] = centroids[0]  # ties go to the smaller number
        points = np.concatenate([rng.integers(-2 * spread, 2 * spread, (300, dim)), centroids])
        which, best, depth = C.nearest(points, centroids)
        every = ((points[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        assert (which == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
        assert (depth >= 1).all() and (depth <= k).all()
    # few dimensions and many centroids: the walk ends long before the lists do
    assert C.nearest(rng.integers(-1000, 1000, (100, 2)), rng.integers(-1000, 1000, (500, 2)))[2].max() < 250


def test_walk_goes_on_while_the_frontier_only_ties():
    # centroid 0 is as near as centroid 1, but stands behind it in the list
    which, best, _ = C.nearest(np.array([[0]]), np.array([[3], [-3]]))
    assert (which[0], best[0]) == (0, 9)


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(5, 64))
    rows = [(i, (centre[i % 5] + 0.3 * rng.normal(size=64)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(150)]  # a third of the rows is one vector
    rows += [(7, rows[8][1]), (None, rows[9][1])]
    odd = [None, [], [1.0] * 63, [1.0] * 65, [None] + [1.0] * 63, [float("nan")] * 64, [float("inf")] * 64, [-float("inf")] * 64]
    rows += [(900 + i, v) for i, v in enumerate(odd)] + [(950, [0.0] * 64), (951, [-0.0005] * 64)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<float>, cluster int, point int, label int")
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert as_rows(C.cluster(df)) == plain(exact)


def test_too_large_components_take_no_part(spark):
    rows = [(1, [1e30] + [0.0] * 63), (2, [131071.0] * 64), (3, [-131071.0] * 64), (4, [131072.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = C.cluster(df, k=1, rounds=0).collect()
    assert sorted(r["vec_id"] for r in got) == [2, 3] and max(r["distance"] for r in got) == 64 * (2 * 131071 * 1024) ** 2


def test_small_and_empty_tables(spark):
    df = spark.createDataFrame([(1, [0.5] * 64), (2, [0.25] * 64)], "vec_id long, embedding array<double>")
    assert as_rows(C.cluster(df)) == plain([(1, [0.5] * 64), (2, [0.25] * 64)])
    assert C.cluster(df.limit(0)).collect() == []
    assert C.cluster(df.withColumn("vec_id", df.vec_id * None)).collect() == []
