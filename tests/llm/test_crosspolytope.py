import math

import numpy as np

from lakemart.llm import crosspolytope as X


def plain(rows, least=0.93):
    """Comparing all pairs."""
    real = lambda v: v is not None and any(v) and all(x is not None and math.isfinite(x) for x in v)
    usable = [i for i, (vec, v, label) in enumerate(rows) if vec is not None and label is not None and real(v)]
    unit = {i: np.array(rows[i][1]) / np.abs(rows[i][1]).max() for i in usable}
    links = {i: set() for i in range(len(rows))}
    for i in usable:
        for j in usable:
            if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]):
                a, b = unit[i], unit[j]
                if (a * b).sum() / math.sqrt((a * a).sum()) / math.sqrt((b * b).sum()) >= least:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i, (vec, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for n in links[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        low = min((rows[n][0] for n in seen if rows[n][0] is not None), default=None)
        out.append((vec, len(links[i]), low, vec is not None and low == vec))
    return sorted(out, key=repr)


def near(rng, base, cosine):
    other = rng.normal(size=base.shape)
    other -= (other * base).sum(axis=1, keepdims=True) / (base * base).sum(axis=1, keepdims=True) * base
    other *= np.linalg.norm(base, axis=1, keepdims=True) / np.linalg.norm(other, axis=1, keepdims=True)
    return cosine * base + math.sqrt(1 - cosine * cosine) * other


def answers(df, **more):
    return sorted(map(tuple, X.near_vectors(df, **more).collect()), key=repr)


def single(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows]


def test_against_brute_force(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(250, 64))
    vectors = np.concatenate([base, near(rng, base[:120], 0.94), near(rng, base[:60], 0.92), 3 * near(rng, base[100:200], 0.97)])
    rows = [(i, v.astype(np.float32).tolist(), int(i % 250 % 3)) for i, v in enumerate(vectors)]
    hot = near(rng, np.repeat(base[:1], 200, axis=0), 0.975)  # a dense group
    rows += [(1000 + i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(hot)]
    rows += [(2000 + i, rows[3][1], 0) for i in range(150)]  # copies
    rows += [(5, rows[9][1], 0), (5, rows[3][1], 0), (None, rows[3][1], 0), (3000, rows[3][1], None), (3001, rows[3][1], 7)]
    odd = [None, [], [0.0] * 64, [float("nan")] * 64, [None] + [1.0] * 63, [float("inf")] * 64]
    rows += [(4000 + i, v, 0) for i, v in enumerate(odd)]
    rows += [(5000, [1.0, 2.0], 0), (5001, [2.0, 4.1], 0), (5002, [-1.0, -2.0], 0), (5003, [1.0], 0), (5004, [2.0], 0)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, node int, kept int")
    want = plain(single(rows))
    assert answers(df) == want
    # crowded buckets are cut into cells, and tasks work on several groups
    assert answers(df, cell=16, group_rows=100) == want


def test_large_and_small_components(spark):
    rows = [(1, [1e300, 1e300], 0), (2, [1e-300, 1.01e-300], 0), (3, [1e300, -1e300], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert answers(df) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_bound_is_kept(spark):
    # cosines just above, at and just below the bound
    angle = math.acos(0.93)
    rows = [(0, [1.0] + [0.0] * 63, "x")] + [
        (1 + i, [math.cos(angle + off), math.sin(angle + off)] + [0.0] * 62, f"{'x' if i < 9 else 'y'}") for i, off in enumerate([-1e-6, 1e-6])
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r["vec_id"]: r for r in X.near_vectors(df).collect()}
    assert got[1]["n_links"] == 2 and got[0]["n_links"] == 1 and got[2]["n_links"] == 1


def test_recall_by_number_of_hashes():
    """Pairs at the bound meet in some table, whatever the number of hashes."""
    rng = np.random.default_rng(8)
    for dim, least in ((64, 0.9995), (16, 0.9995), (300, 0.99)):
        base = rng.normal(size=(4000, dim))
        other = near(rng, base, 0.93)
        for hashes in (1, 2, 3):
            a, b = X.buckets(base, hashes), X.buckets(other, hashes)
            met = (a == b[:, :, :1]).any(axis=2) | (b == a[:, :, :1]).any(axis=2)
            assert met.any(axis=1).mean() >= least, (dim, hashes, met.any(axis=1).mean())
    assert X.hashes_for(5_000, 64) == 1 and X.hashes_for(100_000, 64) == 2 and X.hashes_for(10**8, 64) == 3


def test_turns_keep_lengths():
    v = np.random.default_rng(1).normal(size=(20, 48))
    assert np.allclose(np.linalg.norm(X.turned(v, 3), axis=1), np.linalg.norm(v, axis=1))


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert X.near_vectors(df).collect() == []
