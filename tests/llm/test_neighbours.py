import numpy as np

from lakemart.llm import neighbours as N


def plain(rows, asked, k):
    real = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, a in real:
        if q % asked == 0:
            near = sorted(((-(a * b).sum(), i) for i, b in real if i != q and len(a) == len(b)))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near)]
    return sorted(out)


def test_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=24).astype(np.float32).tolist()) for i in range(700)]
    rows += [(700 + i, rows[5][1]) for i in range(60)]  # copies: ties go to the smaller id
    rows += [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [None] + [1.0] * 23), (905, [float("inf")] * 24), (None, rows[0][1])]
    rows += [(i, rng.normal(size=5).tolist()) for i in range(1000, 1012)]
    rows.append((1100, [1.0]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    as_float = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = sorted(map(tuple, N.search(df, df.filter("vec_id % 20 = 0"), vector_block=100, query_block=16).collect()))
    want = plain(as_float, 20, N.NEAREST)
    assert got == want


def test_estimates_stay_within_their_bound():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(500, 64))
    centre, turn = vectors.mean(axis=0), N.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    bits, correction, error = N.encode(vectors, centre, turn)
    assert bits.shape == (500, 8)
    queries = rng.normal(size=(50, 64))
    signs = np.unpackbits(bits, axis=1) * 2.0 - 1
    estimate = (queries @ turn) @ signs.T * correction + (queries @ centre)[:, None]
    off = np.abs(estimate - queries @ vectors.T) / (np.linalg.norm(queries, axis=1)[:, None] * error)
    assert (off < N.ERROR_WIDTH).mean() > 0.999


def test_small_and_empty_tables(spark):
    df = spark.createDataFrame([(20, [1.0, 2.0]), (40, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, N.search(df, df).collect())) == [(20, 1, 40, 4.0), (40, 1, 20, 4.0)]
    none = df.limit(0)
    assert N.search(none, none).count() == 0 and N.search(df, none).count() == 0
