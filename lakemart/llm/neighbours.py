"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Vectors are centred, rotated by one random orthogonal matrix and kept as one bit
per component, with two scalars that correct the inner product of a code to an
unbiased estimate of the true one, and a bound of its error.  Queries run over
the codes in blocks; only vectors whose upper bound reaches the k-th best exact
value found so far are measured exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.common import stored

NEAREST = 20
#: Vectors in one block of codes, and queries in one block of queries.
VECTOR_BLOCK, QUERY_BLOCK = 8192, 1024
#: Width of the error bound in standard deviations of the estimate.
ERROR_WIDTH = 4.0
SEED = 7


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bits, correction scalar and error scale of each vector.

    With s = +-1/sqrt(dim) by the signs of the rotated residual r, <r, q> is
    estimated by <s, q> |r|^2 / <s, r>; the error of that estimate grows with
    |q| sqrt(|r|^2 - <s, r>^2) |r| / <s, r> / sqrt(dim - 1).
    """
    dim = vectors.shape[1]
    residual = (vectors - centre) @ turn
    length2 = np.einsum("ij,ij->i", residual, residual)
    signs = residual >= 0
    along = np.abs(residual).sum(axis=1) / np.sqrt(dim)
    safe = np.where(along > 0, along, 1.0)
    correction = np.where(along > 0, length2 / safe, 0.0) / np.sqrt(dim)
    error = np.sqrt(np.maximum(length2 - along**2, 0) * length2) / safe / np.sqrt(max(1, dim - 1))
    return np.packbits(signs, axis=1), correction, error


def nearest_in_block(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, code: tuple, centre: np.ndarray, turn: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vec_id, score) of the k best of one block for each query of a block."""
    bits, correction, error = code
    dim = vectors.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    rotated = (queries @ turn).astype(np.float32)
    base = queries @ centre
    reach = np.linalg.norm(queries, axis=1)
    out: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(queries), 128):
        part = slice(at, at + 128)
        estimate = (rotated[part] @ signs.T) * correction.astype(np.float32) + base[part, None].astype(np.float32)
        bound = estimate + (ERROR_WIDTH * reach[part, None] * error).astype(np.float32)
        own = query_ids[part, None] == ids[None, :]
        estimate[own] = -np.inf
        bound[own] = -np.inf
        few = min(k, estimate.shape[1])
        top = np.argpartition(-estimate, few - 1, axis=1)[:, :few]
        for j in range(len(estimate)):
            query = queries[at + j]
            # the k-th best of the most promising ones bounds the k-th best of all from below
            exact = (vectors[top[j]] * query).sum(axis=1)
            exact = exact[~own[j][top[j]]]
            least = exact.min() if len(exact) == k else -np.inf
            chosen = np.flatnonzero((bound[j] >= least - 1e-4 * (1 + abs(least))) & ~own[j]) if np.isfinite(least) else np.flatnonzero(~own[j])
            score = (vectors[chosen] * query).sum(axis=1)
            best = np.lexsort((ids[chosen], -score))[:k]
            out.append((np.full(len(best), query_ids[at + j]), ids[chosen][best], score[best]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else tuple(np.zeros(0) for _ in range(3))


def _blocks(df: DataFrame, blocks: int, name: str) -> DataFrame:
    """One row for each block: its ids and its vectors as bytes."""

    def run(table: pa.Table) -> pa.Table:
        ids = table["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        values = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table["embedding"].chunks])
        vectors = values.reshape(len(ids), -1)[order].astype(np.float64)
        row = {"dim": [vectors.shape[1]], "block": [table["block"][0].as_py()], "ids": [ids[order].tobytes()], "vectors": [vectors.tobytes()]}
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(row.items(), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))})

    dealt = df.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    return stored(dealt.groupBy("dim", "block").applyInArrow(run, "dim int, block long, ids binary, vectors binary"), name)


def search(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, vector_block: int = VECTOR_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest vectors of each query.

    Both inputs have vec_id and embedding.  A query is never its own neighbour.
    Vectors that are null, empty or zero, that hold a null or non-finite component, or
    that have no id take no part; vectors of different lengths are not compared.
    Of rows that repeat an id each counts.  Scores are inner products in double
    precision, summed in one fixed order; ties go to the smaller vec_id.
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        e = F.col("embedding")
        finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
        real = F.exists(e, lambda x: x != 0)
        kept = df.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding")).filter("vec_id IS NOT NULL")
        return kept.filter(F.coalesce(finite & real, F.lit(False))).withColumn("dim", F.size("embedding"))

    base = usable(vectors)
    asked = usable(queries)
    counts = {r["dim"]: r["n"] for r in base.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_asked = asked.count()
    blocks = max(1, -(-max(counts.values(), default=0) // vector_block))
    # the mean of all vectors of a length, one number for each component
    means = base.select("dim", F.posexplode("embedding").alias("at", "x")).groupBy("dim", "at").agg(F.avg("x").alias("x"))
    centres: dict[int, np.ndarray] = {d: np.zeros(d) for d in counts}
    for r in means.toLocalIterator():
        centres[r["dim"]][r["at"]] = r["x"]
    shared = spark.sparkContext.broadcast({d: (c, rotation(d)) for d, c in centres.items()})

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, correction, error = [], [], []
            for dim, raw in zip(batch.column("dim").to_pylist(), batch.column("vectors").to_pylist()):
                b, c, e = encode(np.frombuffer(raw).reshape(-1, dim), *shared.value[dim])
                bits.append(b.tobytes())
                correction.append(c.tobytes())
                error.append(e.tobytes())
            columns = [*batch.columns, *(pa.array(x, pa.binary()) for x in (bits, correction, error))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "bits", "correction", "error"])

    packed = _blocks(base, blocks, "vectors")
    index = stored(packed.mapInArrow(codes, T.StructType([*packed.schema, *(T.StructField(n, T.BinaryType()) for n in ("bits", "correction", "error"))])), "index")
    asked = _blocks(asked, max(1, -(-n_asked // query_block)), "queries").select(
        "dim", F.col("block").alias("query_block"), F.col("ids").alias("query_ids"), F.col("vectors").alias("queries")
    )
    # every block of queries meets every block of its length, each pair in a row of its own
    met = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).join(index, ["dim", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                dim = r["dim"]
                centre, turn = shared.value[dim]
                ids = np.frombuffer(r["ids"], np.int64)
                code = (
                    np.frombuffer(r["bits"], np.uint8).reshape(len(ids), -1), np.frombuffer(r["correction"]), np.frombuffer(r["error"]),
                )
                found = nearest_in_block(
                    np.frombuffer(r["queries"]).reshape(-1, dim), np.frombuffer(r["query_ids"], np.int64),
                    np.frombuffer(r["vectors"]).reshape(-1, dim), ids, code, centre, turn, k,
                )
                types = (pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types)], names=["query_id", "vec_id", "score"])

    spread = met.repartition(max(1, min(met.count(), 2000)), "query_block", "block", "dim")
    near = spread.mapInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
