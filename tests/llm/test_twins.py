"""The SQL of the queries against the operators, on planted cases that the test tables lack."""

import duckdb
import numpy as np

from lakemart.llm import centroids, crosspolytope, manifest, twins
from tests.oracle import differences


def against(spark, folder, name, df, op, sql):
    df.coalesce(1).write.parquet(f"{folder}/{name}")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}/*.parquet'")
    extra, lacking, count = differences(op(spark.read.parquet(f"{folder}/{name}")), con, sql)
    assert (extra, lacking) == ([], []) and count == df.count()


def test_manifest(spark, tmp_path):
    rows = [(i, f"Text ÄA {i % 7}", [None, "en", "de", "", "ö"][i % 5] if i % 3 else "en", None if i % 11 == 0 else "s", i) for i in range(300)]
    rows += [(1000 + i, None if i else "", f"l{i:02}", "x", None) for i in range(10)] + [(-3, "A", "en", "s", 1), (10**15, "B", "en", "s", 1), (None, "C", "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    against(spark, str(tmp_path), "documents", df, manifest.verify_tampered, twins.manifest_sql())


def vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 64))
    rows = [(i, v.astype(np.float32).tolist(), i % 3) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 20] + 0.1 * rng.normal(size=64)).astype(np.float32).tolist(), i % 20 % 3) for i in range(80)]
    rows += [(300, rows[0][1], None), (301, None, 0), (302, [0.0] * 64, 0), (303, [1.0, 2.0], 0), (304, [2.0, 4.0], 0), (305, [float("nan")] * 64, 1), (306, rows[0][1], 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_near_vectors(spark, tmp_path):
    against(spark, str(tmp_path), "embeddings", vectors(spark), crosspolytope.near_vectors, twins.near_vectors_sql())


def test_centroids(spark, tmp_path):
    df = vectors(spark).filter("size(embedding) = 64 AND NOT isnan(embedding[0])")
    against(spark, str(tmp_path), "embeddings", df, centroids.cluster, twins.centroids_sql())
