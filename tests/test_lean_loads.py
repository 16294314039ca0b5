"""Loads shuffle and write no more than they store."""

import glob

from lakemart.functions.keys import surrogate_key
from lakemart.plans.model import Model
from lakemart.sinks.versions import Tables


def test_a_step_over_bare_rows_gives_the_digests_back(spark, rows):
    m = Model("m", (), lambda: None, digests=(("id", ("a", "b")), ("other", ("c",))))
    df = rows([("x", None)], "a string, b string").select(surrogate_key("a", "b").alias("id"), "a", "b")
    seen = []
    out = m.bare(df, lambda r: seen.append(r.columns) or r)
    assert seen == [["a", "b"]] and out.columns == df.columns and out.collect() == df.collect()


def test_rows_of_one_bucket_are_written_where_they_are(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    df = spark.range(1000, numPartitions=4).withColumn("id_text", surrogate_key("id"))
    tables.replace_buckets("t", df, ("id",), fresh=True, made={"id_text": surrogate_key("id")})
    assert len(glob.glob(f"{tmp_path}/t/p=*/_part=b/*.parquet")) == 4
    assert tables.read("t").exceptAll(df).count() == 0 and tables.read("t").count() == 1000
    tables = Tables(spark, str(tmp_path), bucket_bytes=1 << 12)
    tables.replace_buckets("u", df, ("id",), fresh=True, made={"id_text": surrogate_key("id")})
    assert len(tables.parts("u")) > 1
    assert tables.read("u").exceptAll(df).count() == 0 and tables.read("u").count() == 1000


def test_changes_are_written_beside_their_table_only(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.replace_buckets("t", spark.range(10), ("id",), fresh=True)
    before = tables.version("t")
    path, changed = tables.keep_changes("t", spark.range(10, 12))
    tables.replace_buckets("t", spark.range(12), ("id",), ["b"], changes=path)
    assert tables.changes_since("t", before) == [path]
    assert sorted(r.id for r in tables.changed_rows("t", [path]).collect()) == sorted(r.id for r in changed.collect()) == [10, 11]


def test_a_load_without_news_leaves_nothing(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.write("t", spark.range(3))
    version, before = tables.version("t"), sorted(glob.glob(f"{tmp_path}/t/*"))
    assert not tables.add_any("t", spark.range(0))
    assert tables.version("t") == version and sorted(glob.glob(f"{tmp_path}/t/*")) == before
    assert tables.add_any("t", spark.range(3, 5)) and tables.read("t").count() == 5
