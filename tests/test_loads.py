"""Loads that change by key touch only the buckets of their keys."""

import os
from datetime import datetime

import pytest

from lakemart.operators import buckets, merge
from lakemart.plans import model as M
from lakemart.sinks.versions import ProtectedHistory, Tables

T1, T2, T3, T4 = (datetime(2024, 1, n) for n in (1, 2, 3, 4))


def models(load, **options):
    found = {}
    saved, M.MODELS = M.MODELS, found
    try:
        since = M.Since("copied_at")
        M.add("int_t", lambda src: src.select("k", "v", "copied_at", *options.pop("more", [])), ("src",), load=load, keys=("k",), since=since, **options)
    finally:
        M.MODELS = saved
    return found


def load(spark, tables, found, at, *rows, full=False):
    df = spark.createDataFrame([(*r, at) for r in rows], "k int, v string, copied_at timestamp")
    return M.run(tables, lambda name: df, at, ["int_t"], full, found)


def steps(tables):
    return sorted(os.listdir(tables.folder("int_t")))


def contents(tables, name="int_t"):
    return sorted((r.k, r.v) for r in tables.read(name).collect())


@pytest.mark.parametrize("how", ["merge", "replace", "replace_changed"])
def test_one_key_reads_and_writes_one_bucket(spark, tmp_path, how):
    tables, found = Tables(spark, str(tmp_path), bucket_bytes=1_000), models(how)
    load(spark, tables, found, T1, *[(i, "old") for i in range(500)])
    assert len(tables.parts("int_t")) >= 4
    tables.bucket_bytes = 1 << 20
    load(spark, tables, found, T2, (7, "new"))
    written = [p for p in os.listdir(f"{tables.folder('int_t')}/{steps(tables)[-1]}") if p.startswith("_part=")]
    assert len(written) == 1
    files = tables.read("int_t", [written[0].removeprefix("_part=")]).inputFiles()
    assert files and all(written[0] in f for f in files)
    assert contents(tables) == [(i, "new" if i == 7 else "old") for i in range(500)]
    before = steps(tables)
    load(spark, tables, found, T3)
    assert steps(tables) == before


def test_old_writes_are_removed_after_some(spark, tmp_path):
    tables, found = Tables(spark, str(tmp_path)), models("merge")
    load(spark, tables, found, T1, *[(i, "a") for i in range(50)])
    for n in range(6):
        load(spark, tables, found, datetime(2024, 2, 1 + n), (7, f"v{n}"), (8 + n, "b"))
        assert dict(contents(tables))[7] == f"v{n}" and len(contents(tables)) == 50
    part = spark.createDataFrame([(7,)], "k int").select(tables.bucket_of("int_t", ("k",))).first()[0]
    holding = [s for s in steps(tables) if os.path.isdir(f"{tables.folder('int_t')}/{s}/_part={part}")]
    assert len(holding) == M.KEPT_WRITES + 1


def test_buckets_are_split_alone_and_few_are_touched(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), bucket_bytes=2_500)
    rows = spark.range(70_000).selectExpr("id AS k", "uuid() AS v")
    tables.replace_buckets("t", rows, ("k",), fresh=True)
    before = {h.part: h for h in tables.live("t").held}
    assert len(before) > 1_000
    tables.bucket_bytes = 1 << 20
    batch = spark.range(200).selectExpr("id * 347 AS k", "'new' AS v")
    touched = [r[0] for r in batch.select(tables.bucket_of("t", ("k",))).distinct().collect()]
    assert len(touched) < len(before) / 4
    merged = merge.upsert(tables.read("t", touched), batch, ["k"])
    tables.replace_buckets("t", merged, ("k",), touched)
    after = {h.part: h for h in tables.live("t").held}
    assert {p for p in before | after if after.get(p) != before.get(p)} == set(touched)
    assert tables.read("t").count() == 70_000 and tables.read("t").filter("v = 'new'").count() == 200
    # one bucket grows: it alone is split, by as many bits as it needs
    name = touched[0]
    more = tables.read("t", [name]).unionByName(
        spark.range(70_000, 1_000_000).selectExpr("id AS k", "uuid() AS v").filter(tables.bucket_of("t", ("k",)) == name)
    )
    tables.bucket_bytes = 4_000
    tables.replace_buckets("t", more, ("k",), [name])
    split = {h.part: h for h in tables.live("t").held}
    children = {p for p in split if p.startswith(name)}
    assert name not in split and len(children) >= 4 and {p for p in split if split[p] != after.get(p)} == children
    assert all(split[p] == after[p] for p in after if p != name)
    assert tables.read("t").count() == tables.read("t").select("k").distinct().count() > 70_300
    # rows are where the directory says
    for one in children:
        assert tables.read("t", [one]).filter(tables.bucket_of("t", ("k",)) != one).count() == 0


def test_a_bucket_that_one_key_fills_is_not_split(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), bucket_bytes=2_000)
    rows = spark.range(20_000).selectExpr("if(id < 19000, -1, id) AS k", "uuid() AS v")
    tables.replace_buckets("t", rows, ("k",), fresh=True)
    assert tables.parts("t") == [buckets.ROOT] and tables.read("t").count() == 20_000


def test_directory_covers_every_hash(spark):
    held = ["b01", "b1101", "b111"]
    names = buckets.directory(held)
    assert names == ["b00", "b01", "b10", "b1100", "b1101", "b111"] and buckets.directory([]) == ["b"]
    found = spark.range(1000).select(buckets.bucket_of(("id",), names).alias("b"), buckets.bits(("id",)).alias("bits")).collect()
    assert {r["b"] for r in found} == set(names) and all(("b" + r["bits"]).startswith(r["b"]) for r in found)


def test_a_write_counts_with_its_list(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    tables.replace_buckets("t", df, ("k",), fresh=True)
    # files without a list: a load that was lost; the next one takes another number
    df.withColumn("v", M.F.lit("lost")).write.parquet(f"{tables.folder('t')}/p=000000002/_part=b")
    assert contents(tables, "t") == [(1, "a")]
    for n in range(6):
        tables.replace_buckets("t", df.withColumn("v", M.F.lit(str(n))), ("k",))
        tables.prune("t")
    assert contents(tables, "t") == [(1, "5")] and "p=000000002" not in os.listdir(tables.folder("t"))


def test_added_columns_and_changed_types(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.add("t", spark.createDataFrame([(1, "a")], "k int, v string"))
    tables.add("t", spark.createDataFrame([(2, 5)], "k int, n int"))
    assert sorted(map(tuple, tables.read("t").collect())) == [(1, "a", None), (2, None, 5)]
    with pytest.raises(ValueError, match="column k was int"):
        tables.add("t", spark.createDataFrame([("x",)], "k string"))


def test_a_bucket_may_become_empty(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    part = M.F.col("k").cast("string")
    tables.replace_parts("t", df, part)
    tables.replace_parts("t", df.filter("k = 3"), part, ["1"])
    assert [r.k for r in tables.read("t").collect()] == [2]


def test_full_refresh_leaves_no_stale_bucket(spark, tmp_path):
    tables, found = Tables(spark, str(tmp_path)), models("merge")
    load(spark, tables, found, T1, *[(i, "a") for i in range(100)])
    load(spark, tables, found, T2, (1, "b"), full=True)
    assert contents(tables) == [(1, "b")]


def test_history_is_not_rebuilt(spark, tmp_path):
    tables, found = Tables(spark, str(tmp_path)), models("merge", history=True)
    load(spark, tables, found, T1, (1, "a"))
    load(spark, tables, found, T2, (2, "b"), full=True)
    assert contents(tables) == [(1, "a"), (2, "b")]
    with pytest.raises(ProtectedHistory):
        M.refresh(found["int_t"], tables, lambda name: spark.createDataFrame([(1, "a", T3)], "k int, v string, copied_at timestamp"), M.F.lit(T3), full=True)


def test_flagged_rows_of_a_parent_share_its_bucket(spark, tmp_path):
    found = {}
    saved, M.MODELS = M.MODELS, found
    try:
        M.add("int_t", lambda src: src.select("p", "k", M.F.lit(False).alias("poistettu"), "copied_at"), ("src",), load="merge", keys=("p", "k"), parent=("p",), since=M.Since("copied_at"))
    finally:
        M.MODELS = saved
    tables = Tables(spark, str(tmp_path))
    for at, rows in ((T1, [(1, 1), (1, 2), (2, 1)]), (T2, [(1, 2)])):
        df = spark.createDataFrame([(*r, at) for r in rows], "p long, k int, copied_at timestamp")
        M.run(tables, lambda name: df, at, ["int_t"], False, found)
    assert sorted((r.p, r.k, r.poistettu) for r in tables.read("int_t").collect()) == [(1, 1, True), (1, 2, False), (2, 1, False)]
