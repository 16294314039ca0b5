"""Closures, bitmaps, filters and stream state that are kept up to date in part."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakemart.operators import aggregates, hierarchy
from lakemart.operators.known import Known, filter_of, maybe_known
from lakemart.sinks.versions import Tables
from lakemart.streaming.newest import newer_versions


def edges(rows, tree):
    return rows(sorted(tree.items()), "k int, p int")


def pairs(tree):
    out = set()
    for k in tree:
        at, n = tree[k], 1
        while at is not None and n < 500:
            out.add((at, k, n))
            at, n = tree.get(at), n + 1
    return out


def test_moved_subtrees_give_the_closure_of_the_new_tree(rows):
    rng = random.Random(2)
    tree = {k: None if k < 3 else rng.randrange(k) for k in range(120)}
    stored = hierarchy.closure(edges(rows, tree), "k", "p")
    assert {tuple(r) for r in stored.collect()} == pairs(tree)
    new = dict(tree)
    # a subtree below its own nephew, one that becomes a root, a chain of moves, a new leaf and a new node in between
    new[50], new[7], new[90] = 4, None, 50
    new[200], new[201] = 90, None
    new[60] = 201
    changed = [k for k in new if new.get(k) != tree.get(k, "none")]
    affected, added = hierarchy.moved(stored, edges(rows, new), "k", "p", rows([(k,) for k in changed], "k int"))
    moved = {r[0] for r in affected.collect()}
    after = {tuple(r) for r in stored.collect() if r.descendant not in moved} | {tuple(r) for r in added.select("ancestor", "descendant", "distance").collect()}
    assert after == pairs(new) and {r.descendant for r in added.collect()} <= moved
    assert len(moved) < 120


def test_moving_one_leaf_writes_its_pairs_only(rows):
    tree = {k: None if k == 0 else (k - 1) // 2 for k in range(255)}
    stored = hierarchy.closure(edges(rows, tree), "k", "p")
    affected, added = hierarchy.moved(stored, edges(rows, tree | {254: 3}), "k", "p", rows([(254,)], "k int"))
    assert [r[0] for r in affected.collect()] == [254]
    assert sorted(map(tuple, added.select("ancestor", "descendant", "distance").collect())) == [(0, 254, 3), (1, 254, 2), (3, 254, 1)]


def test_a_move_that_makes_a_cycle_is_refused(rows):
    tree = {0: None, 1: 0, 2: 1, 3: 2}
    stored = hierarchy.closure(edges(rows, tree), "k", "p")
    with pytest.raises(hierarchy.HierarchyCycle):
        hierarchy.moved(stored, edges(rows, tree | {1: 3}), "k", "p", rows([(1,)], "k int"))


def test_removed_nodes_lose_their_pairs(rows):
    tree = {0: None, 1: 0, 2: 1, 3: 2}
    stored = hierarchy.closure(edges(rows, tree), "k", "p")
    affected, added = hierarchy.moved(stored, edges(rows, {0: None, 1: 0, 3: 1}), "k", "p", rows([(2,), (3,)], "k int"))
    assert sorted(r[0] for r in affected.collect()) == [2, 3]
    assert sorted(map(tuple, added.select("ancestor", "descendant", "distance").collect())) == [(0, 3, 2), (1, 3, 1)]


def test_dense_numbers_have_no_gaps(spark):
    df = spark.range(0, 50_000, 7, 9).selectExpr("id * 1000003 AS v").unionAll(spark.range(100).selectExpr("CAST(NULL AS BIGINT) AS v"))
    got = aggregates.dense_numbers(df.unionAll(df), "v", "n").collect()
    assert sorted(r.n for r in got) == list(range(len(range(0, 50_000, 7)))) and len({r.v for r in got}) == len(got)


def test_bitmaps_count_and_roll_up_exactly(spark):
    df = spark.range(0, 200_000).selectExpr("id % 70000 AS n", "CAST(id % 5 AS STRING) AS a", "CAST(id % 3 AS STRING) AS b")
    df = df.unionAll(spark.sql("SELECT CAST(NULL AS BIGINT), '0', 'x'"))
    fine = aggregates.bitmaps(df, ["a", "b"], "n")
    want = {(r.a, r.b): r.c for r in df.filter("n IS NOT NULL").groupBy("a", "b").agg(F.count_distinct("n").alias("c")).collect()}
    assert {(r.a, r.b): r.c for r in aggregates.counted(fine, ["a", "b"], "c").collect()} == want
    up = aggregates.rolled_up(fine, ["a"])
    assert {r.a: r.c for r in aggregates.counted(up, ["a"], "c").collect()} == {r.a: r.c for r in df.groupBy("a").agg(F.count_distinct("n").alias("c")).collect()}
    assert aggregates.counted(aggregates.rolled_up(up, []), [], "c").first().c == 70_000
    assert aggregates.counted(fine.limit(0), [], "c").first().c == 0


def test_filters_know_all_that_is_known_and_little_else(spark):
    held = spark.range(20_000).selectExpr("md5(CAST(id AS STRING)) AS h")
    filters = filter_of(held, "h").withColumn("write", F.lit(1))
    other = spark.range(1_000_000, 1_020_000).selectExpr("md5(CAST(id AS STRING)) AS h")
    assert maybe_known(held, "h", filters).count() == 20_000
    assert maybe_known(other, "h", filters).count() < 200
    assert maybe_known(held, "h", filters.limit(0)).count() == 0


def test_a_hash_asks_one_row_of_a_filter(spark):
    """Rows go through the shuffles once for each hash and size of filter, not once for each bit."""
    held = spark.range(3_000).selectExpr("md5(CAST(id AS STRING)) AS h")
    filters = filter_of(held, "h").withColumn("write", F.lit(1)).unionByName(filter_of(held.limit(100), "h").withColumn("write", F.lit(2)))
    found = maybe_known(held, "h", filters)
    assert sorted(r.h for r in found.collect()) == sorted(r.h for r in held.collect())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("Aggregate [h") == 1


def test_a_load_of_new_rows_reads_filters_only(spark, tmp_path):
    known = Known(Tables(spark, str(tmp_path)), "t", "h")
    load = lambda a, b: spark.range(a, b).selectExpr("id", "md5(CAST(id AS STRING)) AS h")
    known.add(load(0, 300))
    reads = []
    read = known.tables.read
    known.tables.read = lambda name, parts=None: (reads.append(name), read(name, parts))[1]
    fresh, looked = known.fresh(load(10_000, 10_050))
    assert (fresh.count(), looked, reads) == (50, 0, ["t_filter"])
    known.add(fresh)
    fresh, looked = known.fresh(load(290, 310).unionAll(load(10_049, 10_052)))
    assert looked >= 11 and sorted(r.id for r in fresh.collect()) == [*range(300, 310), 10_050, 10_051]
    # a filter whose rows were never written makes nothing known
    known.tables.add("t_filter", filter_of(load(500, 510), "h").withColumn("write", F.lit(99).cast("long")))
    assert known.fresh(load(500, 510))[0].count() == 10


def test_late_and_repeated_rows_leave_the_stream(spark, tmp_path):
    start = datetime(2024, 1, 1)
    batches = [
        [("a", 5, "x"), ("a", 3, "w"), ("b", 1, "p"), (None, 1, "n")], [("a", 4, "late"), ("b", 1, "p")], [("a", 6, "y"), ("c", None, "q")],
        [("a", 6, "y"), ("a", 5, "x"), ("c", 0, "r"), ("c", None, "q")],
    ]
    schema = "k string, at timestamp, v string"
    for n, rows in enumerate(batches):
        made = [(k, None if t is None else start + timedelta(hours=t), v) for k, t, v in rows]
        spark.createDataFrame(made, schema).coalesce(1).write.parquet(str(tmp_path / "in" / str(n)))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(tmp_path / "in"))
    seen = []
    query = newer_versions(stream, "k", "at").writeStream.foreachBatch(lambda df, n: seen.append(sorted((r.k, r.v) for r in df.collect())))
    query.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert [s for s in seen if s] == [[("a", "x"), ("b", "p")], [("a", "y"), ("c", "q")], [("c", "r")]]
