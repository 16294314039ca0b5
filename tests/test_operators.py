import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.session import stored
from lakemart.operators import aggregates, hierarchy, history, joins, latest, merge, quality, runlog

DAY = datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().toString()


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_null_time_wins_newest(rows):
    df = rows([(1, None, "n"), (1, DAY, "d"), (2, DAY, "d"), (2, DAY + timedelta(1), "e")], "k int, t timestamp, v string")
    assert values(latest.newest_per_key(df, ["k"], "t"), "k", "v") == [(1, "n"), (2, "e")]


def test_newest_with_ties_keeps_equal_and_undated_rows(rows):
    df = rows(
        [(1, DAY, "a"), (1, DAY, "b"), (1, DAY - timedelta(1), "c"), (1, None, "d"), (None, DAY, "e"), (None, DAY - timedelta(1), "f")],
        "k int, t timestamp, v string",
    )
    assert [v for (v,) in values(latest.newest_with_ties(df, ["k"], "t"), "v")] == ["a", "b", "d", "e", "f"]


def test_hot_key_is_cut_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    physical = plan(latest.newest_per_key(df, ["k"], "t")).split("Physical Plan")[-1]
    exchange = physical.index("Exchange hashpartitioning")
    assert "row_number(), 1, Final" in physical[:exchange] and "row_number(), 1, Partial" in physical[exchange:]


def test_maximum_flag(rows):
    df = rows([(1, 5, "a"), (1, 5, "b"), (1, 3, "c"), (2, None, "d"), (None, 1, "e")], "k int, x int, v string")
    flagged = latest.with_maximum_flag(df, ["k"], "x", "top")
    assert values(flagged, "v", "top") == [("a", True), ("b", True), ("c", False), ("d", None), ("e", True)]
    assert values(latest.rows_at_maximum(df, ["k"], "x"), "v") == [("a",), ("b",), ("e",)]


def test_upsert_is_idempotent_and_keeps_first_seen(rows):
    target = rows([(1, "a", "old"), (2, "b", "old"), (None, "n", "old")], "k int, v string, seen string")
    batch = rows([(2, "B", "new"), (3, "C", "new"), (None, "N", "new")], "k int, v string, seen string")
    once = merge.upsert(target, batch, ["k"], keep=["seen"])
    expected = [(1, "a", "old"), (2, "B", "old"), (3, "C", "new"), (None, "N", "new"), (None, "n", "old")]
    assert values(once, "k", "v", "seen") == sorted(expected, key=repr)
    known = batch.filter("k IS NOT NULL")
    again = merge.upsert(merge.upsert(target, known, ["k"], ["seen"]), known, ["k"], ["seen"])
    assert values(again, "k", "v") == values(merge.upsert(target, known, ["k"], ["seen"]), "k", "v")


def test_upsert_does_not_shuffle_the_target_for_a_small_batch(spark):
    target = spark.range(100000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    batch = stored(spark.createDataFrame([(1, "y")], "k long, v string"), "batch")
    physical = plan(merge.upsert(target, batch, ["k"], keep=["v"])).split("Physical Plan")[-1]
    assert "BroadcastHashJoin" in physical
    assert "SortMergeJoin" not in physical
    # the keys of the batch are counted, nothing else is shuffled
    assert physical.count("Exchange hashpartitioning") == 1 and "partial_count" in physical


def test_a_batch_with_a_key_twice_is_refused(rows):
    target = rows([(1, "old")], "k int, v string")
    with pytest.raises(Exception, match="repeated key in a merge on k: 1"):
        merge.upsert(target, rows([(1, "x"), (1, "y")], "k int, v string"), ["k"]).collect()
    unkeyed = merge.upsert(target, rows([(None, "x"), (None, "y"), (1, "new")], "k int, v string"), ["k"])
    assert sorted(map(tuple, unkeyed.collect()), key=repr) == [(1, "new"), (None, "x"), (None, "y")]


def test_all_checks_of_a_table_in_one_pass(rows):
    df = rows([(1, "a", None), (1, "b", "x"), (2, None, "x"), (None, "c", "x"), (None, "c", None)], "k int, r string, s string")
    got = dict(map(tuple, quality.keyed_report(df, ["k"], ["r", "s"]).collect()))
    assert got == {"unique": 1, "k present": 2, "r present": 1, "s present": 2}
    apart = {"unique": quality.repeated(df, ["k"]), "k present": quality.missing(df, "k"), "r present": quality.missing(df, "r"), "s present": quality.missing(df, "s")}
    assert got == dict(map(tuple, quality.report(apart).collect()))
    assert dict(map(tuple, quality.keyed_report(df.limit(0), ["k", "r"], ["s"]).collect())) == {"unique": 0, "k present": 0, "r present": 0, "s present": 0}
    assert dict(map(tuple, quality.keyed_report(df, [], ["s"]).collect())) == {"s present": 2}
    assert quality.keyed_report(df, ["k"], ["r"])._jdf.queryExecution().toString().count("LogicalRDD") <= 4


def test_upsert_adds_new_columns(rows):
    got = merge.upsert(rows([(1, "a")], "k int, v string"), rows([(2, "b", 5)], "k int, v string, w int"), ["k"])
    assert values(got, "k", "v", "w") == [(1, "a", None), (2, "b", 5)]


def test_delete_insert_keeps_repeated_keys(rows):
    target = rows([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    batch = rows([(1, "x"), (1, "y")], "k int, v string")
    assert values(merge.replace_keys(target, batch, ["k"]), "k", "v") == [(1, "x"), (1, "y"), (2, "c")]


def test_changed_key_without_rows_disappears(rows):
    target = rows([(1, "a"), (2, "c")], "k int, v string")
    changed, batch = rows([(1,)], "k int"), rows([], "k int, v string")
    assert values(merge.replace_changed(target, changed, batch, ["k"]), "k", "v") == [(2, "c")]


def test_soft_delete(rows):
    schema = "p int, k int, poistettu boolean"
    target = rows([(1, 10, False), (1, 11, False), (2, 20, False)], schema)
    got = merge.mark_deleted(target, rows([(1, 11, False), (1, 12, False)], schema), ["p"], ["p", "k"])
    assert values(got, "k", "poistettu") == [(10, True), (11, False), (12, False), (20, False)]


def test_watermark_forms(rows):
    df = rows([(DAY,), (DAY + timedelta(1),), (None,)], "t timestamp")
    assert merge.above(df, "t", DAY).count() == 1
    assert merge.above(df, "t", DAY, inclusive=True).count() == 2
    assert merge.above(df, "t", DAY, inclusive=True, or_null=True).count() == 3
    assert merge.above(df, "t", DAY, overlap=F.expr("INTERVAL 1 DAY")).count() == 2
    assert merge.high_water_mark(df.filter("t IS NULL"), "t", DAY) == DAY
    assert merge.high_water_mark(None, "t", DAY) == DAY


@pytest.mark.parametrize("right", [[1, 2], [1, None], [], [None]])
def test_not_in_has_sql_null_rules(spark, rows, right):
    left = rows([(1,), (3,), (None,)], "a int")
    other = rows([(x,) for x in right], "b int")
    left.createOrReplaceTempView("l_side"), other.createOrReplaceTempView("r_side")
    want = spark.sql("SELECT a FROM l_side WHERE a NOT IN (SELECT b FROM r_side)")
    assert values(joins.not_in(left, "a", other, "b"), "a") == values(want, "a")


def test_either_equal_counts_each_pair_once(rows):
    left = rows([(1, 1), (1, 2), (None, 2)], "a int, b int")
    right = rows([(1, 2), (1, 1)], "c int, d int")
    got = joins.either_equal(left, right, ("a", "c"), ("b", "d"))
    want = left.join(right, (F.col("a") == F.col("c")) | (F.col("b") == F.col("d")))
    assert values(got, "a", "b", "c", "d") == values(want, "a", "b", "c", "d")


def test_object_per_key_last_name_wins(rows):
    df = rows([(1, "b", "x", 1), (1, "a", "y", 1), (1, "b", "z", 2)], "k int, n string, v string, o int")
    assert values(aggregates.object_per_key(df, ["k"], "n", "v", "o", "j"), "j") == [('{"a":"y","b":"z"}',)]


def stage(rows, data, copied):
    return rows(
        [(k, DAY + timedelta(m), v, None, copied, f, 1) for k, m, v, f in data],
        "id int, muokattu timestamp, v string, dw_metadata_source_timestamp_at timestamp, dw_metadata_dbt_copied_at timestamp, "
        "dw_metadata_filename string, dw_metadata_file_row_number int",
    )


def test_history_same_batch_twice_equals_once(rows):
    now = F.lit("2024-02-01").cast("timestamp")
    batch = stage(rows, [(1, 0, "a", "f1"), (1, 0, "b", "f2"), (1, 1, "c", "f1")], DAY)
    once = history.merge_history(None, batch, ["id", "muokattu"], now)
    twice = history.merge_history(once, batch, ["id", "muokattu"], now)
    assert values(once, "id", "muokattu", "v") == values(twice, "id", "muokattu", "v")
    assert [v for (v,) in values(once, "v")] == ["b", "c"]


def test_current_state_does_not_depend_on_batch_order(rows):
    now = F.lit("2024-02-01").cast("timestamp")
    batches = [
        stage(rows, [(k, m, f"{k}.{m}", "f") for k in range(5)], DAY + timedelta(m)) for m in range(4)
    ]
    results = []
    for seed in range(3):
        order = batches[:]
        random.Random(seed).shuffle(order)
        table = None
        for batch in order:
            table = history.merge_history(table, batch, ["id", "muokattu"], now)
        results.append(values(latest.newest_per_key(table, ["id"], "muokattu"), "id", "v"))
    assert results[0] == results[1] == results[2]


def test_change_capture_ignores_known_content(rows):
    now = F.lit("2024-02-01").cast("timestamp")
    first = history.append_changes(None, stage(rows, [(1, 0, "a", "f1")], DAY), ["id"], now)
    same = history.append_changes(first, stage(rows, [(1, 0, "a", "f2")], DAY + timedelta(1)), ["id"], now)
    assert same.count() == 1
    changed = history.append_changes(same, stage(rows, [(1, 0, "b", "f3")], DAY + timedelta(2)), ["id"], now)
    back = history.append_changes(changed, stage(rows, [(1, 0, "a", "f4")], DAY + timedelta(3)), ["id"], now)
    assert back.count() == 2
    assert values(history.current_rows(back), "v") == [("b",)]


def test_closure_against_brute_force(spark):
    rng = random.Random(7)
    parents = {i: (rng.randrange(i) if i and rng.random() > 0.1 else None) for i in range(60)}
    want = set()
    for node in parents:
        above, distance = parents[node], 1
        while above is not None:
            want.add((above, node, distance))
            above, distance = parents[above], distance + 1
    df = spark.createDataFrame(list(parents.items()), "c int, p int")
    got = hierarchy.closure(df, "c", "p")
    assert set(values(got, "ancestor", "descendant", "distance")) == want


@pytest.mark.parametrize("length", [1, 2, 3, 7])
def test_cycle_is_refused(rows, length):
    df = rows([(i, (i + 1) % length + 100 * (length == 1)) for i in range(length)] + [(50, 0)], "c int, p int")
    if length == 1:
        assert hierarchy.closure(df, "c", "p").count() == 3
    else:
        with pytest.raises(hierarchy.HierarchyCycle):
            hierarchy.closure(df, "c", "p")


def test_long_chain_closes(rows):
    df = rows([(i, i + 1) for i in range(70)], "c int, p int")
    assert hierarchy.closure(df, "c", "p").count() == 70 * 71 // 2


def test_last_of_peers_with_nulls(rows):
    df = rows([("k", None, "h1", 1), (None, 1, "h3", 1), ("k", 1, "a", 2), ("k", 1, "b", 1), ("k", 2, None, 1)], "k string, o int, v string, t int")
    got = latest.last_of_peers(df, ["k"], "o", "v", "last", "t")
    assert values(got, "k", "o", "last") == values(
        rows([("k", None, "h1"), (None, 1, "h3"), ("k", 1, "a"), ("k", 1, "a"), ("k", 2, None)], "k string, o int, last string"), "k", "o", "last"
    )


def test_planted_violations_are_found(rows):
    df = rows([(1, "a"), (1, "b"), (None, "c"), (2, None)], "k int, v string")
    report = quality.report(
        {
            "unique": quality.repeated(df, ["k"]),
            "present": quality.missing(df, "v"),
            "known": quality.orphans(df, "k", rows([(1,)], "id int"), "id"),
        }
    )
    assert values(report, "check", "violations") == [("known", 1), ("present", 1), ("unique", 1)]
    assert values(quality.primary_key_violations(df, ["k"]), "check", "violations") == [("not_null", 1), ("unique", 1)]


def test_contract(rows):
    df = rows([(1, "a")], "k int, v string")
    assert quality.assert_contract(df, T.StructType.fromDDL("v string, k int")).columns == ["v", "k"]
    with pytest.raises(quality.ContractBroken):
        quality.assert_contract(df, T.StructType.fromDDL("k bigint, v string"))


def test_run_log_and_retention(spark, rows):
    runs, done = runlog.empty_runs(spark), runlog.empty_completed(spark)
    for day in ("2024-01-01", "2024-01-03"):
        runs = runlog.start(runs, ["stg_orders"], F.lit(day).cast("timestamp"))
        done = runlog.complete(done, runs, ["stg_orders"])
    assert values(done, "model", "raw_table", "execute") == [("stg_orders", "orders", False)]
    assert runlog.watermark(done, "orders", None) == datetime(2024, 1, 3)
    raw = rows([(DAY,), (DAY + timedelta(3),), (None,)], "dw_metadata_dbt_copied_at timestamp")
    assert runlog.retain(raw, done, "orders").count() == 3
    assert runlog.retain(raw, done.withColumn("execute", F.lit(True)), "orders").count() == 2
