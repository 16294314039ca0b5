"""Merge, history and watermark queries: two or more loads, final state."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators import history, latest, merge, runlog
from lakemart.plans import housekeeping
from lakemart.plans.catalog import raw_defaults, run, sources_from
from lakemart.queries import admission_documents
from lakemart.queries.registry import Source, query
from lakemart.session import stored, work_path
from lakemart.sinks.versions import Tables

EPOCH = "1899-12-31"


def orders_between(t: Source, start: str | None, end: str | None) -> DataFrame:
    day = F.col("o_orderdate")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate")
    if start:
        orders = orders.filter(day >= start)
    return orders.filter(day < end) if end else orders


def doubled(orders: DataFrame) -> DataFrame:
    """The same orders delivered again with other prices."""
    return orders.withColumn("o_totalprice", F.col("o_totalprice") * 2).withColumn("o_orderpriority", F.lit("again"))


@query(
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN 'again' ELSE o_orderpriority END AS o_orderpriority
    FROM orders
    """
)
def merge_upsert(t: Source) -> DataFrame:
    target = orders_between(t, None, "1999-01-01")
    batch = doubled(orders_between(t, "1997-01-01", None))
    return merge.upsert(target, batch, ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query(
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'again' ELSE o_orderpriority END AS o_orderpriority
    FROM orders
    """
)
def merge_excluded_columns(t: Source) -> DataFrame:
    target = orders_between(t, None, "1999-01-01")
    batch = doubled(orders_between(t, "1997-01-01", None))
    return merge.upsert(target, batch, ["o_orderkey"], keep=["o_orderpriority"]).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )


@query(
    """
    WITH again AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R')
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS quantity, 'old' AS load
    FROM lineitem WHERE l_orderkey NOT IN (SELECT k FROM again)
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) * 10, 'new' FROM lineitem WHERE l_returnflag = 'R'
    """
)
def delete_insert(t: Source) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("bigint").alias("quantity"), "l_returnflag"
    )
    batch = lines.filter(F.col("l_returnflag") == "R").withColumns(
        {"quantity": F.col("quantity") * 10, "load": F.lit("new")}
    )
    return merge.replace_keys(lines.withColumn("load", F.lit("old")), batch, ["l_orderkey"]).drop("l_returnflag")


@query(
    """
    WITH changed AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal < 2000)
    SELECT o_orderkey, o_custkey, 'old' AS load FROM orders WHERE o_custkey NOT IN (SELECT k FROM changed)
    UNION ALL
    SELECT o_orderkey, o_custkey, 'new' FROM orders WHERE o_custkey IN (SELECT k FROM changed) AND o_orderstatus = 'F'
    """
)
def replace_changed_keys(t: Source) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    changed = t.customer.filter("c_acctbal < 2000").select(F.col("c_custkey").alias("o_custkey"))
    fresh = orders.filter(F.col("o_orderstatus") == "F").join(changed, ["o_custkey"], "left_semi")
    kept = merge.replace_changed(
        orders.withColumn("load", F.lit("old")), changed, fresh.withColumn("load", F.lit("new")), ["o_custkey"]
    )
    return kept.select("o_orderkey", "o_custkey", "load")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'F')
    """
)
def purge_inactive(t: Source) -> DataFrame:
    inactive = t.orders.filter(F.col("o_orderstatus") != "F").select(F.col("o_orderkey").alias("l_orderkey"))
    return merge.purge(t.lineitem, inactive, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    """
    WITH pairs AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
    batch AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01')
    SELECT p.l_orderkey, p.l_partkey,
           p.l_orderkey IN (SELECT l_orderkey FROM batch) AND b.l_partkey IS NULL AS poistettu
    FROM pairs p LEFT JOIN batch b ON b.l_orderkey = p.l_orderkey AND b.l_partkey = p.l_partkey
    """
)
def soft_delete(t: Source) -> DataFrame:
    """Choices of re-delivered orders are flagged unless delivered again."""
    alive = F.lit(False).alias("poistettu")
    stored = t.lineitem.select("l_orderkey", "l_partkey", alive).distinct()
    batch = t.lineitem.filter(F.col("l_shipdate") >= "2000-01-01").select("l_orderkey", "l_partkey", alive).distinct()
    return merge.mark_deleted(stored, batch, ["l_orderkey"], ["l_orderkey", "l_partkey"])


@query(
    """
    SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer WHERE c_acctbal < 5000
    UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal >= 5000
    """
)
def schema_append(t: Source) -> DataFrame:
    old = t.customer.filter("c_acctbal < 5000").select("c_custkey", "c_name")
    new = t.customer.filter("c_acctbal >= 5000").select("c_custkey", "c_name", "c_mktsegment")
    return merge.append(old, new)


def staged(orders: DataFrame, copied: str, file: str) -> DataFrame:
    """Orders as delivered at one time by one file."""
    when = F.lit(copied).cast("timestamp")
    return orders.select(
        F.col("o_orderkey").alias("oid"),
        F.col("o_orderdate").alias("muokattu"),
        F.col("o_orderstatus").alias("tila"),
        F.col("o_orderpriority").alias("priority"),
        when.alias("dw_metadata_source_timestamp_at"),
        when.alias("dw_metadata_dbt_copied_at"),
        F.lit(file).alias("dw_metadata_filename"),
        F.col("o_orderkey").cast("int").alias("dw_metadata_file_row_number"),
    )


def stamp(text: str):
    return F.lit(text).cast("timestamp")


@query(
    """
    SELECT o_orderkey AS oid, CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN 'again' ELSE o_orderpriority END AS priority,
           CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'second' ELSE 'first' END AS first_file
    FROM orders
    """
)
def history_merge(t: Source) -> DataFrame:
    """Two loads; the first also holds every row twice, delivered by two
    files.  Metadata of the first delivery stays."""
    first = orders_between(t, None, "1999-01-01")
    earlier = staged(first.withColumn("o_orderpriority", F.lit("stale")), "2024-01-01", "stale")
    load = earlier.unionByName(staged(first, "2024-01-02", "first"))
    table = history.merge_history(None, load, ["oid", "muokattu"], stamp("2024-01-02"))
    second = staged(doubled(orders_between(t, "1997-01-01", None)), "2024-01-03", "second")
    table = history.merge_history(table, second, ["oid", "muokattu"], stamp("2024-01-03"))
    return table.select("oid", "priority", F.col("dw_metadata_filename").alias("first_file"))


def hashed_history(t: Source) -> DataFrame:
    """Three loads: all orders; the same again; some with another priority.
    The table is stored after each load."""
    everything = orders_between(t, None, None)
    changed = doubled(orders_between(t, "2000-01-01", None))
    table = None
    for batch, day, file in (
        (everything, "2024-01-01", "one"), (everything, "2024-01-02", "two"), (changed, "2024-01-03", "three")
    ):
        table = stored(history.append_changes(table, staged(batch, day, file), ["oid"], stamp(day)), "hashed")
    return table


@query(
    """
    SELECT o_orderkey AS oid, o_orderpriority AS priority, 'one' AS file FROM orders
    UNION ALL SELECT o_orderkey, 'again', 'three' FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'
    """
)
def hash_change_capture(t: Source) -> DataFrame:
    return hashed_history(t).select("oid", "priority", F.col("dw_metadata_filename").alias("file"))


@query(
    """
    SELECT o_orderkey AS oid, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'again' ELSE o_orderpriority END AS priority
    FROM orders
    """
)
def current_view(t: Source) -> DataFrame:
    return history.current_rows(hashed_history(t)).select("oid", "priority")


@query(
    """
    SELECT 'after' AS kind, event_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-20')
    UNION ALL
    SELECT 'from', event_id FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-20')
    UNION ALL
    SELECT 'margin', event_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-20') - INTERVAL 7 DAY
    """
)
def watermark_overlap(t: Source) -> DataFrame:
    events = t.events
    stored = events.filter((F.col("event_type") == "error") & (F.col("ts") < "2024-01-20"))
    mark = merge.high_water_mark(stored, "ts", EPOCH)
    kinds = {
        "after": merge.above(events, "ts", mark),
        "from": merge.above(events, "ts", mark, inclusive=True),
        "margin": merge.above(events, "ts", mark, overlap=F.expr("INTERVAL 7 DAYS")),
    }
    first, *rest = [df.select(F.lit(kind).alias("kind"), "event_id") for kind, df in kinds.items()]
    for frame in rest:
        first = first.unionByName(frame)
    return first


@query(
    """
    SELECT user_id, event_id, event_type
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
    WHERE n = 1
    """
)
def late_data_never_wins(t: Source) -> DataFrame:
    """Newest event per user after loads in the wrong order: newer days first."""
    events = t.events
    loads = [
        events.filter(F.col("ts") >= "2024-01-20"),
        events.filter(F.col("ts") < "2024-01-10"),
        events.filter((F.col("ts") >= "2024-01-10") & (F.col("ts") < "2024-01-20")),
    ]
    state = latest.newest_per_key(loads[0], ["user_id"], "ts", "event_id")
    for load in loads[1:]:
        batch = latest.newest_per_key(load, ["user_id"], "ts", "event_id")
        state = merge.upsert(state, merge.only_newer(batch, state, ["user_id"], "ts"), ["user_id"])
    return state.select("user_id", "event_id", "event_type")


@query(
    """
    SELECT 'stg_orders' AS model, 'orders' AS raw_table, max(o_orderdate) AS start_time, false AS execute FROM orders
    UNION ALL SELECT 'stg_events', 'events', max(ts), false FROM events
    """
)
def run_log(t: Source) -> DataFrame:
    """Each load is noted twice; the log keeps the later start."""
    runs, completed = runlog.empty_runs(t.spark), runlog.empty_completed(t.spark)
    for model, df, time in (("stg_orders", t.orders, "o_orderdate"), ("stg_events", t.events, "ts")):
        newest = df.agg(F.max(time).cast("timestamp").alias("m")).first()["m"]
        for begun in ("1990-01-01 00:00:00", newest):
            runs = stored(runlog.start(runs, [model], F.lit(begun).cast("timestamp")), "runs")
            completed = stored(runlog.complete(completed, runs, [model]), "completed")
    return completed.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@query(
    """
    SELECT 'kept whole' AS kind, count(*) AS rows FROM events
    UNION ALL SELECT 'cleaned', count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-15'
    """
)
def retention(t: Source) -> DataFrame:
    events = t.events
    runs = runlog.start(runlog.empty_runs(t.spark), ["stg_events"], stamp("2024-01-15"))
    completed = runlog.complete(runlog.empty_completed(t.spark), runs, ["stg_events"])
    released = completed.withColumn("execute", F.lit(True))
    count = F.count(F.lit(1)).alias("rows")
    return (
        runlog.retain(events, completed, "events", "ts").agg(F.lit("kept whole").alias("kind"), count)
        .unionByName(runlog.retain(events, released, "events", "ts").agg(F.lit("cleaned").alias("kind"), count))
    )


@query(
    """
    SELECT event_id, event_type FROM events LEFT JOIN
        (SELECT event_type, max(ts) AS begun FROM events WHERE user_id % 3 = 0 AND event_type <> 'view' GROUP BY 1) USING (event_type)
    WHERE begun IS NULL OR ts > begun
    """
)
def load_since_watermark(t: Source) -> DataFrame:
    """What each table's next load reads: rows past the start of its last
    completed load, all rows of a table that was never loaded."""
    events = t.events
    begun = events.filter("user_id % 3 = 0 AND event_type <> 'view'").groupBy("event_type").agg(F.max("ts").alias("m"))
    kinds = {r.event_type: None for r in events.select("event_type").distinct().collect()}
    kinds |= {r.event_type: r.m for r in begun.withColumn("m", F.col("m").cast("timestamp")).collect()}
    runs, completed = runlog.empty_runs(t.spark), runlog.empty_completed(t.spark)
    for kind, at in kinds.items():
        if at is not None:
            runs = runlog.start(runs, [f"stg_{kind}"], F.lit(at).cast("timestamp"))
    completed = stored(runlog.complete(completed, runs, [f"stg_{k}" for k, at in kinds.items() if at is not None]), "completed")
    beginning = datetime(1899, 12, 31)
    loads = [
        merge.above(events.filter(F.col("event_type") == kind), "ts", runlog.watermark(completed, kind, beginning)) for kind in sorted(kinds)
    ]
    return reduce(DataFrame.unionByName, loads).select("event_id", "event_type")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE (l_partkey, l_suppkey) IN (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag <> 'N')
    """
)
def orphan_removal(t: Source) -> DataFrame:
    """Results stay whose queue (supplier) the criteria of the target (part) list."""
    queue = F.struct(F.col("l_suppkey").cast("string").alias("oid"))
    listed = t.lineitem.filter("l_returnflag <> 'N'").groupBy("l_partkey").agg(F.collect_set(queue).alias("valintatapajono"))
    phases = F.to_json(F.array(F.struct("valintatapajono")))
    criteria = listed.select(F.col("l_partkey").alias("hakukohde_oid"), phases.alias("valinnanvaiheet"))
    results = t.lineitem.withColumns({"hakukohde_oid": F.col("l_partkey"), "valintatapajono_oid": F.col("l_suppkey").cast("string")})
    return housekeeping.without_orphans(results, criteria).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    """
    SELECT 'stg_ataru_hakemus' AS model, count(*) AS rows FROM orders
    UNION ALL SELECT 'int_ataru_hakemus', count(*) FROM orders UNION ALL SELECT 'stg_ataru_lomake', 0 UNION ALL SELECT 'int_sijoitteluajo', 0
    """
)
def bootstrap_sources(t: Source) -> DataFrame:
    """A first run where only one source has files: the others are empty tables."""
    tables = Tables(t.spark, work_path(t.spark, "bootstrap"))
    names = ["stg_ataru_hakemus", "int_ataru_hakemus", "stg_ataru_lomake", "int_sijoitteluajo"]
    given = {"ataru_hakemus": admission_documents.applications(t)}  # read once, by the stage table
    run(tables, sources_from(t.spark, given, raw_defaults), datetime(2024, 1, 2, 12), names)
    counts = [tables.read(n).agg(F.lit(n).alias("model"), F.count(F.lit(1)).alias("rows")) for n in names]
    return reduce(DataFrame.unionByName, counts)
