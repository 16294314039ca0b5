"""Loads that touch little: growing buckets, pushed changes, any array layout, VARIANT."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators import aggregates, hierarchy, latest, merge
from lakemart.operators.known import Known
from lakemart.plans.catalog import raw_defaults, run
from lakemart.queries import admission_documents as documents
from lakemart.queries.admissions import CHOICES
from lakemart.queries.arrivals import DOCUMENTS_PER_FILE, LANDED_SQL, landed_columns, now, order_documents
from lakemart.queries.joining import supplier_tree
from lakemart.queries.registry import Source, query
from lakemart.session import stored, work_path
from lakemart.sinks.versions import Tables
from lakemart.sources import arrays, variants
from lakemart.sources.shred import Shape, fields
from lakemart.streaming.newest import newer_versions


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 211 = 7 THEN 'again' ELSE o_orderpriority END AS o_orderpriority,
           true AS few_touched, true AS others_kept FROM orders
    """
)
def merge_few_buckets(t: Source) -> DataFrame:
    """A small batch merged into a table of growing buckets: it touches a part of
    them, and all others keep their files."""
    limit = 1 << 12
    tables = Tables(t.spark, work_path(t.spark, "buckets"), bucket_bytes=limit)
    tables.replace_buckets("orders", t.orders.select("o_orderkey", "o_orderpriority"), ("o_orderkey",), fresh=True)
    before = {h.part: h for h in tables.live("orders").held}
    batch = t.orders.filter("o_orderkey % 211 = 7").select("o_orderkey", F.lit("again").alias("o_orderpriority"))
    batch = stored(batch, "batch")
    touched = [r[0] for r in batch.select(tables.bucket_of("orders", ("o_orderkey",))).distinct().collect()]
    merged = merge.upsert(tables.read("orders", touched), batch, ["o_orderkey"])
    tables.replace_buckets("orders", merged, ("o_orderkey",), touched)
    after = {h.part: h for h in tables.live("orders").held}
    same = all(after.get(p) == h for p, h in before.items() if p not in touched)
    few = len(touched) <= batch.count()
    return tables.read("orders").select("*", F.lit(few).alias("few_touched"), F.lit(same).alias("others_kept"))


@query(
    """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 5 = 0 THEN 'refused: repeated key in a merge on o_orderkey' ELSE 'merged' END AS verdict
    FROM orders WHERE o_orderkey % 5 IN (0, 1)
    """
)
def merge_repeated_keys(t: Source) -> DataFrame:
    """A batch that has keys twice is refused whole; the same batch without them is merged."""
    target = t.orders.select("o_orderkey", "o_orderstatus")
    batches = {"twice": "o_orderkey % 5 = 0", "once": "o_orderkey % 5 = 1"}
    frames = []
    for kind, chosen in batches.items():
        batch = target.filter(chosen)
        merged = merge.upsert(target.filter(chosen), batch.unionByName(batch) if kind == "twice" else batch, ["o_orderkey"])
        try:
            verdict, rows = "merged", stored(merged, "merged")
        except Exception as refusal:  # the text of Spark's error
            verdict, rows = "refused: " + ("repeated key in a merge on o_orderkey" if "repeated key in a merge on o_orderkey" in str(refusal) else "other"), batch
        frames.append(rows.withColumn("verdict", F.lit(verdict)))
    return frames[0].unionByName(frames[1])


@query(
    f"""
    WITH {CHOICES}
    SELECT md5('A' || ok || '-{documents.TARGET}' || pk) AS hakutoive_id, CASE WHEN o_custkey % 3 = 0 THEN 'obligated' ELSE 'not-obligated' END AS maksuvelvollisuus,
           true AS in_part
    FROM choice WHERE nr = 1
    """
)
def mart_derived_again(t: Source) -> DataFrame:
    """A mart after two loads, the second derived from changed rows only: the first
    load has the earlier versions of finished orders, without reviews."""
    tables = Tables(t.spark, work_path(t.spark, "derived"), bucket_bytes=1 << 16)
    loads = [(documents.first_versions(t), datetime(2024, 1, 1, 12)), (documents.applications(t), datetime(2024, 1, 2, 12))]
    for df, at in loads:
        run(tables, lambda name: df if name == "ataru_hakemus" else raw_defaults(t.spark, name), at, ["pub_dim_maksuvelvollisuus"])
    in_part = all(tables.live(n).changes for n in ("int_ataru_hakemus", "int_maksuvelvollisuus", "pub_dim_maksuvelvollisuus"))
    return tables.read("pub_dim_maksuvelvollisuus").select("hakutoive_id", "maksuvelvollisuus", F.lit(in_part).alias("in_part"))


def laid_out(docs: DataFrame, path: str, before: str, between: str, after: str) -> None:
    """Array files of a bounded number of documents, with any text around them."""
    dealt = docs.withColumn("chunk", F.floor(F.monotonically_increasing_id() / DOCUMENTS_PER_FILE))
    files = dealt.groupBy("chunk").agg(F.array_join(F.collect_list("doc"), between).alias("body"))
    whole = F.concat(F.lit(before), "body", F.lit(after))
    files.select(whole.alias("value"), "chunk").write.partitionBy("chunk").text(path)


@query(LANDED_SQL)
def land_arrays(t: Source) -> DataFrame:
    """Arrays on one line, and pretty-printed ones, read by many tasks each."""
    folder = work_path(t.spark, "layouts")
    stale = t.orders.filter(F.col("o_orderstatus") == "O").withColumn("o_orderstatus", F.lit("X"))
    one_line = order_documents(stale, "2024-01-01T00:00:00Z")
    laid_out(one_line, f"{folder}/shop/orders__2024-01-01_00.00.00Z__1", "[", ", ", "]")
    pretty = order_documents(t.orders, "2024-02-01T00:00:00Z").select(F.regexp_replace("doc", r'([{,])"', '$1\n    "').alias("doc"))
    laid_out(pretty, f"{folder}/shop/orders__2024-02-01_00.00.00Z__2", "\n[\n  ", "\n  ,\n  ", "\n]\n")
    return landed_columns(arrays.land_arrays(t.spark, folder, now()))


#: Searches whose start is a document, JSON null, or not there.
START_SHAPE = Shape(raw="searches", fields=fields("oid:bigint kausi:json kausi/vuosi:int=vuosi nimi/fi=nimi_fi"), key=None, metadata=False)


@query(
    """
    SELECT o_orderkey AS oid, CASE o_orderstatus WHEN 'F' THEN '{"vuosi":' || year(o_orderdate) || '}' WHEN 'O' THEN 'null' END AS kausi,
           CASE o_orderstatus WHEN 'F' THEN CAST(year(o_orderdate) AS INT) END AS vuosi, o_orderpriority AS nimi_fi,
           CASE o_orderstatus WHEN 'F' THEN 'value' WHEN 'O' THEN 'JSON null' ELSE 'absent' END AS state
    FROM orders
    """
)
def shred_variants(t: Source) -> DataFrame:
    """Documents parsed once at landing, stored as VARIANT, and read from there; JSON
    null and an absent field are told apart."""
    start = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit('"kausi":{"vuosi":'), F.year("o_orderdate"), F.lit("},"))).when(
        F.col("o_orderstatus") == "O", F.lit('"kausi":null,')
    ).otherwise("")
    document = F.concat(F.lit("{"), start, F.lit('"oid":'), "o_orderkey", F.lit(',"nimi":{"fi":"'), "o_orderpriority", F.lit('"}}'))
    raw = documents.raw(t.orders, document, "searches", is_text=True)
    landed = stored(variants.landed(raw), "variants")
    rows = variants.shred(landed, START_SHAPE, now())
    states = landed.select(
        variants.at("data", "oid", kind="bigint").alias("oid"),
        F.when(variants.is_null("data", "kausi"), "JSON null").when(variants.is_there("data", "kausi"), "value").otherwise("absent").alias("state"),
    )
    # what Spark expects of columns read out of VARIANT is far too small: without the hint all of them are broadcast
    return rows.join(states.hint("merge"), ["oid"]).select("oid", "kausi", "vuosi", "nimi_fi", "state")


@query(
    """
    WITH RECURSIVE tree AS (SELECT s_suppkey, CASE WHEN s_suppkey = 2 THEN 1 WHEN s_suppkey = 3 THEN NULL WHEN s_suppkey > 0 THEN s_suppkey // 10 END AS parent FROM supplier),
    pairs AS (SELECT parent AS ancestor, s_suppkey AS descendant, 1 AS distance FROM tree WHERE parent IS NOT NULL
              UNION ALL SELECT t.parent, p.descendant, p.distance + 1 FROM pairs p JOIN tree t ON t.s_suppkey = p.ancestor
              WHERE t.parent IS NOT NULL)
    SELECT ancestor, descendant, distance, true AS others_kept FROM pairs
    """
)
def hierarchy_moved(t: Source) -> DataFrame:
    """A stored closure after two subtrees moved: only the buckets of their nodes are written."""
    tree = supplier_tree(t)
    tables = Tables(t.spark, work_path(t.spark, "tree"), bucket_bytes=1 << 12)
    tables.replace_buckets("pairs", hierarchy.closure(tree, "s_suppkey", "parent"), ("descendant",), fresh=True)
    before = {h.part: h for h in tables.live("pairs").held}
    now_tree = tree.withColumn("parent", F.when(F.col("s_suppkey") == 2, 1).when(F.col("s_suppkey") == 3, F.lit(None)).otherwise(F.col("parent")))
    moved_nodes = tree.filter("s_suppkey IN (2, 3)").select("s_suppkey")
    affected, added = hierarchy.moved(tables.read("pairs"), now_tree, "s_suppkey", "parent", moved_nodes)
    touched = [r[0] for r in affected.select(tables.bucket_of("pairs", ("descendant",))).distinct().collect()]
    rest = tables.read("pairs", touched).join(affected, "descendant", "left_anti")
    tables.replace_buckets("pairs", rest.unionByName(added), ("descendant",), touched)
    after = {h.part: h for h in tables.live("pairs").held}
    kept = all(after.get(p) == h for p, h in before.items() if p not in touched)
    return tables.read("pairs").select("ancestor", "descendant", "distance", F.lit(kept).alias("others_kept"))


@query(
    """
    SELECT o_orderstatus, o_orderpriority, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
    """
)
def distinct_rolled_up(t: Source) -> DataFrame:
    """Distinct customers of report cells and of all sums over them: one shuffle of
    bitmaps, the larger cells by uniting those of the smaller ones."""
    numbers = aggregates.dense_numbers(t.orders, "o_custkey", "number")
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority").join(numbers, ["o_custkey"])
    fine = stored(aggregates.bitmaps(rows, ["o_orderstatus", "o_orderpriority"], "number"), "bitmaps")
    by_status = stored(aggregates.rolled_up(fine, ["o_orderstatus"]), "bitmaps")
    none = F.lit(None).cast("string")
    return (
        aggregates.counted(fine, ["o_orderstatus", "o_orderpriority"], "customers")
        .unionByName(aggregates.counted(by_status, ["o_orderstatus"], "customers").withColumn("o_orderpriority", none))
        .unionByName(aggregates.counted(aggregates.rolled_up(by_status, []), [], "customers").withColumns({"o_orderstatus": none, "o_orderpriority": none}))
        .select("o_orderstatus", "o_orderpriority", "customers")
    )


@query(
    """
    SELECT o_orderkey AS oid, o_orderpriority AS priority, 'one' AS file, false AS mostly_known FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
    UNION ALL SELECT o_orderkey, o_orderpriority, 'two', false FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
    UNION ALL SELECT o_orderkey, 'again', 'three', true FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'
    """
)
def hash_capture_filtered(t: Source) -> DataFrame:
    """Change capture by content hash with a filter beside every write: the second
    load is all new and looks next to nothing up, the third has old rows among new ones."""
    held = Known(Tables(t.spark, work_path(t.spark, "known")), "orders", "hash")
    old, new = t.orders.filter("o_orderdate < TIMESTAMP '1998-01-01'"), t.orders.filter("o_orderdate >= TIMESTAMP '1998-01-01'")
    again = t.orders.filter("o_orderdate >= TIMESTAMP '2000-01-01'").withColumn("o_orderpriority", F.lit("again"))
    for file, orders in (("one", old), ("two", new), ("three", t.orders.unionByName(again))):
        rows = orders.select(F.col("o_orderkey").alias("oid"), F.col("o_orderpriority").alias("priority"), F.lit(file).alias("file"))
        batch = stored(rows.withColumn("hash", F.md5(F.concat_ws("-", "oid", "priority"))), "batch")
        fresh, looked_up = held.fresh(batch)
        held.add(fresh.withColumn("mostly_known", F.lit(looked_up > 0.05 * batch.count())))
    return held.tables.read("orders").select("oid", "priority", "file", "mostly_known")


@query(
    """
    SELECT event_id, user_id FROM (SELECT *, date_trunc('day', ts) AS day FROM events)
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY day DESC, event_id DESC) = 1
    """
)
def stream_newest(t: Source) -> DataFrame:
    """Newest event of every user out of a stream that delivers days in any order and
    some of them again; the state drops what is late or repeated."""
    spark, base = t.spark, work_path(t.spark, "newest")
    # the order among events of a day is part of the time
    day = F.timestamp_micros(F.unix_timestamp(F.date_trunc("day", "ts")) * 1_000_000 + F.col("event_id"))
    events = t.events.select("event_id", "user_id", day.alias("at"))
    for n, chosen in enumerate(["event_id % 3 = 1", "event_id % 3 = 0", "event_id % 3 = 2", "event_id % 3 = 0"]):
        events.filter(chosen).coalesce(1).write.parquet(f"{base}/in/{n}")
    stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    newer = newer_versions(stream, "user_id", "at").writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint")
    newer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return latest.newest_per_key(spark.read.parquet(f"{base}/out").drop("batch"), ["user_id"], "at").select("event_id", "user_id")
