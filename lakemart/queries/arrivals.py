"""Landing, table-version, stream and export queries.  Files are written from
the test tables below the shared folder and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.operators import aggregates, latest
from lakemart.queries.registry import Source, query
from lakemart.session import stored, work_path
from lakemart.sinks.chunks import write_chunks
from lakemart.sinks.export import export_layers, read_export
from lakemart.sinks.gathered import Gathered
from lakemart.sinks.versions import ProtectedHistory, Tables, clustered, view
from lakemart.sources import landing
from lakemart.sources.shred import Shape, fields, shred
from lakemart.sources.tables import read_seed
from lakemart.streaming.arrivals import land_arrivals, refresh_on_arrival

DOCUMENTS_PER_FILE = 5000
LOADED = "2024-06-01 00:00:00"

ORDER_SHAPE = Shape(
    raw="orders",
    fields=fields(
        "oid:bigint customer/key:bigint=asiakas tila price/total:float=hinta paiva:date modified:time=muokattu"
    ),
    key=("tilaus_id", ("oid", "muokattu")),
)


def order_documents(orders: DataFrame, modified: str) -> DataFrame:
    """Orders as nested JSON documents."""
    return orders.select(
        F.to_json(
            F.struct(
                F.col("o_orderkey").alias("oid"),
                F.struct(F.col("o_custkey").alias("key")).alias("customer"),
                F.col("o_orderstatus").alias("tila"),
                F.struct(F.col("o_totalprice").alias("total")).alias("price"),
                F.date_format("o_orderdate", "yyyy-MM-dd").alias("paiva"),
                F.lit(modified).alias("modified"),
            )
        ).alias("doc")
    )


def export_orders(t: Source, folder: str) -> str:
    """Two exports: open orders as 'X' first, then all orders as they are."""
    stale = t.orders.filter(F.col("o_orderstatus") == "O").withColumn("o_orderstatus", F.lit("X"))
    for docs, label in (
        (order_documents(stale, "2024-01-01T00:00:00Z"), "orders__2024-01-01_00.00.00Z__1"),
        (order_documents(t.orders, "2024-02-01T00:00:00Z"), "orders__2024-02-01_00.00.00Z__2"),
    ):
        write_chunks(docs, "doc", DOCUMENTS_PER_FILE, f"{folder}/shop/{label}")
    return folder


def now():
    return F.lit(LOADED).cast("timestamp")


def current_orders(raw: DataFrame) -> DataFrame:
    return latest.newest_per_key(shred(raw, ORDER_SHAPE, now()), ["oid"], "muokattu")


@query(
    """
    SELECT n_name, count(DISTINCT o_custkey) AS customers, count(*) AS orders,
           CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS finished,
           CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS partial,
           CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name
    """
)
def order_report_from_files(t: Source) -> DataFrame:
    """Array files, raw rows, typed rows, newest version, report."""
    raw = landing.land_files(t.spark, export_orders(t, work_path(t.spark, "orders")), now())
    status = F.col("tila")
    rows = current_orders(raw).join(t.customer, F.col("c_custkey") == F.col("asiakas")).join(
        t.nation, F.col("n_nationkey") == F.col("c_nationkey")
    )
    return rows.groupBy("n_name").agg(
        F.count_distinct("asiakas").alias("customers"),
        F.count(F.lit(1)).alias("orders"),
        aggregates.count_where(status == "F").alias("finished"),
        aggregates.count_where(status == "P").alias("partial"),
        aggregates.count_where(status == "O").alias("open"),
    )


LANDED_SQL = """
    SELECT CAST(o_orderkey AS BIGINT) AS oid, 'X' AS tila, 'shop' AS source, 'orders' AS raw_table,
           '2024-01-01 00:00' AS exported FROM orders WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT o_orderkey, o_orderstatus, 'shop', 'orders', '2024-02-01 00:00' FROM orders
"""


def landed_columns(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.get_json_object("data", "$.oid").cast("bigint").alias("oid"),
        F.get_json_object("data", "$.tila").alias("tila"),
        "source",
        "raw_table",
        F.date_format("dw_metadata_source_timestamp_at", "yyyy-MM-dd HH:mm").alias("exported"),
    )


@query(LANDED_SQL)
def land_files(t: Source) -> DataFrame:
    return landed_columns(landing.land_files(t.spark, export_orders(t, work_path(t.spark, "orders")), now()))


@query(LANDED_SQL)
def land_element_lines(t: Source) -> DataFrame:
    """The same files read line by line, so that one file feeds many tasks."""
    return landed_columns(landing.land_element_lines(t.spark, export_orders(t, work_path(t.spark, "orders")), now()))


@query(
    """
    SELECT 'same' AS verdict, count(*) + (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS rows FROM orders
    """
)
def row_numbers_agree(t: Source) -> DataFrame:
    """Row numbers of the whole-file reader and the line reader."""
    folder = export_orders(t, work_path(t.spark, "orders"))
    keys = ["dw_metadata_filename", "dw_metadata_file_row_number", "data"]
    whole = landing.land_files(t.spark, folder, now()).select(*keys)
    lines = landing.land_element_lines(t.spark, folder, now()).select(*keys)
    both = whole.withColumn("w", F.lit(1)).join(lines.withColumn("l", F.lit(1)), keys, "full")
    verdict = F.when(F.col("w").isNull() | F.col("l").isNull(), "different").otherwise("same")
    return both.groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("rows"))


@query(LANDED_SQL)
def land_stream(t: Source) -> DataFrame:
    """The files as a stream, landed by two runs; the second finds nothing new."""
    spark, base = t.spark, work_path(t.spark, "stream")
    export_orders(t, f"{base}/in")
    for _ in range(2):
        land_arrivals(spark, f"{base}/in", f"{base}/raw", f"{base}/checkpoint", now(), files_per_batch=100)
    return landed_columns(spark.read.parquet(f"{base}/raw").drop("batch"))


@query(
    """
    SELECT o_orderkey AS oid, o_custkey AS asiakas, o_orderstatus AS tila, o_totalprice AS hinta,
           strftime(o_orderdate, '%Y-%m-%d') AS paiva FROM orders
    """
)
def refresh_stream(t: Source) -> DataFrame:
    """Landed files refresh the table of the newest orders per batch; order does not matter."""
    spark, base = t.spark, work_path(t.spark, "refresh")
    export_orders(t, f"{base}/in")
    tables = Tables(spark, f"{base}/tables", bucket_bytes=1 << 16)
    held = Gathered(tables, "orders", ("oid",), "muokattu")

    def step(batch: DataFrame, number: int) -> None:
        rows = stored(current_orders(landing.explode_files(batch, now())), "batch")
        if not rows.isEmpty():
            held.add(rows)

    from lakemart.streaming.arrivals import arriving_files

    refresh_on_arrival(arriving_files(spark, f"{base}/in", 100), f"{base}/checkpoint", step)
    held.merge()
    return tables.read("orders").select(
        "oid", "asiakas", "tila", "hinta", F.date_format("paiva", "yyyy-MM-dd").alias("paiva")
    )


@query("SELECT o_orderkey AS oid, o_orderstatus AS tila FROM orders")
def resplit(t: Source) -> DataFrame:
    """One dump cut into files of a bounded number of documents."""
    path = work_path(t.spark, "dump")
    write_chunks(order_documents(t.orders, "2024-01-01T00:00:00Z"), "doc", DOCUMENTS_PER_FILE, f"{path}/orders__2024-01-01_00.00.00Z__1")
    raw = landing.land_files(t.spark, path, now())
    return raw.select(
        F.get_json_object("data", "$.oid").cast("bigint").alias("oid"), F.get_json_object("data", "$.tila").alias("tila")
    )


@query(
    """
    SELECT 'during' AS moment, count(*) AS rows FROM customer WHERE c_acctbal < 5000
    UNION ALL SELECT 'after', count(*) FROM customer
    """
)
def snapshot_swap(t: Source) -> DataFrame:
    """A reader that starts before a replacement keeps its version."""
    tables = Tables(t.spark, work_path(t.spark, "tables"), prefix="test_")
    before = tables.write("customer", t.customer.filter("c_acctbal < 5000"))
    after = tables.write("customer", t.customer)
    count = F.count(F.lit(1)).alias("rows")
    return before.agg(F.lit("during").alias("moment"), count).unionByName(after.agg(F.lit("after").alias("moment"), count))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation")
def seed_table(t: Source) -> DataFrame:
    path = work_path(t.spark, "seed")
    t.nation.select("n_nationkey", "n_name").write.option("header", True).csv(path)
    return read_seed(t.spark, path, "n_nationkey string, n_name string")


@query(
    """
    SELECT 'pub_nation' AS name, 1 AS version, CAST(n_nationkey AS VARCHAR) AS id, n_name AS label, CAST(n_regionkey AS VARCHAR) AS place FROM nation
    UNION ALL SELECT 'pub_supplier', 1, CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR) FROM supplier
    """
)
def export_manifest(t: Source) -> DataFrame:
    """Export a layer as compressed CSV and read the parts that its manifest lists."""
    spark, base = t.spark, work_path(t.spark, "export")
    tables = Tables(spark, f"{base}/tables")
    tables.write("pub_nation", t.nation)
    tables.write("pub_supplier", t.supplier)
    tables.write("int_region", t.region)
    export_layers(tables, ["pub_"], f"{base}/out")
    listed = spark.read.json(f"{base}/out/pub/manifest.json", multiLine=True).select(F.explode("tables").alias("e")).select("e.*").collect()
    shown = {"pub_nation": ("n_nationkey", "n_name", "n_regionkey"), "pub_supplier": ("s_suppkey", "s_name", "s_nationkey")}
    frames = []
    for entry in listed:
        name = entry.key.split("/")[1].removesuffix(".csv.gz")
        rows = read_export(spark, f"{base}/out/{entry.key}", entry.parts, tables.read(name).schema)
        columns = [F.col(c).cast("string").alias(a) for c, a in zip(shown[name], ("id", "label", "place"))]
        frames.append(rows.select(F.lit(name).alias("name"), F.lit(entry.version).cast("int").alias("version"), *columns))
    return reduce(DataFrame.unionByName, frames)


@query("SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS place FROM orders")
def sorted_write(t: Source) -> DataFrame:
    """Clustered by range on write and read back; each row with its place in
    the files, in the order of their names."""
    path = work_path(t.spark, "sorted")
    clustered(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", "o_orderkey").write.parquet(path)
    block = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    rows = t.spark.read.parquet(path).select("*", *block, F.monotonically_increasing_id().alias("at"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return rows.join(blocks, ["file", "block"]).select("o_orderkey", "o_custkey", (F.col("at") - F.col("first") + F.col("before") + 1).alias("place"))


@query(
    "SELECT 'history' AS kind, true AS refused, o_orderkey, o_orderstatus FROM orders "
    "UNION ALL SELECT 'derived', false, o_orderkey, 'again' FROM orders WHERE o_orderstatus = 'F'"
)
def history_not_rebuilt(t: Source) -> DataFrame:
    """A full refresh of two tables with other rows: history refuses it and keeps
    its rows, a table that is derived takes the new ones."""
    tables = Tables(t.spark, work_path(t.spark, "protected"))
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    fewer = rows.filter("o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("again"))
    frames = []
    for kind in ("history", "derived"):
        tables.rebuild(kind, rows, history=kind == "history")
        refused = False
        try:
            tables.rebuild(kind, fewer, history=kind == "history")
        except ProtectedHistory:
            refused = True
        frames.append(tables.read(kind).select(F.lit(kind).alias("kind"), F.lit(refused).alias("refused"), "o_orderkey", "o_orderstatus"))
    return frames[0].unionByName(frames[1])


@query("SELECT n_regionkey, count(*) AS nations FROM nation GROUP BY n_regionkey")
def published_view(t: Source) -> DataFrame:
    name = view(t.nation, "lakemart_published_nation")
    return t.spark.sql(f"SELECT n_regionkey, count(*) AS nations FROM {name} GROUP BY n_regionkey")
