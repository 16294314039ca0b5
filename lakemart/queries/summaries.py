"""Report aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators import aggregates
from lakemart.queries.registry import Source, query


def money(column: str):
    """Exact sums: cents as decimals, so the order of addition does not matter."""
    return F.col(column).cast("decimal(18,2)")


@query(
    """
    SELECT n_name, CAST(year(o_orderdate) AS INT) AS order_year, c_mktsegment, o_orderpriority,
        count(DISTINCT o_custkey) AS customers,
        CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS finished,
        CAST(sum(CASE WHEN o_orderstatus = 'P' AND c_acctbal > 0 THEN 1 ELSE 0 END) AS BIGINT) AS partial_in_credit,
        CAST(sum(CASE WHEN nullif(o_orderstatus, 'O') IS DISTINCT FROM 'F' THEN 1 ELSE 0 END) AS BIGINT) AS not_finished,
        CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS open_value,
        sum(CASE WHEN o_totalprice > 450000 THEN 1 ELSE 0 END) > 0 AS any_large
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    GROUP BY 1, 2, 3, 4
    """
)
def conditional_report(t: Source) -> DataFrame:
    status = F.col("o_orderstatus")
    rows = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(
        t.nation, F.col("n_nationkey") == F.col("c_nationkey")
    )
    return rows.groupBy("n_name", F.year("o_orderdate").alias("order_year"), "c_mktsegment", "o_orderpriority").agg(
        F.count_distinct("o_custkey").alias("customers"),
        aggregates.count_where(status == "F").alias("finished"),
        aggregates.count_where((status == "P") & (F.col("c_acctbal") > 0)).alias("partial_in_credit"),
        aggregates.count_where(~F.nullif(status, F.lit("O")).eqNullSafe("F")).alias("not_finished"),
        aggregates.sum_where(status == "O", money("o_totalprice")).cast("double").alias("open_value"),
        aggregates.any_set(F.col("o_totalprice") > 450000).alias("any_large"),
    )


@query(
    """
    SELECT p_type, coalesce(string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) FILTER (WHERE p_size > 45), '') AS brands
    FROM part GROUP BY p_type
    """
)
def distinct_agg_filter(t: Source) -> DataFrame:
    brands = aggregates.distinct_records(F.col("p_size") > 45, F.col("p_brand"))
    return t.part.groupBy("p_type").agg(
        F.array_join(F.transform(brands, lambda b: b["p_brand"]), ",").alias("brands")
    )


@query("SELECT max(o_orderdate) AS newest, count(*) AS n FROM orders")
def scalar_maximum(t: Source) -> DataFrame:
    return t.orders.agg(F.max("o_orderdate").alias("newest"), F.count(F.lit(1)).alias("n"))


@query(
    """
    SELECT doc, count(*) AS parts FROM
      (SELECT '{"type":"' || p_type || '","size":' || CAST(p_size AS VARCHAR) || '}' AS doc FROM part) GROUP BY doc
    """
)
def group_by_document(t: Source) -> DataFrame:
    document = F.to_json(F.struct(F.col("p_type").alias("type"), F.col("p_size").alias("size")))
    return t.part.groupBy(document.alias("doc")).agg(F.count(F.lit(1)).alias("parts"))


@query("SELECT DISTINCT p_type, p_brand, p_size FROM part")
def group_by_as_dedupe(t: Source) -> DataFrame:
    return t.part.dropDuplicates(["p_type", "p_brand", "p_size"]).select("p_type", "p_brand", "p_size")


@query(
    """
    SELECT l_suppkey, CAST(year(l_shipdate) AS INT) AS ship_year,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS DOUBLE) AS revenue,
           count(DISTINCT l_orderkey) AS orders
    FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag IN ('A', 'N') GROUP BY 1, 2
    """
)
def supplier_year_report(t: Source) -> DataFrame:
    lines = t.lineitem.filter((F.col("l_linestatus") == "F") & F.col("l_returnflag").isin("A", "N"))
    value = money("l_extendedprice") * (1 - money("l_discount"))
    return lines.groupBy("l_suppkey", F.year("l_shipdate").alias("ship_year")).agg(
        F.sum(value).cast("double").alias("revenue"), F.count_distinct("l_orderkey").alias("orders")
    )


@query(
    """
    SELECT o_orderkey, o_orderstatus = 'F' AS finished, nullif(o_orderstatus, 'O') = 'F' AS unknown_or_finished,
           nullif(o_orderstatus, 'O') = 'F' AND o_totalprice > 200000 AS large_finished,
           nullif(o_orderstatus, 'O') = 'F' OR o_totalprice > 200000 AS large_or_finished
    FROM orders
    """
)
def three_valued_flags(t: Source) -> DataFrame:
    status = F.nullif("o_orderstatus", F.lit("O"))
    large = F.col("o_totalprice") > 200000
    return t.orders.select(
        "o_orderkey",
        (F.col("o_orderstatus") == "F").alias("finished"),
        (status == "F").alias("unknown_or_finished"),
        ((status == "F") & large).alias("large_finished"),
        ((status == "F") | large).alias("large_or_finished"),
    )
