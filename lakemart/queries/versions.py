"""Latest-version and window queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.keys import newest, oldest, surrogate_key
from lakemart.operators import latest
from lakemart.queries.registry import Source, query


@query(
    """
    SELECT o_custkey, o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS order_day
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                 ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC NULLS FIRST) AS n FROM orders)
    WHERE n = 1
    """
)
def latest_per_key(t: Source) -> DataFrame:
    return latest.newest_per_key(t.orders, ["o_custkey"], "o_orderdate", "o_orderkey").select(
        "o_custkey", "o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day")
    )


@query(
    """
    SELECT a.event_id, a.user_id, a.event_type
    FROM events a
    WHERE NOT EXISTS (SELECT 1 FROM events b WHERE b.user_id = a.user_id
                      AND date_trunc('day', a.ts) < date_trunc('day', b.ts))
    """
)
def latest_anti_join(t: Source) -> DataFrame:
    events = t.events.withColumn("day", F.date_trunc("day", "ts"))
    return latest.newest_with_ties(events, ["user_id"], "day").select("event_id", "user_id", "event_type")


@query(
    """
    SELECT o_custkey, o_orderkey, o_orderstatus
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY
                 CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 3 END, o_orderkey) AS n FROM orders)
    WHERE n = 1
    """
)
def priority_pick(t: Source) -> DataFrame:
    rank = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "P", 2).otherwise(3)
    return latest.first_per_key(t.orders, ["o_custkey"], rank, F.col("o_orderkey")).select(
        "o_custkey", "o_orderkey", "o_orderstatus"
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS quantity,
           l_quantity = max(l_quantity) OVER (PARTITION BY l_partkey, l_suppkey) AS is_top
    FROM lineitem
    """
)
def max_over_flag(t: Source) -> DataFrame:
    flagged = latest.with_maximum_flag(t.lineitem, ["l_partkey", "l_suppkey"], "l_quantity", "is_top")
    return flagged.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("quantity"),
        "is_top",
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS quantity
    FROM (SELECT *, max(l_quantity) OVER (PARTITION BY l_partkey) AS top FROM lineitem)
    WHERE l_quantity = top
    """
)
def max_over_filter(t: Source) -> DataFrame:
    return latest.rows_at_maximum(t.lineitem, ["l_partkey"], "l_quantity").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("bigint").alias("quantity")
    )


@query(
    """
    SELECT DISTINCT ON (split_part(p_name, ' ', 2), p_brand)
           split_part(p_name, ' ', 2) AS noun, p_brand, p_partkey, p_size
    FROM part
    ORDER BY split_part(p_name, ' ', 2), p_brand, p_size DESC NULLS FIRST, p_partkey ASC NULLS LAST
    """
)
def distinct_on_expression(t: Source) -> DataFrame:
    noun = F.split_part("p_name", F.lit(" "), F.lit(2))
    parts = t.part.withColumn("noun", noun)
    return latest.first_per_key(parts, ["noun", "p_brand"], newest("p_size"), oldest("p_partkey")).select(
        "noun", "p_brand", "p_partkey", "p_size"
    )


@query(
    """
    SELECT o_orderkey, o_custkey, last_value(o_orderkey ORDER BY month, o_totalprice, o_orderkey) OVER (
        PARTITION BY nullif(o_custkey, 1) ORDER BY month) AS last_key
    FROM (SELECT *, nullif(date_trunc('month', o_orderdate), TIMESTAMP '1995-01-01') AS month FROM orders)
    """
)
def running_last_value(t: Source) -> DataFrame:
    """Some customers and months are made NULL, which are peers as well."""
    orders = t.orders.withColumns({
        "month": F.nullif(F.date_trunc("month", F.col("o_orderdate").cast("timestamp")), F.lit("1995-01-01").cast("timestamp")),
        "customer": F.nullif("o_custkey", F.lit(1)),
    })
    return latest.last_of_peers(orders, ["customer"], "month", "o_orderkey", "last_key", "o_totalprice", "o_orderkey").select(
        "o_orderkey", "o_custkey", "last_key"
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           md5(concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
               coalesce(CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END,
                        '_dbt_utils_surrogate_key_null_'))) AS line_id
    FROM lineitem
    """
)
def surrogate_keys(t: Source) -> DataFrame:
    returned = F.nullif("l_returnflag", F.lit("N"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", surrogate_key("l_orderkey", "l_linenumber", returned).alias("line_id")
    )
