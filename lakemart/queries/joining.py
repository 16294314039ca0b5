"""Join, set and hierarchy queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators import hierarchy, joins
from lakemart.queries.registry import Source, query


@query(
    """
    SELECT o_orderkey, c_name, n_name, r_name
    FROM orders JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
    """
)
def left_join_chain(t: Source) -> DataFrame:
    return (
        t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"), "left")
        .select("o_orderkey", "c_name", "n_name", "r_name")
    )


@query(
    """
    SELECT l_partkey, l_suppkey, count(*) AS lines, min(p_brand) AS brand
    FROM lineitem JOIN (SELECT DISTINCT l_partkey AS pk, l_suppkey AS sk FROM lineitem WHERE l_returnflag = 'R') r
      ON l_partkey = pk AND l_suppkey = sk JOIN part ON p_partkey = l_partkey
    GROUP BY 1, 2
    """
)
def composite_key_join(t: Source) -> DataFrame:
    keys = ["l_partkey", "l_suppkey"]
    lines = t.lineitem.groupBy(*keys).agg(F.count(F.lit(1)).alias("lines"))
    returned = t.lineitem.filter(F.col("l_returnflag") == "R").select(*keys).distinct()
    named = lines.join(returned, keys).join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    return named.select(*keys, "lines", F.col("p_brand").alias("brand"))


@query(
    """
    SELECT coalesce(c.nation, s.nation) AS nation, c.customers, s.suppliers
    FROM (SELECT c_nationkey AS nation, count(*) AS customers FROM customer WHERE c_acctbal > 9900 GROUP BY 1) c
    FULL JOIN (SELECT s_nationkey AS nation, count(*) AS suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) s
      ON c.nation = s.nation
    """
)
def full_outer_coalesce(t: Source) -> DataFrame:
    customers = t.customer.filter("c_acctbal > 9900").groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    suppliers = t.supplier.filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).alias("suppliers")
    )
    return joins.full_on(customers, suppliers, ["nation"])


@query(
    """
    SELECT c_custkey, 'with' AS kind FROM customer WHERE EXISTS
        (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-06-01')
    UNION ALL
    SELECT c_custkey, 'without' FROM customer WHERE NOT EXISTS
        (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-06-01')
    """
)
def semi_anti(t: Source) -> DataFrame:
    recent = t.orders.filter(F.col("o_orderdate") >= "2001-06-01").select(F.col("o_custkey").alias("c_custkey"))
    customers = t.customer.select("c_custkey")
    return joins.keep_matching(customers, recent, ["c_custkey"]).withColumn("kind", F.lit("with")).unionByName(
        joins.drop_matching(customers, recent, ["c_custkey"]).withColumn("kind", F.lit("without"))
    )


@query(
    """
    SELECT 'clean' AS side, s_suppkey FROM supplier
    WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 2)
    UNION ALL
    SELECT 'null on the right', s_suppkey FROM supplier
    WHERE s_nationkey NOT IN (SELECT CASE WHEN n_nationkey > 3 THEN n_nationkey END FROM nation)
    UNION ALL
    SELECT 'null on the left', s_suppkey FROM supplier
    WHERE CASE WHEN s_nationkey > 12 THEN s_nationkey END NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 2)
    UNION ALL
    SELECT 'empty right', s_suppkey FROM supplier
    WHERE CASE WHEN s_nationkey > 12 THEN s_nationkey END NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey > 99)
    """
)
def null_aware_not_in(t: Source) -> DataFrame:
    suppliers, nations = t.supplier.select("s_suppkey", "s_nationkey"), t.nation
    holed = suppliers.withColumn("s_nationkey", F.when(F.col("s_nationkey") > 12, F.col("s_nationkey")))
    few = nations.filter("n_regionkey < 2")
    with_null = nations.withColumn("n_nationkey", F.when(F.col("n_nationkey") > 3, F.col("n_nationkey")))
    none = nations.filter("n_regionkey > 99")
    cases = {
        "clean": (suppliers, few),
        "null on the right": (suppliers, with_null),
        "null on the left": (holed, few),
        "empty right": (holed, none),
    }
    frames = [
        joins.not_in(left, "s_nationkey", right, "n_nationkey").select(F.lit(side).alias("side"), "s_suppkey")
        for side, (left, right) in cases.items()
    ]
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


@query(
    """
    SELECT o_orderkey, CAST(date_diff('day', o_orderdate, newest) AS INT) AS age_days
    FROM orders, (SELECT max(o_orderdate) AS newest FROM orders)
    """
)
def scalar_aggregate_join(t: Source) -> DataFrame:
    newest = t.orders.agg(F.max("o_orderdate").alias("newest"))
    return joins.with_scalar(t.orders, newest).select(
        "o_orderkey", F.date_diff("newest", "o_orderdate").alias("age_days")
    )


@query(
    """
    SELECT c_custkey, f.o_orderkey AS first_order, strftime(f.o_orderdate, '%Y-%m-%d') AS first_day
    FROM customer LEFT JOIN LATERAL
        (SELECT o_orderkey, o_orderdate FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F'
         ORDER BY o_orderdate, o_orderkey LIMIT 1) f ON true
    """
)
def lateral_first(t: Source) -> DataFrame:
    finished = t.orders.filter(F.col("o_orderstatus") == "F")
    first = joins.first_match(
        t.customer.select("c_custkey"), finished, "c_custkey", "o_custkey",
        F.col("o_orderdate").asc_nulls_last(), F.col("o_orderkey").asc_nulls_last(),
    )
    return first.select(
        "c_custkey",
        F.col("o_orderkey").alias("first_order"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("first_day"),
    )


@query(
    """
    SELECT conv_id, CAST(turn AS INT) AS turn, word AS item_word, item_id
    FROM (SELECT conv_id, turn, unnest(list_distinct(string_split(text, ' '))) AS word FROM conversations)
    JOIN (SELECT DISTINCT item_id, unnest(string_split(text, ' ')) AS w FROM benchmark) ON w = word
    """
)
def containment_join(t: Source) -> DataFrame:
    """Turns paired with every item that shares a word with their text."""
    vocabulary = t.benchmark.select("item_id", F.explode(F.array_distinct(F.split("text", " "))).alias("w"))
    turns = t.conversations.withColumn("words", F.split("text", " "))
    return joins.member_of(vocabulary, "w", turns, "words").select(
        "conv_id", F.col("turn").cast("int").alias("turn"), F.col("w").alias("item_word"), "item_id"
    )


@query(
    """
    SELECT s_suppkey, n_nationkey FROM supplier JOIN nation
    ON s_nationkey = n_nationkey OR s_nationkey = n_regionkey
    """
)
def or_join(t: Source) -> DataFrame:
    pairs = joins.either_equal(
        t.supplier, t.nation, ("s_nationkey", "n_nationkey"), ("s_nationkey", "n_regionkey")
    )
    return pairs.select("s_suppkey", "n_nationkey")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN part
    ON l_partkey = p_partkey AND (l_quantity > p_size OR p_type = 'ECONOMY')
    """
)
def equi_join_residual_or(t: Source) -> DataFrame:
    match = (F.col("l_partkey") == F.col("p_partkey")) & (
        (F.col("l_quantity") > F.col("p_size")) | (F.col("p_type") == "ECONOMY")
    )
    return t.lineitem.join(t.part, match).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def supplier_tree(t: Source) -> DataFrame:
    """Suppliers as a tree: the parent key is the key without its last digit."""
    parent = F.when(F.col("s_suppkey") > 0, F.floor(F.col("s_suppkey") / 10))
    return t.supplier.select("s_suppkey", parent.cast("bigint").alias("parent"), "s_name")


@query(
    """
    WITH tree AS (SELECT s_suppkey, s_name, CASE WHEN s_suppkey > 0 THEN s_suppkey // 10 END AS parent FROM supplier)
    SELECT a.s_suppkey, a.s_name, b.s_name AS above, c.s_name AS above_2, d.s_name AS above_3
    FROM tree a LEFT JOIN tree b ON a.parent = b.s_suppkey LEFT JOIN tree c ON b.parent = c.s_suppkey
    LEFT JOIN tree d ON c.parent = d.s_suppkey
    """
)
def hierarchy_levels(t: Source) -> DataFrame:
    levels = hierarchy.ancestors_by_level(supplier_tree(t), "s_suppkey", "parent", ["s_name"], 3)
    return levels.select(
        "s_suppkey",
        "s_name",
        F.col("s_name_1").alias("above"),
        F.col("s_name_2").alias("above_2"),
        F.col("s_name_3").alias("above_3"),
    )


@query(
    """
    WITH RECURSIVE tree AS (SELECT s_suppkey, CASE WHEN s_suppkey > 0 THEN s_suppkey // 10 END AS parent FROM supplier),
    pairs AS (SELECT parent AS ancestor, s_suppkey AS descendant, 1 AS distance FROM tree WHERE parent IS NOT NULL
              UNION ALL SELECT t.parent, p.descendant, p.distance + 1 FROM pairs p JOIN tree t ON t.s_suppkey = p.ancestor
              WHERE t.parent IS NOT NULL)
    SELECT ancestor, descendant, distance FROM pairs UNION SELECT s_suppkey, s_suppkey, 0 FROM tree
    """
)
def hierarchy_closure(t: Source) -> DataFrame:
    return hierarchy.closure_with_self(supplier_tree(t), "s_suppkey", "parent")


@query(
    """
    SELECT n_name FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE c_acctbal > 9000
    UNION SELECT n_name FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_acctbal < 1000
    """
)
def union_distinct(t: Source) -> DataFrame:
    rich = t.customer.filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    poor = t.supplier.filter("s_acctbal < 1000").select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    return t.nation.join(rich.union(poor).distinct(), ["n_nationkey"]).select("n_name")


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def select_distinct(t: Source) -> DataFrame:
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderstatus
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND l_returnflag = 'R' AND o_orderstatus <> 'F'
    """
)
def one_sided_on(t: Source) -> DataFrame:
    on = (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_returnflag") == "R") & (F.col("o_orderstatus") != "F")
    return t.lineitem.join(t.orders, on, "left").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderstatus"
    )
