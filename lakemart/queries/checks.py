"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators import quality
from lakemart.queries.registry import Source, query


@query(
    """
    SELECT 'orders.o_orderkey unique' AS "check", count(*) AS violations FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'lineitem.(order, line) unique', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'lineitem.l_orderkey known', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'finished orders known', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    UNION ALL SELECT 'customer in credit', count(*) FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'documents labelled', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """
)
def quality_report(t: Source) -> DataFrame:
    credit = t.customer.withColumn("credit", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    return quality.report(
        {
            "orders.o_orderkey unique": quality.repeated(t.orders, ["o_orderkey"]),
            "lineitem.(order, line) unique": quality.repeated(t.lineitem, ["l_orderkey", "l_linenumber"]),
            "lineitem.l_orderkey known": quality.orphans(t.lineitem, "l_orderkey", t.orders, "o_orderkey"),
            "finished orders known": quality.orphans(
                t.lineitem, "l_orderkey", t.orders.filter(F.col("o_orderstatus") == "F"), "o_orderkey"
            ),
            "customer in credit": quality.missing(credit, "credit"),
            "documents labelled": quality.orphans(t.documents, "doc_id", t.labels, "doc_id"),
        }
    )


@query(
    """
    SELECT 'unique' AS "check", count(*) AS violations FROM (SELECT l_partkey FROM lineitem WHERE l_suppkey % 10 <> 3 GROUP BY l_partkey, l_suppkey HAVING count(*) > 1)
    UNION ALL SELECT 'not_null', count(*) FROM lineitem WHERE l_suppkey % 10 = 3
    """
)
def primary_key_check(t: Source) -> DataFrame:
    """Keys of line items, some of them made NULL."""
    supplier = F.when(F.col("l_suppkey") % 10 != 3, F.col("l_suppkey"))
    return quality.primary_key_violations(t.lineitem.withColumn("l_suppkey", supplier), ["l_partkey", "l_suppkey"])


@query("SELECT n_nationkey, n_name, n_regionkey, 'n_name, n_regionkey, title' AS refused FROM nation")
def contract_check(t: Source) -> DataFrame:
    """Rows that keep the contract, and the columns for which a changed table is refused."""
    contract = T.StructType.fromDDL("n_nationkey int, n_name string, n_regionkey int")
    kept = quality.assert_contract(t.nation.select("n_regionkey", "n_name", "n_nationkey"), contract)
    changed = t.nation.select("n_nationkey", F.col("n_name").alias("title"), F.col("n_regionkey").cast("string").alias("n_regionkey"))
    return kept.withColumn("refused", F.lit(", ".join(quality.contract_differences(changed, contract))))
