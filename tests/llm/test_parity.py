from pyspark.sql import functions as F

from lakemart.llm import minhash


def test_parity_bits_are_looked_up_once_for_a_set(spark):
    places = spark.range(300).select(
        (F.col("id") % 3).alias("node"), (F.col("id") % 3 * 10).alias("version"), F.col("id").alias("part"), F.lit(4).alias("n")
    )
    bits = spark.range(3).select(
        F.col("id").alias("node"), (F.col("id") * 10).alias("version"),
        F.transform(F.sequence(F.lit(0), F.lit(minhash.PARITY_WORDS - 1)), lambda i: F.col("id") * 100 + i).alias("parity"),
    )
    found = minhash._with_parity(places, bits)
    assert found.count() == 300
    assert all(r.part % 3 == r.node and r.n == 4 and (r.p0, r.p15) == (r.node * 100, r.node * 100 + 15) for r in found.collect())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Join Inner") < plan.index("collect_list")
