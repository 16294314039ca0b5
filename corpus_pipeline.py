"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents that its predecessor kept and decides on all of
them; all but the last return the columns of documents.  A row without doc_id
passes every filter that needs one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import prepare, stored, table
from lakemart.llm.decontamination import find_contamination
from lakemart.llm.lines import remove_lines
from lakemart.llm.minhash import near_duplicates
from lakemart.llm.packing import pack
from lakemart.llm.queries import word_vocabulary
from lakemart.llm.toxicity import score_toxicity

#: Words of a shingle for near duplicates, and the least similarity in percent.
NEAR_SHINGLE, NEAR_LEAST = 5, 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 0").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that align with an earlier document go, and documents of which no
    line is left; n_chars is counted anew."""
    cut = remove_lines(docs)
    left = cut.filter((F.col("n_removed") == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest id."""
    prepare(spark)
    judged = near_duplicates(docs, NEAR_SHINGLE, NEAR_LEAST)
    gone = judged.filter("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if again.limit(1).count():
        named = F.col("doc_id").isNotNull()
        kept = kept.filter(named).dropDuplicates(["doc_id"]).unionByName(kept.filter(~named))
    return kept


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a share stands in the benchmark go."""
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.filter("NOT contaminated").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the training sequences."""
    prepare(spark)
    return pack(docs, word_vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL cannot train and apply the models or align documents; tests hold each stage
#: against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
