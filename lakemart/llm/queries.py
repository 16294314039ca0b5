"""One registered query per corpus operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import twins
from lakemart.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from lakemart.llm.decontamination import find_contamination

    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, folder, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query()
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    from lakemart.llm.sharding import shard_documents

    return shard_documents(table(spark, folder, "documents"))


def word_vocabulary() -> str:
    """The public vocabulary that sequences are packed with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    from lakemart.llm.packing import pack

    return pack(table(spark, folder, "documents"), word_vocabulary())


def _license_sql() -> str:
    from lakemart.llm.licenses import oracle

    return oracle()


@query(_license_sql())
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    from lakemart.llm.licenses import scan_licenses

    return scan_licenses(table(spark, folder, "documents"), keep=["doc_id"]).select("doc_id", "n_matches", "license", "dice")


@query()
def op8_minhash(spark: SparkSession, folder: str) -> DataFrame:
    from lakemart.llm.minhash import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


@query()
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from lakemart.llm.toxicity import score_toxicity

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return score_toxicity(docs, table(spark, folder, "labels"), keep=["doc_id"]).select("doc_id", "held_out", "score", "predicted")


@query()
def op2_substrings(spark: SparkSession, folder: str) -> DataFrame:
    from lakemart.llm.substrings import remove_repeats

    return remove_repeats(table(spark, folder, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from lakemart.llm.lines import remove_lines

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return remove_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    from lakemart.llm.neighbours import search

    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return search(vectors, vectors.filter("vec_id % 20 = 0"))


@query()
def op1_html(spark: SparkSession, folder: str) -> DataFrame:
    from lakemart.llm.html import extract

    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return extract(pages, keep=["page_id", "url"])


@query(twins.manifest_sql())
def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    from lakemart.llm.manifest import verify_tampered

    return verify_tampered(table(spark, folder, "documents"))


@query(twins.near_vectors_sql())
def op12_crosspolytope(spark: SparkSession, folder: str) -> DataFrame:
    from lakemart.llm.crosspolytope import near_vectors

    return near_vectors(table(spark, folder, "embeddings"))


@query(twins.centroids_sql())
def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    from lakemart.llm.centroids import cluster

    return cluster(table(spark, folder, "embeddings"))


@query()
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, folder)
