import __spark_entry__ as entry_point
import pytest

import corpus_pipeline as C
from lakemart.llm import decontamination, toxicity
from lakemart.llm.queries import ORACLES, QUERIES
from tests.llm.corpus import odd_documents
from tests.llm.test_lines import plain_cut
from tests.llm.test_minhash import plain_components
from tests.oracle import BASE, connect, differences

FOLDER = f"{BASE}/sf0.001"


def test_every_operator_is_registered():
    assert {name.split("_")[0] for name in QUERIES} == {*(f"op{n}" for n in range(1, 11)), "pipeline"}
    assert set(QUERIES) <= set(entry_point.queries()) and C.ORACLE_SQL is None
    assert [name for name, _ in C.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_with_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name])[:2] == ([], [])


def test_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scored = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()}
    items = [(str(r.item_id), decontamination.words(r.text)) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    automaton = decontamination.build(items)
    schema = docs.schema
    for k, (name, stage) in enumerate(C.STAGES):
        before = docs.collect()
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = docs.collect()
        if name != "packing":
            assert docs.schema == schema
        if name == "toxicity":
            want = {r.doc_id for r in before if not scored[r.doc_id]}
        elif name == "near_dedup":
            found = plain_components([(r.doc_id, r.text) for r in before], C.NEAR_SHINGLE)
            want = {i for i, (_, top) in found.items() if i == top}
        elif name == "decontamination":
            want = set()
            for r in before:
                n = len(decontamination.words(r.text))
                hit = sum(e - s for s, e in decontamination.hits(automaton, decontamination.words(r.text))[0])
                if not (hit and 20 * hit >= n):
                    want.add(r.doc_id)
        elif name == "line_dedup":
            cut = plain_cut([(r.doc_id, r.text) for r in before])
            want = {i for i, t in cut.items() if t.strip()}
            for r in after:
                assert r.text == cut[r.doc_id] and r.n_chars == len(r.text)
        else:
            want = {r.doc_id for r in before}
        assert {r.doc_id for r in after} == want
    whole = C.run(spark, FOLDER)
    assert sorted(map(tuple, whole.select("doc_id", "piece", "ids_crc32").collect())) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in after)


def test_odd_rows_pass_all_stages(spark, tmp_path):
    docs = odd_documents(spark)
    for k, (_, stage) in enumerate(C.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    kept = {r.doc_id for r in docs.collect()}
    assert {1, 2, 3, 4, 6, 8, None} <= kept and 11 not in kept
    for _, stage in C.STAGES:
        assert stage(spark, odd_documents(spark).limit(0), FOLDER).count() == 0
