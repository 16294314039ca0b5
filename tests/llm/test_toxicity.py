import random
import zlib

from lakemart.llm import toxicity as X
from tests.llm.corpus import empty_documents, odd_documents, words

RUDE = ["zorgle", "blixnak", "vroompf"]


def corpus(spark, n=900):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        text = words(rng, rng.randrange(5, 200), 60).split()
        bad = i % 7 == 0
        if bad:
            for _ in range(rng.randrange(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(RUDE))
        rows.append((i, " ".join(text)))
        if i % 3:
            labels.append((i, 1, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus(spark)
    found = X.score_toxicity(docs, labels, keep=["doc_id"]).collect()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    wrong = [r.doc_id for r in found if r.held_out and r.predicted != int(r.doc_id % 7 == 0)]
    assert len(wrong) <= 3


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = corpus(spark, 400)
    turned = labels.withColumn("toxic", X.F.when(X.remainder() == 2, 1 - X.F.col("toxic")).otherwise(X.F.col("toxic")))
    plain = {r.doc_id: r.score for r in X.score_toxicity(docs, labels).collect()}
    again = {r.doc_id: r.score for r in X.score_toxicity(docs, turned).collect()}
    assert all(abs(plain[i] - again[i]) < 1e-9 for i in plain)


def test_odd_rows(spark):
    docs, labels = corpus(spark, 300)
    odd = odd_documents(spark)
    more = labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, 1, None), (4, 0, 5), (4, 0, 0), (4, 0, 1)], labels.schema))
    both = docs.unionByName(odd, allowMissingColumns=True)
    found = X.score_toxicity(both, more)
    assert found.columns.count("score") == 1 and "license" in found.columns
    rows = found.collect()
    assert len(rows) == both.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(not r.held_out for r in rows if r.doc_id is None)
    assert X.score_toxicity(empty_documents(spark), labels).count() == 0
    unlabelled = X.score_toxicity(odd, labels.limit(0)).collect()
    assert len(unlabelled) == odd.count() and {r.score for r in unlabelled} == {0.0}


def test_slots_see_only_the_word():
    a, _ = X.grams("idiot")
    _, one = X.grams("an IDIOT!")
    _, two = X.grams("idiot")
    assert len(a) == 1 and one["gram"][-6:].tolist() == two["gram"].tolist()
    assert X.features(None, (None, None)) == [0.0] * (X.TOP_WORDS + 2)
