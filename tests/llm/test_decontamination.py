import hashlib
import random
import re

import pytest

from lakemart.llm import decontamination as D
from tests.llm.corpus import empty_documents, odd_documents

LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(doc, items, window=13):
    found = WORD.findall((doc or "").translate(LOW))
    hit, names = set(), set()
    for name, text in items:
        item = WORD.findall(text.translate(LOW))
        for k in range(max(0, len(item) - window) + 1 if item else 0):
            part = item[k : k + window]
            for i in range(len(found) - len(part) + 1):
                if found[i : i + len(part)] == part:
                    hit.update(range(i, i + len(part)))
                    names.add(name)
    return len(found), len(hit), names


@pytest.mark.parametrize("seed", range(8))
def test_automaton_against_brute_force(seed):
    rng = random.Random(seed)
    make = lambda n: " ".join(rng.choice("a b c é D".split()) for _ in range(n))
    items = [(str(i), make(rng.randrange(0, 9))) for i in range(12)]
    items.append(("copy", items[3][1]))
    automaton = D.build([(i, D.words(t)) for i, t in items], 4)
    for _ in range(40):
        doc = make(rng.randrange(0, 60)) + rng.choice(["", "; unknown, " + make(9)])
        spans, names = D.hits(automaton, D.words(doc))
        n, hit, want = plain(doc, items, 4)
        assert (len(D.words(doc)), sum(e - s for s, e in spans), names) == (n, hit, want)


def test_several_automata_and_odd_rows(spark):
    docs = odd_documents(spark)
    text = {r.doc_id: r.text for r in docs.collect()}
    items = [(1, " ".join(text[1].split()[5:30])), (2, text[10]), (3, None), (None, text[9]), (4, ""), (5, "ÜNÏ ünï")]
    benchmark = spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, doc_id int")
    known = [(str(i), t) for i, t in items if i is not None and t]
    for limit in (1_000_000, 5):
        rows = D.find_contamination(docs, benchmark, keep=["doc_id", "text"], words_per_automaton=limit).collect()
        assert len(rows) == docs.count()
        for r in rows:
            n, hit, names = plain(r.text, known)
            digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n, hit, len(names), digest)
            assert r.contaminated == (hit > 0 and 20 * hit >= n)


def test_removal_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "keep this A b c D end"), (2, "a b " + "z " * 50 + "c d a b c d"), (3, None)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    cleaned = {r.doc_id: r.text for r in D.remove_spans(D.find_contamination(docs, benchmark), longest=3).collect()}
    assert cleaned[1] == "keep this  end" and cleaned[3] is None and cleaned[2].endswith("c d ")
    assert D.find_contamination(empty_documents(spark), benchmark).count() == 0
    clean = D.find_contamination(docs, benchmark.limit(0)).collect()
    assert [r.n_hit for r in clean] == [0, 0, 0]
