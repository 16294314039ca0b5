import zlib
from collections import defaultdict

from lakemart.llm import sharding as S
from tests.llm.corpus import empty_documents, odd_documents


def test_differencing_is_near_even():
    import random

    rng = random.Random(1)
    weights = [rng.randrange(1, 5000) for _ in range(400)]
    placed = S.combine([[w] + [0] * 7 for w in weights])
    sums = defaultdict(int)
    for w, p in zip(weights, placed):
        assert sorted(p) == list(range(8))
        sums[p[0]] += w
    assert max(sums.values()) - min(sums.values()) <= 10


def check(docs, rows):
    want = sorted((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in docs.collect())
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in rows) == sorted(
        (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in want
    )
    slots, shard_of = defaultdict(list), {}
    for r in rows:
        slots[r.shard].append(r.slot)
        assert shard_of.setdefault((r.size, r.text_crc32), r.shard) == r.shard
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_rows_and_empty_table(spark):
    docs = odd_documents(spark)
    check(docs, S.shard_documents(docs).collect())
    assert S.shard_documents(empty_documents(spark)).count() == 0


def test_many_tasks_fill_up_heavy_groups(spark):
    rows = [(i, f"{i} " * (1 + i % 17)) for i in range(3000)] + [(9000 + i, "heavy " * 300) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = S.shard_documents(docs, per_task=300).collect()
    check(docs, found)
    sums = defaultdict(int)
    for r in found:
        sums[r.shard] += r.size
    assert len(sums) == 16 and max(sums.values()) - min(sums.values()) < 200
