import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakemart.llm import packing as P
from tests.llm.corpus import empty_documents, odd_documents

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = 60
    histogram = {n: rng.randrange(0, 40) for n in range(1, capacity + 1)}
    lines = P.plan(histogram, capacity)
    bins, ranks, large = defaultdict(list), defaultdict(list), defaultdict(int)
    for length, first, count, sequence, each, offset in lines:
        ranks[length].append((first, count))
        for i in range(count):
            bins[sequence + i // each].append((offset + i % each * length, length))
            large[sequence + i // each] += 3 * length > capacity
    for n, parts in ranks.items():
        at = 0
        for first, count in parts:
            assert first == at
            at += count
        assert at == histogram[n]
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert max(large.values()) <= 2
    total = sum(n * c for n, c in histogram.items())
    assert len(bins) <= total / capacity * 1.1 + 1


def test_encoder_equals_the_tokenizer():
    plain = Tokenizer.from_file(VOCABULARY)
    texts = ["The cat's, hat.", "", " ", "ÀÉ Σίσυφος. don't I'LL x.y, 12.5 a.b.", "odd\x1cspace\x85here　x", "é ﬁ İstanbul ß", "a" * 3000, "<|endoftext|> A", "..,, . ,"]
    found = P.Encoder(VOCABULARY)
    for _ in range(2):
        got = [np.frombuffer(b, "<u4").tolist() for b in found.ids(texts)]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = P.pack(docs, VOCABULARY, capacity=512).collect()
    plain = Tokenizer.from_file(VOCABULARY)
    want = []
    for r in docs.collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids + [1]
        for n, at in enumerate(range(0, len(ids), 512)):
            part = ids[at : at + 512]
            want.append((r.doc_id or -1, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 512
    assert P.pack(empty_documents(spark), VOCABULARY).count() == 0
