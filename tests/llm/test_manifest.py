import hashlib
import random
import zlib

import numpy as np
import pytest

from lakemart.llm import manifest as M
from tests.llm.corpus import empty_documents, odd_documents


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [None if v is None else str(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def climb(digests):
    """Levels of a tree, leaves first."""
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def plain(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append(r)
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    number = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]))
    ordered = {t: sorted(trees[t], key=number) for t in names}
    levels = {t: climb([leaf(r, r["text"]) for r in ordered[t]]) for t in names}
    top = climb([levels[t][-1][0] for t in names])
    out = []
    for n, t in enumerate(names):
        for at, r in enumerate(ordered[t]):
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded, siblings = leaf(r, text), ""
            for tree, place in ((levels[t], at), (top, n)):
                for level in tree[:-1]:
                    run = level[place // 8 * 8 : place // 8 * 8 + 8]
                    siblings += "".join(run[: place % 8] + run[place % 8 + 1 :])
                    folded = sha("".join([*run[: place % 8], folded, *run[place % 8 + 1 :]]))
                    place //= 8
            out.append((r["doc_id"], leaf(r, r["text"]), levels[t][-1][0], top[-1][0], sha(siblings), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_addresses_are_the_layout():
    for levels in range(1, 6):
        places = np.concatenate([M.address(levels, d, np.arange(8**d)) for d in range(levels)])
        assert sorted(places) == list(range(M.slots(levels)))
    # four levels of two: the upper half stands first, then each lower tree by itself
    assert [M.address(4, d, np.arange(2**d), 2).tolist() for d in range(4)] == [[0], [1, 2], [3, 6, 9, 12], [4, 5, 7, 8, 10, 11, 13, 14]]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513, 4096])
def test_blocks_hold_every_level(n):
    digests = [sha(str(i)) for i in range(n)]
    levels = climb(digests)
    height = M.steps(n)
    assert height == len(levels) - 1
    nodes = M.build(np.frombuffer(bytes.fromhex("".join(digests)), np.uint8).reshape(-1, 32), height)
    held = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
    for up, level in enumerate(levels):
        assert M.level(held, height, up, 0, len(level)).decode() == "".join(level)
    ways = M.above(nodes, height, n)
    assert all(M.fold(digests[i], ways[i]) == levels[-1][0] for i in range(n))


@pytest.mark.parametrize("height", [1, 2, 4])
def test_against_brute_force(spark, height):
    rng = random.Random(height)
    rows = [(i, f"Text {rng.random()} ÄÖ", "en" if i % 3 else rng.choice(["de", "fr", None, "é", ""]), f"src{i % 4}", i) for i in range(700)]
    # more than eight trees, a tree of one row, nulls, repeated rows and ids
    rows += [(1000 + i, "ABC", f"l{i}", None, None) for i in range(9)]
    rows += [(5, "ABC", "en", "x", 3), (5, "ABC", "en", "x", 3), (5, None, "en", "x", 3), (None, "ABC", "en", "x", 3), (None, "B", None, None, None)]
    rows += [(2000, "", "en", "", 0), (2001, "A" * 300_000, "en", "x", 300_000), (-4, "x", "en", "x", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, M.verify_tampered(df, height).collect()), key=repr)
    assert got == plain([r.asDict() for r in df.collect()])
    assert {r[6] for r in got} == {True, False}


def test_manifest_is_a_table(spark):
    df = spark.createDataFrame([(i, "t", "en" if i % 2 else "de", "s", 1) for i in range(200)], SCHEMA)
    made = M.make_manifest(df, height=1)
    blocks = made.blocks()
    assert blocks.filter("tree = '' AND stage = 0").count() == 1
    # 100 leaves: 13 blocks, 2 blocks of their roots, and one above
    assert [r[0] for r in blocks.filter("tree = '=en'").groupBy("stage").count().orderBy("stage").select("count").collect()] == [13, 2, 1]
    assert made.leaves.count() == 200


def test_odd_and_empty_tables(spark):
    df = odd_documents(spark).selectExpr("*", "if(doc_id = 7, null, 'en') AS lang", "'s' AS source", "cast(null AS long) AS n_chars", "1 AS tree", "2 AS index", "3 AS digest")
    got = sorted(map(tuple, M.verify_tampered(df).collect()), key=repr)
    assert got == plain([r.asDict() for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()])
    none = empty_documents(spark).selectExpr("*", "lang AS source", "doc_id AS n_chars")
    assert M.verify_tampered(none).collect() == [] and M.make_manifest(none).root is None
