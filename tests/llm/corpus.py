"""Small corpora for the operators' tests."""

from __future__ import annotations

import random

CLASH = ("score", "kept", "n_words", "shard", "lines", "_row", "license", "text_crc32", "first", "version", "size", "hash")


def words(rng: random.Random, n: int, kinds: int = 400) -> str:
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


def odd_documents(spark, **more):
    """Rows with nulls, empty, blank, long and repeated texts, and clashing columns."""
    rng = random.Random(5)
    base = words(rng, 120)
    rows = [
        (1, base), (2, None), (3, ""), (4, " \n\t "), (5, base), (5, base), (None, base), (None, None), (6, "ünï ☃ 𝄞 " * 60),
        (7, words(rng, 30_000)), (8, "a" * 50_000), (9, base + " tail"), (10, "one"), (11, "one"), (12, "\n".join([base, base, "x"])), (5, "another text"),
    ]
    schema = "doc_id long, text string, " + ", ".join(f"{c} int" for c in CLASH)
    return spark.createDataFrame([(*r, *range(len(CLASH))) for r in rows], schema)


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
