"""Benchmark decontamination with a generalised suffix automaton.

The words of the benchmark items become one automaton.  Training documents are
streamed through it word by word; the state and the length of the longest match
that ends at a word tell which windows of the benchmark occur there.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import per_batch

WINDOW = 13
#: A document is contaminated once at least one in so many of its words is hit.
HIT_SHARE = 20
#: Words of benchmark items in one automaton; more items make more automata,
#: and each is sent to the workers by itself.
WORDS_PER_AUTOMATON = 200_000

# every byte that is not part of a word becomes a blank, A-Z become a-z
_WORD_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_WORD = re.compile(rb"[^ ]+")

RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, hit_spans array<struct<start:int,end:int>>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


@dataclass
class Automaton:
    """A generalised suffix automaton over word numbers."""

    vocabulary: dict[bytes, int]
    follow: list[dict[int, int]]
    link: list[int]
    length: list[int]
    window_state: list[int]  # ancestor that holds the last `window` words, or 0
    whole_state: list[int]  # nearest ancestor (or itself) that is a whole short item, or 0
    items: dict[int, list[str]]  # item ids by such a state
    window: int
    shortest: int


def build(items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> Automaton:
    """The automaton of all items; items without words add nothing."""
    vocabulary: dict[bytes, int] = {}
    follow: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def state(edges: dict[int, int], up: int, long: int) -> int:
        follow.append(edges)
        link.append(up)
        length.append(long)
        return len(follow) - 1

    def split(parent: int, symbol: int, old: int) -> int:
        """The part of `old` that is reached over `parent` becomes a state of its own."""
        new = state(dict(follow[old]), link[old], length[parent] + 1)
        link[old] = new
        while parent >= 0 and follow[parent].get(symbol) == old:
            follow[parent][symbol] = new
            parent = link[parent]
        return new

    def extend(last: int, symbol: int) -> int:
        known = follow[last].get(symbol)
        if known is not None:
            return known if length[known] == length[last] + 1 else split(last, symbol, known)
        new, up = state({}, 0, length[last] + 1), last
        while up >= 0 and symbol not in follow[up]:
            follow[up][symbol] = new
            up = link[up]
        if up >= 0:
            target = follow[up][symbol]
            link[new] = target if length[target] == length[up] + 1 else split(up, symbol, target)
        return new

    numbered = []
    for item_id, item_words in items:
        if item_words:
            numbers = [vocabulary.setdefault(w, len(vocabulary)) for w in item_words]
            numbered.append((item_id, numbers))
            last = 0
            for n in numbers:
                last = extend(last, n)

    window_state, whole_state = [0] * len(follow), [0] * len(follow)
    for s in sorted(range(1, len(follow)), key=length.__getitem__):
        if length[s] >= window:
            window_state[s] = s if length[link[s]] < window else window_state[link[s]]
    owners: dict[int, set[str]] = {}
    whole = set()
    for item_id, numbers in numbered:
        at = 0
        for i, n in enumerate(numbers):
            at = follow[at][n]
            if i + 1 >= window:
                owners.setdefault(window_state[at], set()).add(item_id)
        if len(numbers) < window:
            owners.setdefault(at, set()).add(item_id)
            whole.add(at)
    for s in sorted(range(1, len(follow)), key=length.__getitem__):
        whole_state[s] = s if s in whole else whole_state[link[s]]
    return Automaton(
        vocabulary, follow, link, length, window_state, whole_state, {s: sorted(x) for s, x in owners.items()}, window,
        min([window, *(len(n) for _, n in numbered)]),
    )


def hits(automaton: Automaton, document: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged spans [start, end) of hit words, and the items found."""
    a = automaton
    if not a.vocabulary or len(document) < a.shortest:
        return [], set()
    get = a.vocabulary.get
    numbers = np.fromiter((get(w, -1) for w in document), np.int32, len(document))
    # a word that no item holds ends every match, so only runs of known words are streamed
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (numbers >= 0).view(np.int8), [0]))))
    spans: list[list[int]] = []
    found: set[int] = set()
    follow, link, length, window = a.follow, a.link, a.length, a.window

    def cover(start: int, end: int) -> None:
        while spans and spans[-1][0] >= start:
            spans.pop()
        if spans and spans[-1][1] >= start:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])

    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if end - start < a.shortest:
            continue
        at = matched = 0
        for i, n in enumerate(numbers[start:end].tolist(), start):
            while at and n not in follow[at]:
                at = link[at]
                matched = length[at]
            if n in follow[at]:
                at = follow[at][n]
                matched += 1
            if matched >= window:
                found.add(a.window_state[at])
                cover(i + 1 - window, i + 1)
            short = a.whole_state[at]
            while short:
                if matched >= length[short]:
                    found.add(short)
                    cover(i + 1 - length[short], i + 1)
                short = a.whole_state[link[short]]
    return [(s, e) for s, e in spans], {item for s in found for item in a.items[s]}


def _automata(benchmark: DataFrame, window: int, words_per_automaton: int) -> list:
    """One broadcast automaton for each part of the benchmark that fits the limit.

    The parts are dealt by a hash of the item and read one by one, so the driver
    never holds more than about one limit of words at once.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.size(F.split("text", "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+")))).first()[0] or 0
    parts = max(1, -(-size // words_per_automaton))
    out = []
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).toLocalIterator()
        out.append(spark.sparkContext.broadcast(build([(r.item_id, words(r.text)) for r in rows], window)))
    return out


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, window: int = WINDOW, hit_share: int = HIT_SHARE, words_per_automaton: int = WORDS_PER_AUTOMATON
) -> DataFrame:
    """Add to each document how much of it stands in the benchmark.

    A window is `window` consecutive words of an item, or a whole shorter item.
    Words inside any occurrence of a window are hit.  `hit_spans` holds the hit
    words as ranges of word numbers.  Null or empty texts have no words and are
    clean; benchmark rows without id or text are no items; equal items count
    each; an empty benchmark leaves every document clean.  Columns of `docs`
    that have the name of a result are replaced.
    """
    automata = _automata(benchmark, window, words_per_automaton)

    def scan(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {n: [] for n in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans")}
        for text in batch.column("text").to_pylist():
            document = words(text)
            spans: list[tuple[int, int]] = []
            items: set[str] = set()
            for automaton in automata:
                s, i = hits(automaton.value, document)
                spans += s
                items |= i
            merged: list[list[int]] = []
            for s, e in sorted(spans):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            hit = sum(e - s for s, e in merged)
            out["n_words"].append(len(document))
            out["n_hit"].append(hit)
            out["n_items"].append(len(items))
            out["items_sha256"].append(hashlib.sha256(",".join(sorted(items)).encode()).hexdigest())
            out["contaminated"].append(hit > 0 and hit_share * hit >= len(document))
            out["hit_spans"].append([{"start": s, "end": e} for s, e in merged])
        return out

    return per_batch(docs, scan, RESULT, keep)


def remove_spans(found: DataFrame, longest: int = 50, hit_share: int = HIT_SHARE) -> DataFrame:
    """Cut hit spans out of texts that exceed a limit: spans of over `longest`
    words, and every span of a contaminated document.  Other texts stay as they
    are; a null text stays null."""

    def cut(batch: pa.RecordBatch) -> dict:
        out = []
        for text, spans, bad in zip(*(batch.column(c).to_pylist() for c in ("text", "hit_spans", "contaminated"))):
            spans = [s for s in spans or [] if bad or s["end"] - s["start"] > longest]
            if spans:
                raw = text.encode("utf-8", "surrogatepass")
                places = [m.span() for m in _WORD.finditer(raw.translate(_WORD_BYTES))]
                kept, at = [], 0
                for s in spans:
                    kept.append(raw[at : places[s["start"]][0]])
                    at = places[s["end"] - 1][1]
                text = b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")
            out.append(text)
        return {"text": out}

    return per_batch(found, cut, "text string")
