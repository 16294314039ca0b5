"""Best-fit packing of token sequences by large-item matching.

Tokens are counted in tasks; what is planned centrally is only the histogram of
piece lengths, which has one entry for each length up to the capacity whatever
the number of documents.  A plan line says where a range of equally long pieces
goes, and each piece finds its place by its number among those of its length.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import gapless, resident, stored

CAPACITY = 4096
END_OF_TEXT = 1
#: Encoded strings that a worker remembers, texts that it takes apart at once, and
#: strings that it encodes at once.
REMEMBERED, TOGETHER, WORDS_TOGETHER = 600_000, 100, 2_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# strings of plain letters; signs (no apostrophe) behind a plain letter or a digit;
# and a single stop or comma between a plain letter or digit and white space
_PLAIN = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿ]+")
_SIGNS = re.compile(r"(.*[a-zA-ZÀ-ÖØ-öø-ÿ0-9])([!-&(-/:-@\[-`{-~]+)", re.S)
_STOP = re.compile(rb"(?<=[a-z0-9])([.,])(?=[ \t-\r]|\Z)")


class Encoder:
    """Token ids of whole texts as little-endian 32-bit numbers.

    The vocabulary drops white space and case and never joins what white space or
    a change from letters to signs parts, so a text is encoded string by string
    and each distinct string only once.
    """

    def __init__(self, path: str):
        # a task has one core
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True

    def _encode(self, strings: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _encode_words(self, strings: list[str]) -> dict[str, bytes]:
        """Ids of each string; strings of plain letters are one word each, so all
        of them are encoded at once and parted after each token that ends a word."""
        found: dict[str, bytes] = {}
        plain = [s for s in strings if _PLAIN.fullmatch(s)]
        others = [s for s in strings if not _PLAIN.fullmatch(s)]
        for at in range(0, len(plain), WORDS_TOGETHER):
            part = plain[at : at + WORDS_TOGETHER]
            ids = np.frombuffer(self._encode([" ".join(part)])[0], "<u4")
            ends = 4 * (np.flatnonzero(self.last[ids]) + 1)
            if len(ends) == len(part):
                raw = ids.tobytes()
                found.update(zip(part, (raw[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist()))))
            else:
                others += part
        for at in range(0, len(others), WORDS_TOGETHER):
            part = others[at : at + WORDS_TOGETHER]
            found.update(zip(part, self._encode(part)))
        return found

    def _learn(self, new: set[bytes]) -> None:
        known, cuts = self.known, {}
        for s in new:
            text = s.decode()
            cut = None if "<|" in text else _SIGNS.fullmatch(text)
            cuts[s] = cut.groups() if cut else (text, "")
        found = self._encode_words(list({t for pair in cuts.values() for t in pair if t}))
        found[""] = b""
        for s, (stem, signs) in cuts.items():
            known[s] = found[stem] + found[signs]

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        known = self.known
        for at in range(0, len(texts), TOGETHER):
            parts = []
            for text in texts[at : at + TOGETHER]:
                raw = text.encode()
                # a special token is one only in lower case, so such a text stays as it is
                parts.append((raw if b"<|" in raw else _STOP.sub(rb" \1 ", raw.lower())).split())
            if len(known) > REMEMBERED:
                known.clear()
            self._learn({s for p in parts for s in p if s not in known})
            for p in parts:
                yield b"".join([known[s] for s in p])


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END_OF_TEXT) -> DataFrame:
    """Each document's ids and the end id, cut after every `capacity` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = np.array([end], "<u4").tobytes()
        for batch in batches:
            out = defaultdict(list)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            encoder = resident(("encoder", tokenizer), lambda: Encoder(tokenizer))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.ids(texts)):
                ids += mark
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    for name, value in zip(("doc_id", "piece", "start", "length", "ids_crc32"), (doc_id, n, at // 4, len(cut) // 4, zlib.crc32(cut))):
                        out[name].append(value)
            types = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in types.items()], names=list(types))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


class _Gaps:
    """Runs of sequences by the room left in them, tightest first."""

    def __init__(self, capacity: int):
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.rooms: list[int] = []
        self.capacity = capacity

    def put(self, room: int, first: int, count: int) -> None:
        if count and room:
            if not self.runs[room]:
                bisect.insort(self.rooms, room)
            self.runs[room].append((first, count))

    def take(self, least: int) -> tuple[int, int, int] | None:
        """A run with the smallest room of at least `least`."""
        at = bisect.bisect_left(self.rooms, least)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, count = self.runs[room].pop()
        if not self.runs[room]:
            self.rooms.pop(at)
        return room, first, count


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Lines (length, first rank, pieces, first sequence, pieces a sequence, offset).

    Pieces above a third of the capacity are matched first: from the longest on,
    each run of them takes the longest that still fits beside it, at most two in
    a sequence.  All others then go, longest first, where they leave least room.
    """
    lines = []
    gaps = _Gaps(capacity)
    left = {n: c for n, c in histogram.items() if c}
    used: dict[int, int] = defaultdict(int)
    sequences = 0

    def place(length: int, count: int, first: int, each: int, room: int) -> None:
        lines.append((length, used[length], count, first, each, capacity - room))
        used[length] += count
        left[length] -= count

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            partner = next((m for m in large if m <= capacity - n and left[m] > (m == n)), None)
            count = left[n] if partner is None else left[n] // 2 if partner == n else min(left[n], left[partner])
            first, room = sequences, capacity - n
            sequences += count
            place(n, count, first, 1, capacity)
            if partner is not None:
                place(partner, count, first, 1, room)
                room -= partner
            gaps.put(room, first, count)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            room, first, count = gaps.take(n) or (capacity, sequences, -(-left[n] // (capacity // n)))
            if room == capacity:
                sequences += count
            each = room // n
            full = min(count, left[n] // each)
            if full:
                place(n, full * each, first, each, room)
                gaps.put(room - each * n, first, full)
            if full < count:
                rest = left[n]
                if rest:
                    place(n, rest, first + full, rest, room)
                    gaps.put(room - rest * n, first + full, 1)
                    full += 1
                gaps.put(room, first + full, count - full)
    return lines


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END_OF_TEXT) -> DataFrame:
    """Pack all documents into sequences of at most `capacity` tokens.

    A null text counts as empty and is the end id alone; every row of a repeated
    document is packed; an empty table gives no rows; other columns are not read.
    Only documents of more than `capacity` tokens are cut.
    """
    cut = stored(pieces(docs, tokenizer, capacity, end), "pieces")
    # at most `capacity` rows
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    by_length: dict[int, list] = defaultdict(list)
    for line in plan(histogram, capacity):
        by_length[line[0]].append(line[1:])
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast({n: np.array(x, np.int64) for n, x in by_length.items()})
    ranked = gapless(cut, ["length"], ["doc_id", "piece", "ids_crc32"], "_rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            for n in np.unique(length).tolist():
                own = np.flatnonzero(length == n)
                lines = table.value[n]
                line = lines[np.searchsorted(lines[:, 0], rank[own], side="right") - 1]
                within = rank[own] - line[:, 0]
                sequence[own] = line[:, 2] + within // line[:, 3]
                offset[own] = line[:, 4] + within % line[:, 3] * n
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, PIECES + ", sequence_id long, offset long")
