"""Line dedup by pairwise alignment.

A document is paired with the earlier documents that first hold its lines or its
runs of lines, found through hashes that both share.  A run starts at a short line
and ends with the line that makes it as long as a block; a longer line is a run by
itself.  Each pair is aligned with a patience diff of what it shares, and common
blocks of the alignment are deleted from the later document, however many
documents hold them.  Blocks that moved, which the pair shares against the order of
its alignment, are deleted after it: so a document that copies a reordered copy
loses all its lines although it is aligned with the first holder.

A line that repeats within a document is told apart by its count there, so every
line is unique in its document, as patience diff needs; so is a run.  Each line and
each run of a document is matched with its first holder only: a group of any size
gives one match for each line and run, never all its pairs.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import per_batch, stored

#: Words that an aligned block needs to be deleted.
BLOCK_WORDS = 8


def patience(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of matches (later, earlier) that rises in both documents.

    Each line of either document stands in one match at most.
    """
    tops: list[int] = []
    top_of: list[int] = []
    back: list[int] = []
    # of the matches of one later line, the last in the earlier document comes first
    pairs = sorted(pairs, key=lambda p: (p[0], -p[1]))
    for i, (_, earlier) in enumerate(pairs):
        pile = bisect.bisect_left(tops, earlier)
        back.append(top_of[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(earlier)
            top_of.append(i)
        else:
            tops[pile] = earlier
            top_of[pile] = i
    out = []
    at = top_of[-1] if top_of else -1
    while at >= 0:
        out.append(pairs[at])
        at = back[at]
    return out[::-1]


def blocks(aligned: list[tuple[int, int]], words: dict[int, int], least: int = BLOCK_WORDS) -> list[int]:
    """Lines of the later document in aligned blocks of at least `least` words; a
    block is a run of lines that follow each other in both documents."""
    out: list[int] = []
    run: list[int] = []
    last = None
    for later, earlier in [*aligned, (-2, -2)]:
        if last is not None and (later, earlier) != (last[0] + 1, last[1] + 1):
            if sum(words[n] for n in run) >= least:
                out += run
            run = []
        run.append(later)
        last = (later, earlier)
    return out


def _stretches(matches: set[tuple[int, int]], words: dict[int, int], least: int) -> set[tuple[int, int]]:
    """The matches in stretches, lines that follow each other in both documents, of at least `least` words."""
    out: set[tuple[int, int]] = set()
    for later, earlier in matches:
        if (later - 1, earlier - 1) not in matches:
            n = 1
            while (later + n, earlier + n) in matches:
                n += 1
            if sum(words[later + k] for k in range(n)) >= least:
                out.update((later + k, earlier + k) for k in range(n))
    return out


def common_blocks(matches: set[tuple[int, int]], words: dict[int, int], least: int = BLOCK_WORDS) -> set[int]:
    """Lines of the later document in blocks of the alignment, and in blocks that
    moved: stretches of the lines that are left."""
    matches = _stretches(matches, words, least)
    out = set(blocks(patience(list(matches)), words, least))
    moved = _stretches({m for m in matches if m[0] not in out}, words, least)
    return out.union(later for later, _ in moved)


def _lines(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(line, check, doc, at, words, hash, sum, near): every line but blank ones; `line` and `check`, hashes of 96 bits in all,
    tell a text and its count in the document, `near` whether it is shorter than a block or follows such a line, so that it can be part of a run."""
    text = F.translate(F.col("value"), "\t\r", "  ")
    rows = docs.select("_line_row", F.posexplode(F.split("text", "\n")).alias("at", "value")).select(
        F.col("_line_row").alias("doc"), "at", F.trim(F.regexp_replace(text, " +", " ")).alias("value")
    ).filter("value <> ''")
    rows = rows.select("doc", "at", F.xxhash64("value", F.length("value")).alias("hash"), F.hash("value").alias("sum"), (F.size(F.split("value", " "))).alias("words"))
    order = Window.partitionBy("doc").orderBy("at")
    follows = (F.lag("words").over(order) < block_words) & (F.lag("at").over(order) == F.col("at") - 1)
    again = F.row_number().over(Window.partitionBy("doc", "hash").orderBy("at"))
    rows = rows.withColumn("near", (F.col("words") < block_words) | F.coalesce(follows, F.lit(False))).withColumn("again", again)
    return rows.select(F.xxhash64("hash", "again").alias("line"), F.hash("sum", "again").alias("check"), "doc", "at", "words", "hash", "sum", "near")


def _runs(lines: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(line, check, doc, at, words) of the runs: from a line shorter than a block, the lines
    that follow without a blank one until they are a block; `words` has one number
    for each of them."""
    ahead = Window.partitionBy("doc").orderBy("at").rowsBetween(0, block_words - 1)
    rows = lines.filter("near").withColumn("ahead", F.collect_list(F.struct("at", "hash", "sum", "words")).over(ahead))

    def longer(run: Column, x: Column) -> Column:
        hashes = F.xxhash64(run["hash"], x["hash"]).alias("hash"), F.hash(run["sum"], x["sum"]).alias("sum")
        grown = F.struct((run["n"] + 1).alias("n"), (run["words"] + x["words"]).alias("words"), *hashes)
        return F.when((run["words"] < block_words) & (x["at"] == F.col("at") + run["n"]), grown).otherwise(run)

    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("words"), F.lit(0).cast("long").alias("hash"), F.lit(0).alias("sum"))
    rows = rows.filter(F.col("words") < block_words).withColumn("run", F.aggregate("ahead", start, longer)).filter(F.col("run.words") >= block_words)
    rows = rows.select("doc", "at", F.col("run.hash").alias("hash"), F.col("run.sum").alias("sum"), F.slice(F.col("ahead.words"), F.lit(1), F.col("run.n")).alias("words"))
    again = F.row_number().over(Window.partitionBy("doc", "hash").orderBy("at"))
    return rows.withColumn("again", again).select(F.xxhash64("hash", "again").alias("line"), F.hash("sum", "again").alias("check"), "doc", "at", "words")


def _owned(lines: DataFrame) -> DataFrame:
    """(owner, doc, at, owner_at, words) of all but the first holder of each line."""
    first = lines.groupBy("line", "check").agg(F.min(F.struct("doc", "at")).alias("first"), F.count(F.lit(1)).alias("held")).filter("held > 1")
    # stored, so that both sides of the join are plain and a frequent line is split over tasks
    first = stored(first.select("line", "check", F.col("first.doc").alias("owner"), F.col("first.at").alias("owner_at")), "first")
    return lines.join(first, ["line", "check"]).filter("doc <> owner").select("owner", "doc", "at", "owner_at", "words")


def find_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc, lines): the numbers of the lines to delete from each document, in
    order of `_line_row`, a distinct number of each row of `docs`."""
    lines = stored(_lines(docs, block_words), "lines")
    runs = stored(_runs(lines, block_words), "runs")
    inside = _owned(runs).select("owner", "doc", "at", "owner_at", F.posexplode("words").alias("k", "w"))
    inside = inside.select("owner", "doc", (F.col("at") + F.col("k")).alias("at"), (F.col("owner_at") + F.col("k")).alias("owner_at"), F.col("w").alias("words"))
    matches = _owned(lines).unionByName(inside)
    pairs = matches.groupBy("owner", "doc").agg(F.sum("words").alias("words"), F.collect_list(F.struct("at", "owner_at", "words")).alias("matches"))
    # no block without its words
    pairs = pairs.filter(F.col("words") >= block_words)

    def align(batch: pa.RecordBatch) -> dict:
        out = []
        found = batch.column("matches")
        ends, found = found.offsets.to_numpy(), found.values
        at, owner_at, words = (found.field(n).to_numpy() for n in ("at", "owner_at", "words"))
        for i, j in zip(ends, ends[1:]):  # one pair at a time: a list of all matches as objects is large
            later = at[i:j].tolist()
            out.append(sorted(common_blocks(set(zip(later, owner_at[i:j].tolist())), dict(zip(later, words[i:j].tolist())), block_words)))
        return {"lines": out}

    deleted = per_batch(pairs, align, "lines array<int>", ["doc"]).filter(F.size("lines") > 0)
    return deleted.groupBy("doc").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("lines")))).alias("lines"))


def _cut(text: str | None, lines: list[int] | None) -> str | None:
    if not lines:
        return text
    gone = np.zeros(max(lines) + 1, bool)
    gone[lines] = True
    return "\n".join(line for k, line in enumerate(text.split("\n")) if k >= len(gone) or not gone[k])


def remove_lines(docs: DataFrame, keep: list[str] | None = None, **limits: int) -> DataFrame:
    """`docs` with the lines deleted that align with an earlier document.

    Earlier means a smaller doc_id; rows that repeat an id are earlier and later
    by their text, then by any other order.  A row without an id is neither
    aligned nor an earlier document.  Null and empty texts have no lines; lines
    are compared with white space runs as one blank, and blank lines stay.  All
    decisions are made on the texts as given, and the first holder of a line
    always keeps it.  A document of any length is aligned whole; an empty table
    gives no rows.  Adds n_lines and n_removed; a column of that name is replaced.
    """
    names = ("n_lines", "n_removed")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    rows = docs.select(*kept, *[c for c in ("doc_id", "text") if c not in kept])
    numbered = _numbered(rows)
    found = find_blocks(numbered.filter("_line_row IS NOT NULL").select("_line_row", "text"), **limits)
    joined = numbered.join(found.select(F.col("doc").alias("_line_row"), F.col("lines").alias("_line_cut")), "_line_row", "left")

    def run(batch: pa.RecordBatch) -> dict:
        texts, lines = batch.column("text").to_pylist(), batch.column("_line_cut").to_pylist()
        return {
            "text": [_cut(t, n) for t, n in zip(texts, lines)],
            "n_lines": [len(t.split("\n")) if t else 0 for t in texts],
            "n_removed": [len(n or []) for n in lines],
        }

    cut = per_batch(joined, run, "text string, n_lines int, n_removed int", [c for c in joined.columns if c in kept])
    return cut.select(*kept, *[c for c in ("text", "n_lines", "n_removed") if c not in kept])


def _numbered(rows: DataFrame) -> DataFrame:
    """`rows` with a distinct number `_line_row` that rises with doc_id.

    Ids that do not repeat are their own numbers.  Only if some do, all rows are
    numbered anew, in order within and across range partitions.
    """
    repeated = rows.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not repeated.limit(1).count():
        return rows.withColumn("_line_row", F.col("doc_id").cast("long"))
    known = rows.filter("doc_id IS NOT NULL").repartitionByRange("doc_id", "text").sortWithinPartitions("doc_id", "text")
    numbered = stored(known.withColumn("_line_row", F.monotonically_increasing_id()), "numbered")
    return numbered.unionByName(rows.filter("doc_id IS NULL").withColumn("_line_row", F.lit(None).cast("long")))
