"""Toxicity from class-conditional Kneser-Ney language models.

Two models of the letters within words, of toxic and of ordinary documents, are
estimated from labelled rows.  Each interpolates its discounted counts with one
shared lower order, whose continuation counts are gathered from all documents:
a rare expression then weighs the same in both unless its class shows otherwise.
A document is scored by the log-likelihoods that its words and its whole text
have in the two models, normalised by length.

Contexts are counted in slots of a table of fixed size, so that a model has the
same bounded size whatever the corpus; the counts cover all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import per_batch, release, stored
from lakemart.llm.hashing import Prefix, mix

#: Letters (bytes) of context, and slots of the table as a power of 2.
CONTEXT, SLOT_BITS = 4, 20
#: Taken off the continuation counts of the shared order, and off counts of 1, 2
#: and more of a class: what a class shows once says nothing yet.
DISCOUNT = 0.75
CLASS_DISCOUNTS = (1.0, 1.5, 2.0)
THRESHOLD = 0.3
#: Labelled rows to learn from, at most; the first by a hash of the id.
LABELLED_ROWS = 200_000
#: Words whose own ratios count as features of a document.
TOP_WORDS = 3

_U = np.uint64
_LETTER = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A or 0x30 <= b <= 0x39 else 0x20 for b in range(256))
_IS_WORD = np.frombuffer(_LETTER, np.uint8) != 0x20
# what the learning rows count: all rows, and by fold and class of the labelled ones
COUNTS = ["n_all", "n_00", "n_01", "n_10", "n_11"]


def grams(text: str | None) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Start of each word among its letters, and for each letter (and the end of a
    word) the table slots of: it with its context, the context, it with the
    context less one, that shorter context, and it alone."""
    raw = np.frombuffer(b" " + (text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTER) + b" ", np.uint8)
    turns = np.flatnonzero(np.diff(_IS_WORD[raw].view(np.int8))) + 1
    starts, ends = turns[::2], turns[1::2] + 1  # with the blank behind the word
    if not len(starts):
        return starts, {}
    lengths = ends - starts
    first = np.repeat(starts, lengths)
    firsts = np.cumsum(lengths) - lengths
    at = first + np.arange(len(first)) - np.repeat(firsts, lengths)
    prefix = Prefix(raw)

    def slot(back: int, upto: int, seed: int) -> np.ndarray:
        begin = np.maximum(at - back, first)
        # how much of the context lies within the word tells a word's start
        part = prefix.parts(begin, at + upto) * _U(64) + (at - begin).astype(np.uint64) * _U(8) + _U(seed)
        return (mix(part) >> _U(64 - SLOT_BITS)).astype(np.int32)

    return firsts, {
        "gram": slot(CONTEXT, 1, 1), "history": slot(CONTEXT, 0, 2), "low": slot(CONTEXT - 1, 1, 3), "low_history": slot(CONTEXT - 1, 0, 4),
        "letter": raw[at].astype(np.int32),
    }


def _count(docs: DataFrame, ids: np.ndarray, marks: np.ndarray) -> DataFrame:
    """Counts of every slot of letters in context over all documents."""
    spark = docs.sparkSession
    labelled = spark.sparkContext.broadcast((ids, marks))
    names = ["gram", "history", "low", "low_history", "letter", *COUNTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        known, kind = labelled.value
        size = 1 << SLOT_BITS
        counts = np.zeros((len(COUNTS), size), np.int64)
        others = np.zeros((4, size), np.int32)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                _, g = grams(text)
                if not g:
                    continue
                slots, n = np.unique(g["gram"], return_counts=True)
                counts[0][slots] += n
                for k, name in enumerate(names[1:5]):
                    others[k][g["gram"]] = g[name]
                if doc_id is not None and len(known):
                    i = np.searchsorted(known, doc_id)
                    if i < len(known) and known[i] == doc_id:
                        counts[1 + kind[i]][slots] += n
        used = np.flatnonzero(counts[0])
        if len(used):
            columns = [used.astype(np.int32), *(o[used] for o in others), *(c[used] for c in counts)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    schema = ", ".join([f"{n} int" for n in names[:5]] + [f"{n} long" for n in COUNTS])
    parts = docs.select("doc_id", "text").mapInArrow(run, schema)
    return stored(
        parts.groupBy("gram").agg(*[F.min(n).alias(n) for n in names[1:5]], *[F.sum(n).alias(n) for n in COUNTS]), "letters"
    )


def _ratios(counts: DataFrame, toxic: Column, ordinary: Column) -> DataFrame:
    """(gram, history, gram_ratio, history_ratio): log-likelihood as toxic less that as ordinary."""
    # shared lower order: in how many contexts a letter follows, not how often
    kinds = F.count(F.lit(1))
    low = counts.groupBy("low", "low_history", "letter").agg(kinds.alias("cont"))
    over = low.groupBy("low_history").agg(F.sum("cont").alias("cont_all"), kinds.alias("cont_kinds"))
    letters = low.groupBy("letter").agg(F.sum("cont").alias("letter_cont"))
    total = letters.agg(F.sum("letter_cont").alias("letters_all"))
    base = F.col("letter_cont") / F.col("letters_all")
    shared = low.join(over, "low_history").join(F.broadcast(letters), "letter").crossJoin(F.broadcast(total)).select(
        "low", "low_history", "letter",
        (F.greatest(F.col("cont") - DISCOUNT, F.lit(0.0)) / F.col("cont_all") + DISCOUNT * F.col("cont_kinds") / F.col("cont_all") * base).alias("shared"),
    )
    rows = counts.select("gram", "history", "low", "low_history", "letter", toxic.alias("n1"), ordinary.alias("n0"))

    def taken(c: int) -> Column:
        n = F.col(f"n{c}")
        return F.when(n >= 3, CLASS_DISCOUNTS[2]).when(n == 2, CLASS_DISCOUNTS[1]).when(n == 1, CLASS_DISCOUNTS[0]).otherwise(0.0)

    seen = rows.groupBy("history").agg(
        *[F.sum(f"n{c}").alias(f"all{c}") for c in (0, 1)], *[F.sum(taken(c)).alias(f"taken{c}") for c in (0, 1)]
    )

    def rest(c: int) -> Column:
        return F.when(F.col(f"all{c}") > 0, F.col(f"taken{c}") / F.col(f"all{c}")).otherwise(1.0)

    def likelihood(c: int) -> Column:
        own = F.when(F.col(f"all{c}") > 0, (F.col(f"n{c}") - taken(c)) / F.col(f"all{c}")).otherwise(0.0)
        return F.log(own + rest(c) * F.col("shared"))

    return rows.join(seen, "history").join(shared, ["low", "low_history", "letter"]).select(
        "gram", "history", (likelihood(1) - likelihood(0)).alias("gram_ratio"), (F.log(rest(1)) - F.log(rest(0))).alias("history_ratio")
    )


def _table(ratios: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ratios as two arrays over the slots (at most 2^SLOT_BITS rows)."""
    grams_, histories = np.full(1 << SLOT_BITS, np.nan, np.float32), np.zeros(1 << SLOT_BITS, np.float32)
    found = ratios.toArrow()
    grams_[found["gram"].to_numpy()] = found["gram_ratio"].to_numpy()
    histories[found["history"].to_numpy()] = found["history_ratio"].to_numpy()
    return grams_, histories


def features(text: str | None, table: tuple[np.ndarray, np.ndarray]) -> list[float]:
    """Ratio per letter of the whole text, those of the words that are most like
    toxic ones, and the log of the number of words; zeros for a text without words."""
    firsts, g = grams(text)
    if not g:
        return [0.0] * (TOP_WORDS + 2)
    ratio = table[0][g["gram"]]
    ratio = np.where(np.isnan(ratio), table[1][g["history"]], ratio).astype(np.float64)
    words = np.add.reduceat(ratio, firsts)
    top = np.zeros(TOP_WORDS)
    best = np.sort(words)[::-1][:TOP_WORDS]
    top[: len(best)] = best
    return [float(ratio.mean()), *top.tolist(), float(np.log1p(len(firsts)))]


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    weights = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - y) + penalty @ weights
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, gradient)
        weights -= step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def _rate(docs: DataFrame, table: tuple[np.ndarray, np.ndarray], keep: list[str] | None) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batch: pa.RecordBatch) -> dict:
        return {"_features": [features(t, shared.value) for t in batch.column("text").to_pylist()]}

    return per_batch(docs, run, "_features array<double>", keep)


def remainder(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def score_toxicity(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, labelled_rows: int = LABELLED_ROWS) -> DataFrame:
    """Add held_out, score and predicted to each document.

    Learns only from labelled documents whose crc32(doc_id as text) mod 4 is not
    2; labels other than 0 and 1 and rows without an id are ignored, and an id
    that is labelled both ways counts as toxic.  At most `labelled_rows` labels
    are learnt from.  The weights of the features are fitted on documents (mod 4
    is 3) that the models they are measured with have not seen.  Null and empty
    texts get the score that the fitted constant gives; without labels of both
    classes every score is 0.  Repeated rows are scored each; columns of `docs`
    that have the name of a result are replaced; an empty table gives no rows.
    """
    usable = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(remainder() != 2)
    marked = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("toxic").cast("int").alias("toxic"), F.max((remainder() == 3).cast("int")).alias("fold")
    )
    taken = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows).toArrow().sort_by("doc_id")
    ids = taken["doc_id"].to_numpy()
    toxic, fold = taken["toxic"].to_numpy(), taken["fold"].to_numpy()
    held_out = F.coalesce(remainder() == 2, F.lit(False))
    names = ("held_out", "score", "predicted", "_features")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    unknown = docs.select(*kept, held_out.alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    if not {(0, 0), (0, 1), (1, 0), (1, 1)} <= set(zip(fold.tolist(), toxic.tolist())):
        return unknown
    counts = _count(docs, ids, 2 * fold + toxic)
    column = F.col
    table = _table(_ratios(counts, column("n_01"), column("n_00")))
    learnt = docs.select("doc_id", "text").filter(remainder() == 3)
    known = docs.sparkSession.sparkContext.broadcast(ids[fold == 1])

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array(np.isin(np.array([-1 if x is None else x for x in batch.column("doc_id").to_pylist()]), known.value))
            yield batch.filter(own)

    rated = _rate(learnt.mapInArrow(labelled, learnt.schema), table, ["doc_id"]).toArrow()
    x = np.array(rated["_features"].to_pylist(), np.float64).reshape(-1, TOP_WORDS + 2)
    y = toxic[np.searchsorted(ids, rated["doc_id"].to_numpy())]
    if len(set(y.tolist())) < 2:
        return unknown
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights = _fit((x - middle) / spread, y.astype(np.float64))
    table = _table(_ratios(counts, column("n_01") + column("n_11"), column("n_00") + column("n_10")))
    found = _rate(docs, table, kept)
    linear = F.lit(float(weights[-1]))
    for k in range(TOP_WORDS + 2):
        linear = linear + (column("_features")[k] - float(middle[k])) * float(weights[k] / spread[k])
    score = 1 / (1 + F.exp(-linear))
    return found.withColumns({"held_out": held_out if keep is None or "doc_id" in keep else F.lit(None).cast("boolean"), "score": score}).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    ).drop("_features")
