"""Near-duplicate documents with an LSH forest over MinHash signatures.

Each tree is one order of the signature.  Documents that share a tree's first
positions form a region; inside it they are sorted by the following positions.
A crowded region is cut deeper, each part by as much more of the order as it
needs.  Candidates are neighbours in a sorted order and, in every region, each
document with the region's hub, the member that meets most others in all trees:
copies of one text are often nearer to it than to each other.  Candidates are
confirmed on the full shingle sets.  What links have not joined by then is
compared with all it meets in uncrowded parts and with leading members of crowded
ones; last, all members of a crowded region that are still apart are compared.
Pairs that sizes, parity bits or shingles of one member alone rule out are not
made: these are exact bounds, so no link is lost by them.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import per_batch, stored
from lakemart.llm.hashing import Prefix, mix, signed

SHINGLE = 4
#: A link needs 100 * |A and B| >= LEAST * |A or B|.
LEAST = 80
TREES = 30
#: Signature positions that make a region, and further ones where it is crowded.
DEPTH, DEEPER = 4, (6, 9, 13, 18)
CROWDED = 24
#: Words of a set's parity bits: each shingle flips one bit, so two sets differ by at
#: least as many shingles as their bits do.
PARITY_WORDS = 16
#: Members of a part of over 3 * CROWDED that unjoined documents are compared with
#: before all that are still apart.
LEADERS = 4

_U = np.uint64
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(9, 14)]] = True


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_BLANK[raw]
    turns = np.flatnonzero(np.diff(inside))
    if not len(turns):
        return np.zeros(0, np.uint64)
    word = mix(Prefix(raw).parts(turns[::2], turns[1::2]))
    width = min(size, len(word))
    out = np.full(len(word) - width + 1, width, np.uint64)
    for k in range(width):
        out = mix(out * _U(0x100000001B3) + word[k : k + len(out)])
    return np.unique(out)


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = mix(np.arange(1, 2 * count + 1, dtype=np.uint64))
    return (draw[:count] >> _U(32)).astype(np.uint32) | np.uint32(1), (draw[count:] >> _U(32)).astype(np.uint32)


def _signature(found: np.ndarray, times: np.ndarray, plus: np.ndarray) -> np.ndarray:
    low = (found >> _U(32)).astype(np.uint32)
    out = np.full(len(times), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 4096):
        part = low[at : at + 4096]
        out = np.minimum(out, (times[:, None] * part[None, :] + plus[:, None]).min(axis=1))
    return out


def _orders(signature: np.ndarray, trees: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each tree the hash of its first positions, and 16 bits for each deeper cut."""
    count = len(signature)
    places = (np.arange(trees) * depth)[:, None] + np.arange(DEEPER[-1])[None, :]
    values = signature[places % count].astype(np.uint64)

    def fold(part: np.ndarray, seed: np.ndarray) -> np.ndarray:
        for k in range(part.shape[1]):
            seed = mix(seed * _U(0x100000001B3) + part[:, k])
        return seed

    first = fold(values[:, :depth], np.arange(trees, dtype=np.uint64) + _U(1))
    tail, seed = np.zeros(trees, np.uint64), first
    for cut, to in zip((depth, *DEEPER), DEEPER):
        seed = fold(values[:, cut:to], seed)
        tail = (tail << _U(16)) | (seed >> _U(48))
    return first, tail


def parity(found: np.ndarray) -> np.ndarray:
    """Parity bits of a set of shingles."""
    bits = np.bincount((found & _U(64 * PARITY_WORDS - 1)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def sign(docs: DataFrame, shingle: int = SHINGLE, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """Size, identity and parity bits of each document's shingle set, and its place in
    every tree."""

    def run(batch: pa.RecordBatch) -> dict:
        times, plus = _functions(trees * depth)
        out = {n: [] for n in ("n_shingles", "set_a", "set_b", "parity", "regions", "tails")}
        for text in batch.column("text").to_pylist():
            found = shingles(text, shingle)
            out["n_shingles"].append(len(found))
            out["set_a"].append(int(signed(mix(found ^ _U(0x5851F42D4C957F2D)).sum(keepdims=True))[0]) if len(found) else 0)
            out["set_b"].append(int(signed(mix(found + _U(0x14057B7EF767814F)).sum(keepdims=True))[0]) if len(found) else 0)
            out["parity"].append(parity(found))
            if len(found):
                first, tail = _orders(_signature(found, times, plus), trees, depth)
                out["regions"].append(signed(first))
                out["tails"].append(signed(tail))
            else:
                out["regions"].append([])
                out["tails"].append([])
        return out

    return per_batch(docs.select("doc_id", "text"), run, "n_shingles long, set_a long, set_b long, parity array<long>, regions array<long>, tails array<long>", ["doc_id"])


def _regions(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The places (node, n, version, size, cut, part) in every region of two or more (cut 0)
    and in the parts of crowded ones; and pairs of neighbours in a sorted order."""
    rows = placed.select("node", "n", "version", F.explode(F.arrays_zip("regions", "tails")).alias("at")).select(
        "node", "n", "version", F.col("at.regions").alias("region"), F.col("at.tails").alias("tail")
    )
    every = Window.partitionBy("region")
    order = every.orderBy("tail", "node")
    rows = rows.withColumn("size", F.count(F.lit(1)).over(every)).filter("size > 1")
    rows = rows.withColumns({f"near_{c}": F.lead(c).over(order) for c in ("node", "n", "tail")})
    rows = stored(rows, "regions")
    # a crowded region is cut at each deeper position
    cuts = [F.struct(F.lit(0).alias("cut"), F.col("region").alias("part"))]
    for k in range(len(DEEPER)):
        part = F.shiftrightunsigned("tail", 16 * (len(DEEPER) - 1 - k))
        cuts.append(F.when(F.col("size") > CROWDED, F.struct(F.lit(k + 1).alias("cut"), F.xxhash64("region", F.lit(k), part).alias("part"))))
    deep = rows.select("node", "n", "version", "size", F.explode(F.array_compact(F.array(*cuts))).alias("c")).select(
        "node", "n", "version", "size", "c.cut", "c.part"
    )
    close = (F.col("size") <= CROWDED) | (F.shiftrightunsigned("tail", 48) == F.shiftrightunsigned("near_tail", 48))
    near = rows.filter(F.col("near_node").isNotNull() & close)
    return deep, near.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("near_node").alias("b"), F.col("near_n").alias("nb"))


def _fitting(pairs: DataFrame, least: int) -> DataFrame:
    """Distinct pairs (a, b), a < b, of (a, na, b, nb) whose sizes allow a link."""
    fitting = (F.col("a") != F.col("b")) & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * least)
    return pairs.filter(fitting).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _candidates(deep: DataFrame, near: DataFrame, least: int) -> DataFrame:
    """First pairs to be confirmed; about as many as places in regions, whatever the
    size of a region."""
    met = deep.groupBy("node").agg(F.sum("size").alias("met"))
    hubs = deep.join(met, "node").groupBy("part").agg(
        F.max(F.struct("met", (-F.col("node")).alias("lower"), "n")).alias("hub"), F.count(F.lit(1)).alias("places")
    )
    hubs = hubs.filter("places > 1").select("part", (-F.col("hub.lower")).alias("a"), F.col("hub.n").alias("na"))
    pairs = deep.join(hubs, "part").select("a", "na", F.col("node").alias("b"), F.col("n").alias("nb"))
    return stored(_fitting(pairs.unionByName(near), least), "pairs")


def _with_parity(places: DataFrame, bits: DataFrame) -> DataFrame:
    """Places with the parity bits of their sets, a column for each word.  The bits are
    looked up once for a set; it has a place in each tree and each cut at most."""
    rest = [c for c in places.columns if c not in ("node", "version")]
    sets = places.groupBy("node", "version").agg(F.collect_list(F.struct(*rest)).alias("_places"))
    found = sets.join(bits.select("node", "version", "parity"), ["node", "version"])
    words = [F.col("parity")[i].alias(f"p{i}") for i in range(PARITY_WORDS)]
    return found.select("node", "version", "parity", F.explode("_places").alias("_place")).select(
        "node", "version", *[F.col(f"_place.{c}").alias(c) for c in rest], *words
    )


def _near_enough(least: int) -> Column:
    """Whether sizes and parity bits of (n, p0...) and (nb, q0...) allow a link: sets
    of s shingles together that differ by d of them have (s - d) / (s + d) in common."""
    apart = reduce(lambda a, b: a + b, [F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"q{i}"))) for i in range(PARITY_WORDS)])
    return apart * (100 + least) <= (F.col("n") + F.col("nb")) * (100 - least)


def _other(places: DataFrame, *more: Column) -> DataFrame:
    """The other side of a comparison inside parts."""
    words = [F.col(f"p{i}").alias(f"q{i}") for i in range(PARITY_WORDS)]
    return places.select("part", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("label").alias("other"), *words, *more)


def _met_by_others(placed: DataFrame) -> DataFrame:
    """The leading members of each part (leads), and the members that have another label
    than one of them.  No other member of a part is compared with any."""
    part = Window.partitionBy("part")
    placed = placed.withColumns({"at": F.row_number().over(part.orderBy(F.desc("met"), "node")), "places": F.count(F.lit(1)).over(part)})
    leaders = F.when(F.col("places") <= 3 * CROWDED, CROWDED).otherwise(LEADERS)
    placed = placed.withColumn("leads", F.col("at") <= leaders)
    label, of_leader = F.col("label"), F.when(F.col("leads"), F.col("label"))
    placed = placed.withColumns({
        "mixed": F.min(label).over(part) < F.max(label).over(part), "low": F.min(of_leader).over(part), "high": F.max(of_leader).over(part),
    })
    met = F.col("mixed") & (F.col("leads") | (label != F.col("low")) | (label != F.col("high")))
    return placed.filter(met).select("part", "node", "n", "version", "label", "leads")


def _unjoined(deep: DataFrame, labels: DataFrame, bits: DataFrame, tried: DataFrame, least: int) -> DataFrame:
    """Pairs of one part that no link has joined yet: each document with those
    members that meet most others, which in an uncrowded part are all of them.
    A part that links have made one component gives none."""
    met = deep.groupBy("node").agg(F.sum("size").alias("met"))
    placed = deep.select("part", "node", "n", "version").join(met, "node").join(labels, "node", "left").select(
        "part", "node", "n", "version", "met", F.coalesce("label", "node").alias("label")
    )
    every = stored(_with_parity(_met_by_others(placed), bits), "mixed")
    led = _other(every.filter("leads"))
    pairs = every.join(led, "part").filter((F.col("label") != F.col("other")) & _near_enough(least)).select(F.col("node").alias("a"), F.col("n").alias("na"), "b", "nb")
    return stored(_fitting(pairs, least).join(tried, ["a", "b"], "left_anti"), "pairs")


def _apart(deep: DataFrame, labels: DataFrame, bits: DataFrame, sets: DataFrame, tried: DataFrame, least: int) -> DataFrame:
    """All pairs of one crowded region that no link has joined yet and whose sizes,
    common shingles and parity bits allow a link.  A shingle that only one of these members has
    is shared with none, so the others bound what a pair can share."""
    placed = deep.filter((F.col("cut") == 0) & (F.col("size") > CROWDED)).select("part", "node", "n", "version").join(labels, "node", "left")
    placed = placed.select("part", "node", "n", "version", F.coalesce("label", "node").alias("label"))
    mixed = placed.groupBy("part").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    every = stored(placed.join(mixed.select("part"), "part", "left_semi"), "apart")

    def read(batch: pa.RecordBatch) -> dict:
        return {"held": [np.frombuffer(s.as_buffer(), np.int64) for s in batch.column("shingles")]}

    # rows that repeat an id are several sets of one node
    held = sets.join(every.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    held = held.select(F.col("doc_id").alias("node"), F.xxhash64("shingles").alias("version"), (F.length("shingles") / 8).cast("int").alias("n_held"), "shingles")
    rows = per_batch(held, read, "held array<long>", ["node", "version", "n_held"]).select("node", "version", "n_held", F.explode("held").alias("shingle"))
    one = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders"), F.min(F.struct("node", "version")).alias("of")).filter("holders = 1")
    alone = one.groupBy("of.node", "of.version").agg(F.count(F.lit(1)).alias("alone"))
    common = held.select("node", "version", "n_held").join(alone, ["node", "version"], "left").groupBy("node").agg(
        F.max(F.col("n_held") - F.coalesce("alone", F.lit(0))).alias("common")
    )
    able = every.join(common, "node").filter(F.col("common") * 100 >= F.col("n") * least)
    able = stored(_with_parity(able, bits), "apart")
    other = _other(able, F.col("common").alias("cb"))
    shared = F.least("n", "nb", "common", "cb")
    allowed = (F.col("node") < F.col("b")) & (F.col("label") != F.col("other")) & (shared * 100 >= (F.col("n") + F.col("nb") - shared) * least)
    pairs = able.join(other, "part").filter(allowed & _near_enough(least)).select(F.col("node").alias("a"), F.col("n").alias("na"), "b", "nb")
    return stored(_fitting(pairs, least).join(tried, ["a", "b"], "left_anti"), "pairs")


def _confirm(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b"
    )

    def similar(batch: pa.RecordBatch) -> dict:
        out = []
        for x, y in zip(batch.column("sa"), batch.column("sb")):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            together = np.concatenate([x, y])
            together.sort()
            shared = int((together[1:] == together[:-1]).sum())
            out.append(100 * shared >= least * (len(together) - shared))
        return {"linked": out}

    return stored(per_batch(both, similar, "linked boolean", ["a", "b"]).filter("linked").select("a", "b").distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that can be reached over links (a, b).

    Each round takes the least label among the neighbours and then the label of
    that label, so a chain of n links needs about log n rounds.
    """
    there = links.select(F.col("a").alias("node"), F.col("b").alias("peer"))
    back = links.select(F.col("b").alias("node"), F.col("a").alias("peer"))
    edges = stored(there.unionByName(back), "edges")
    labels = stored(edges.groupBy("node").agg(F.min(F.least("node", "peer")).alias("label")), "labels")
    while True:
        of_peer = labels.select(F.col("node").alias("peer"), "label")
        near = edges.join(of_peer, "peer").groupBy("node").agg(F.min("label").alias("least"))
        taken = labels.join(near, "node").select("node", "label", F.least("label", "least").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("beyond"))
        step = taken.join(jump, "to").select("node", F.least("to", "beyond").alias("label"), (F.least("to", "beyond") != F.col("label")).alias("moved"))
        step = stored(step, "labels")
        labels = step.select("node", "label")
        if not step.filter("moved").limit(1).count():
            return labels


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links, which join whole components."""
    of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    ends = links.join(of_a, "a", "left").join(of_b, "b", "left")
    ends = ends.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).filter("a <> b")
    top = components(ends).select(F.col("node").alias("label"), F.col("label").alias("top"))
    known = labels.join(top, "label", "left").select("node", F.coalesce("top", "label").alias("label"))
    alone = top.select(F.col("label").alias("node"), F.col("top").alias("label")).join(labels.select("node"), "node", "left_anti")
    return known.unionByName(alone)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, least: int = LEAST, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id and kept.

    Documents are linked where 100 * shared >= `least` * united shingles;
    component_id is the smallest id that links reach.  Null, empty and blank texts
    have no shingles and stand alone.  Documents with equal sets are one node, so
    large groups of copies cost no pairs.  Rows that repeat an id are one document
    with several texts; a row without an id is never kept and has no component
    of its own.  An empty table gives no rows; other columns are not read.
    """
    signed_docs = stored(sign(docs, shingle, trees, depth), "signed")
    key = ["set_a", "set_b", "n_shingles"]
    classes = stored(signed_docs.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(F.min("doc_id").alias("node")), "classes")
    placed = signed_docs.join(classes.withColumnRenamed("node", "doc_id"), ["doc_id", *key], "left_semi").select(
        F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), F.col("set_a").alias("version"), "parity", "regions", "tails"
    )
    bits = placed.select("node", "version", "parity").dropDuplicates(["node", "version"])
    deep, near = _regions(placed)
    deep = stored(deep, "deep")

    def full(batch: pa.RecordBatch) -> dict:
        return {"shingles": [shingles(t, shingle).tobytes() for t in batch.column("text").to_pylist()]}

    met = deep.select(F.col("node").alias("doc_id")).distinct()
    sets = per_batch(docs.select("doc_id", "text").join(met, "doc_id", "left_semi"), full, "shingles binary", ["doc_id"])
    sets = stored(sets.dropDuplicates(["doc_id", "shingles"]), "sets")
    pairs = _candidates(deep, near, least)
    links = _confirm(pairs, sets, least)
    labels = components(links)
    more = _unjoined(deep, labels, bits, pairs, least)
    labels = stored(_merged(labels, _confirm(more, sets, least)), "labels")
    rest = _apart(deep, labels, bits, sets, pairs.unionByName(more), least)
    labels = _merged(labels, _confirm(rest, sets, least))
    named = classes.join(labels, "node", "left").select(*key, F.coalesce("label", "node").alias("label"))
    found = signed_docs.select("doc_id", *key).join(named, key, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("label")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )
