"""Byte-balanced shards by Karmarkar-Karp differencing.

Documents with equal texts form one group, which is never split.  Few groups can
be heavy: those are combined first, in one task.  All others are dealt over tasks
by a hash; each task combines its groups together with its share of the heavy
groups' partial partition, so that it fills what the heavy groups leave uneven.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import gapless, stored

SHARDS = 16
#: Groups or partial partitions that one task combines.
PER_TASK = 20_000


def combine(partials: list[list[int]]) -> list[list[int]]:
    """For each partial partition, the shard that each of its parts goes to.

    The two of largest spread are combined again and again, the largest parts of
    one with the smallest of the other.
    """
    shards = len(partials[0])
    nodes: list[tuple[list[int], tuple | None]] = []  # sums in descending order, what it was made of
    orders = []
    heap = []
    for i, sums in enumerate(partials):
        order = sorted(range(shards), key=lambda k: (-sums[k], k))
        orders.append(order)
        ranked = [sums[k] for k in order]
        nodes.append((ranked, None))
        heap.append((ranked[-1] - ranked[0], i))
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        up, down = nodes[a][0], nodes[b][0]
        sums = [up[k] + down[shards - 1 - k] for k in range(shards)]
        order = sorted(range(shards), key=lambda k: (-sums[k], k))
        ranked = [sums[k] for k in order]
        heapq.heappush(heap, (ranked[-1] - ranked[0], len(nodes)))
        nodes.append((ranked, (a, b, order)))
    # from the last node down: which shard each rank of a node stands for
    shard_of: dict[int, list[int]] = {len(nodes) - 1: list(range(shards))}
    for n in range(len(nodes) - 1, len(partials) - 1, -1):
        a, b, order = nodes[n][1]
        own = shard_of.pop(n)
        left, right = [0] * shards, [0] * shards
        for rank, k in enumerate(order):
            left[k] = own[rank]
            right[shards - 1 - k] = own[rank]
        shard_of[a], shard_of[b] = left, right
    out = []
    for i, order in enumerate(orders):
        target = [0] * shards
        for rank, part in enumerate(order):
            target[part] = shard_of[i][rank]
        out.append(target)
    return out


def _combine_task(base: list[int]):
    """Combine the groups of a task with a partial partition whose parts already
    stand for shards."""
    shards = len(base)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["weight", "member"], ascending=[False, True])
        placed = combine([base] + [[w] + [0] * (shards - 1) for w in pdf["weight"].tolist()])
        shard_of = {at: k for k, at in enumerate(placed[0])}
        return pd.DataFrame({"member": pdf["member"], "shard": [shard_of[t[0]] for t in placed[1:]], "weight": pdf["weight"]})

    return run


def place_groups(groups: DataFrame, shards: int = SHARDS, per_task: int = PER_TASK) -> DataFrame:
    """(member, shard) for groups of (member, weight).

    Members are distinct and not null, weights are whole numbers of at least 0.
    """
    groups = stored(groups.select("member", "weight"), "groups")
    size = groups.agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("total")).first()
    schema = f"member {dict(groups.dtypes)['member']}, shard int, weight long"
    tasks = max(1, -(-size["n"] // per_task))
    if tasks == 1:
        return groups.withColumn("task", F.lit(0)).groupBy("task").applyInPandas(_combine_task([0] * shards), schema).drop("weight")
    # fewer than `per_task` groups can weigh more than this
    heavy = F.col("weight") > size["total"] / per_task
    first = stored(
        groups.filter(heavy).withColumn("task", F.lit(0)).groupBy("task").applyInPandas(_combine_task([0] * shards), schema), "heavy"
    )
    sums = {r["shard"]: r["w"] for r in first.groupBy("shard").agg(F.sum("weight").alias("w")).collect()}
    share = [sums.get(k, 0) // tasks for k in range(shards)]
    dealt = groups.filter(~heavy).withColumn("task", F.pmod(F.xxhash64("member"), F.lit(tasks)))
    return first.unionByName(dealt.groupBy("task").applyInPandas(_combine_task(share), schema)).drop("weight")


def shard_documents(docs: DataFrame, shards: int = SHARDS, per_task: int = PER_TASK) -> DataFrame:
    """Put every document into a shard so that the bytes of the shards are near equal.

    size: UTF-8 bytes of the text plus 1; a null text has none and counts as an
    empty one.  Equal texts share a shard, so a group above a shard's even share
    decides how near the sizes can come.  `slot` numbers the rows of a shard
    without gaps.  Repeated rows and null ids are placed like any other row; other
    columns of `docs` are not read; an empty table gives no rows.
    """
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = stored(
        docs.select(
            "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("member")
        ),
        "sized",
    )
    groups = rows.groupBy("member").agg(F.sum("size").alias("weight"))
    placed = place_groups(groups, shards, per_task)
    dealt = stored(rows.join(placed, "member").select("doc_id", "size", "text_crc32", "shard"), "dealt")
    return gapless(dealt, ["shard"], ["doc_id", "text_crc32", "size"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
