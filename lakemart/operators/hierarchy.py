"""Trees given by a parent column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.session import cut_lineage


class HierarchyCycle(RuntimeError):
    pass


def closure(nodes: DataFrame, child: str, parent: str) -> DataFrame:
    """All (ancestor, descendant, distance) pairs with distance >= 1.

    Each round joins the pairs of the greatest distance with all pairs, so the
    distance doubles and a chain of n levels takes about log n rounds.  The pairs
    of a round are stored in the shared folder, so the plan stays one join deep.
    A node that comes out as its own ancestor stands on a cycle and is refused.
    """
    edges = nodes.filter(F.col(parent).isNotNull() & (F.col(parent) != F.col(child))).select(
        F.col(parent).alias("ancestor"), F.col(child).alias("descendant"), F.lit(1).alias("distance")
    ).distinct()
    total, reach = cut_lineage(edges), 1
    while True:
        far = total.filter(F.col("distance") == reach).select(
            F.col("ancestor"), F.col("descendant").alias("_middle"), F.col("distance").alias("_far")
        )
        near = total.select(F.col("ancestor").alias("_middle"), "descendant", "distance")
        further = cut_lineage(
            far.join(near, "_middle").select("ancestor", "descendant", (F.col("_far") + F.col("distance")).alias("distance")).distinct()
        )
        if further.isEmpty():
            return total
        if not further.filter(F.col("ancestor") == F.col("descendant")).isEmpty():
            raise HierarchyCycle("the parent column holds a cycle")
        total, reach = cut_lineage(total.unionByName(further)), 2 * reach


def moved(pairs: DataFrame, nodes: DataFrame, child: str, parent: str, changed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What changes in a closure when some nodes get another parent, or come or go.

    `pairs` is the closure before, `nodes` the tree now, and `changed` holds in the
    column `child` every node whose parent is not what it was.  Returns the nodes
    whose pairs change (column descendant), which are the changed ones and all below
    them, and all pairs that these have now.  Every other node keeps its ancestors.
    The rounds run over the moved subtrees only, however large the tree is.
    """
    moving = changed.select(F.col(child).alias("descendant")).distinct()
    below = pairs.join(moving.withColumnRenamed("descendant", "ancestor"), "ancestor", "left_semi").select("descendant")
    affected = cut_lineage(moving.union(below).distinct())
    own = nodes.select(F.col(child).alias("descendant"), F.col(parent).alias("_parent")).join(affected, "descendant", "left_semi")
    own = cut_lineage(own.filter(F.col("_parent").isNotNull() & (F.col("_parent") != F.col("descendant"))).distinct())
    among = affected.withColumnRenamed("descendant", "_parent")
    inside = closure(own.join(among, "_parent", "left_semi").select(F.col("descendant").alias(child), F.col("_parent").alias(parent)), child, parent)
    # where a moved subtree hangs on a node that did not move, it takes over the ancestors of that node
    tops = own.join(among, "_parent", "left_anti")
    above = pairs.select(F.col("ancestor"), F.col("descendant").alias("_parent"), (F.col("distance") + 1).alias("distance"))
    over = above.join(tops, "_parent").select("ancestor", "descendant", "distance").unionByName(
        tops.select(F.col("_parent").alias("ancestor"), "descendant", F.lit(1).alias("distance"))
    )
    under = inside.select(F.col("ancestor").alias("_top"), "descendant", F.col("distance").alias("_far"))
    lifted = over.withColumnRenamed("descendant", "_top").join(under, "_top").select(
        "ancestor", "descendant", (F.col("distance") + F.col("_far")).alias("distance")
    )
    return affected, cut_lineage(inside.unionByName(over).unionByName(lifted).distinct())


def closure_with_self(nodes: DataFrame, child: str, parent: str) -> DataFrame:
    """Closure plus every node paired with itself."""
    itself = nodes.select(F.col(child).alias("ancestor"), F.col(child).alias("descendant"), F.lit(0).alias("distance"))
    return closure(nodes, child, parent).unionByName(itself).distinct()


def ancestors_by_level(nodes: DataFrame, child: str, parent: str, payload: list[str], levels: int) -> DataFrame:
    """Each node with its next ``levels`` ancestors side by side."""
    result = nodes.select(child, parent, *payload)
    above = parent
    for level in range(1, levels + 1):
        step = nodes.select(
            F.col(child).alias(f"{child}_{level}"),
            F.col(parent).alias(f"{parent}_{level}"),
            *[F.col(c).alias(f"{c}_{level}") for c in payload],
        )
        result = result.join(step, F.col(above) == F.col(f"{child}_{level}"), "left")
        above = f"{parent}_{level}"
    return result
