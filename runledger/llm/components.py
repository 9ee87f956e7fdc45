"""Connected components by contraction, as DataFrame code.

In each round every node takes the smallest node next to it as its parent, if that is smaller
than itself; parents of parents are followed until all point to a root; edges are then drawn
between the roots and repeated ones dropped. Roots that still have edges go to the next round.
Every root with an edge either takes a parent or is one, so at least half of them vanish in
each round and the rounds, like the steps that follow parents, grow with the logarithm.

All steps are joins on node, written to the shared folder, so lineage stays short. The table of
parents has one row per node; it is broadcast if measured small, otherwise a node with many
edges is split. Edges that would fit a broadcast are contracted by one task, without shuffles:
on hundreds of partitions the rounds of small tables would take longer than all other work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import written
from runledger.operators.skew import fits_broadcast, split_join


def _follow(rows: DataFrame, column: str, parents: DataFrame, small: bool, by: list[str]) -> DataFrame:
    """``rows`` with the parent of ``column`` in its place, or itself without one."""
    named = parents.select(F.col("node").alias(column), F.col("parent").alias("_parent"))
    if small:
        out = rows.join(F.broadcast(named), column, "left")
    else:
        out = split_join(rows, named, [column], by, "left")
    return out.withColumn(column, F.coalesce("_parent", column)).drop("_parent")


def _gathered(edges: DataFrame) -> DataFrame:
    """``edges`` in one partition if they are few."""
    return edges.coalesce(1) if fits_broadcast(edges) else edges


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for each node of ``edges`` (columns ``a`` and ``b`` of one type that
    has an order): the root is the smallest node that can be reached. Edges from a node to
    itself, repeated edges and edges with NULL are allowed; the last are left out."""
    pairs = edges.select("a", "b").dropna().distinct()
    current = _gathered(written(pairs, "edges"))
    nodes = current.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    roots = written(nodes.withColumn("root", F.col("node")), "roots")
    current = current.where(F.col("a") != F.col("b"))
    while not current.isEmpty():
        ends = (F.struct(F.col(x).alias("node"), F.col(y).alias("next")) for x, y in ("ab", "ba"))
        both = current.select(F.inline(F.array(*ends)))
        parents = both.groupBy("node").agg(F.min("next").alias("parent"))
        parents = written(parents.where(F.col("parent") < F.col("node")), "parents")
        small = fits_broadcast(parents)
        while True:
            further = _follow(
                parents.withColumn("before", F.col("parent")), "parent", parents, small, ["node"]
            )
            further = written(further, "parents")
            parents = further.select("node", "parent")
            if further.where(F.col("before") != F.col("parent")).isEmpty():
                break
        drawn = _follow(_follow(current, "a", parents, small, ["b"]), "b", parents, small, ["a"])
        drawn = drawn.where(F.col("a") != F.col("b")).select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        )
        current = _gathered(written(drawn.distinct(), "edges"))
        roots = written(_follow(roots, "root", parents, small, ["node"]).select("node", "root"), "roots")
    return roots
