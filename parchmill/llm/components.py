"""Connected components by alternating large and small stars.

The method is that of Kiveris et al., "Connected Components in MapReduce and
Beyond" (2014).  Every step is a grouped minimum (combined on the map side)
and an equi-join, so a hub with very many neighbours is a skewed join key that
adaptive execution can split, never a group in one task's memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, remove


def _lowest(pairs: DataFrame) -> DataFrame:
    """(node, low): the least of a node and its neighbours, for pairs (node, other)."""
    return pairs.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        edges.select(F.col("b"), F.col("a"))
    )
    return (
        both.join(_lowest(both), "node").where("other > node")
        .select(F.col("other").alias("a"), F.col("low").alias("b")).where("a != b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    low = _lowest(down)
    moved = down.join(low, "node").select(F.col("other").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("node", "low")).where("a != b").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that has an edge; component is its least node.

    ``edges`` holds integer ids; direction, repeats and loops don't matter, and
    rows with a null end are left out.  No edges give an empty result.  Each
    round is written to the shared folder, so lineage stays short, and the one
    before it is deleted.
    """
    edges = materialize(
        edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a != b").distinct(), "edges"
    )

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = state(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        old, edges = edges, materialize(_small_star(_large_star(edges)), "stars")
        now = state(edges)
        remove(edges.sparkSession, sorted({f.rsplit("/", 1)[0] for f in old.inputFiles()}))
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(edges.select("b", "b").distinct()).groupBy("node").agg(F.min("component").alias("component"))
