"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum (map-side combine) and a join; lineage is cut
by a reliable checkpoint per step.  Edges are never gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stratus.llm.common import small_or_shuffled
from stratus.operators.joins import materialize


def _least_below(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("least"))
    return small_or_shuffled(least.select(F.col("hi").alias("node"), "least"))


def _saved(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """A checkpoint of the edges and what tells them from others, from one job."""
    seen = Observation()
    total = F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
    saved = materialize(edges.observe(seen, F.count("*").alias("n"), total.alias("hash")))
    return saved, (seen.get["n"], seen.get["hash"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge; component is the least node reachable.

    Self loops and edges with a null end are ignored; repeated edges count
    once; no edge gives no row.  The number of rounds grows with the logarithm
    of the longest path.
    """
    e = (edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
         .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") != F.col("lo"))).distinct())
    e, before = _saved(e)
    while before[0]:
        # Large star: every larger neighbour of a node moves to the node's least neighbour.
        up = _least_below(e)
        large = (e.join(up, e["lo"] == up["node"], "left")
                 .select("hi", F.coalesce("least", "lo").alias("lo")))
        # Small star: a node and its smaller neighbours move to the least of them.
        down = _least_below(large)
        joined = large.join(down, large["hi"] == down["node"])
        moved = joined.select(F.col("lo").alias("hi"), F.col("least").alias("lo")).filter("hi != lo")
        e, after = _saved(moved.union(down.select(F.col("node").alias("hi"), F.col("least").alias("lo"))).distinct())
        if after == before:
            break
        before = after
    roots = e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
