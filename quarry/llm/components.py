"""Connected components of an edge table, as joins and aggregations only.

Alternating large-star and small-star rounds: every vertex is relinked to the
smallest neighbour it knows of until each component is one star around its
smallest vertex. A vertex with very many neighbours is met only in a partial
``min`` and in a join that adaptive execution can split; no task ever holds a
vertex's neighbours together, and the driver sees one count per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.scratch import save


# The smallest neighbours are written before they are joined: a join straight above an
# aggregation keeps its partitions, and adaptive execution could not split a hot vertex.


def _large(edges: DataFrame, name: str, files: int | None) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = save(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), name, files)
    return (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small(edges: DataFrame, name: str, files: int | None) -> DataFrame:
    least = save(edges.groupBy("a").agg(F.min("b").alias("m")), name, files)
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Count and hash sum of the edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """``(a, b)`` long edges to ``(node, component)``: the smallest node each one reaches.

    Self-loops and repeated edges are allowed; null ends are ignored. Nodes
    without an edge to another node are not returned. Each round's tables have at most ``files`` files.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = (edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct())
    now = save(now, f"{name}-edges", files)
    mark = _mark(now)
    while mark[0]:
        now = save(_large(now, f"{name}-least", files), f"{name}-edges", files)
        now = save(_small(now, f"{name}-least", files), f"{name}-edges", files)
        seen = _mark(now)
        if seen == mark:  # an edge table that a round leaves as it is consists of stars
            break
        mark = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b"), F.col("b")).distinct())
