"""Connected components by alternating large and small stars.

Both steps hang nodes of one component on ever smaller ids until every edge
leads to its component's smallest. A step is an aggregation and a join, so a
node with very many edges is combined before the shuffle and its join can be
split; the driver sees two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import stored


def _large(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is hung on the node's smallest neighbour."""
    both = edges.union(edges.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).where("m < a")
    return both.where("b > a").join(least, "a", "left").select(F.col("b").alias("a"), F.coalesce("m", "a").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are hung on the smallest of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).union(others)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that has an edge, the root itself included.

    ``edges`` has columns ``a`` and ``b`` of one orderable type; loops, repeated
    and reversed edges do no harm; null ends are ignored; no edges, no rows.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(ordered.distinct(), "edges")
    state, before = _state(now), None
    while state != before and state[0]:
        now = stored(_small(_large(now).distinct()).distinct(), "edges")
        state, before = _state(now), state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
