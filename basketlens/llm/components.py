"""Connected components of a graph of edges, as joins that never gather a component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.store import stored

#: Parts in which a node's neighbours meet its minimum.
SALTS = 16


def _salted(rows: DataFrame, other: str) -> DataFrame:
    return rows.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int"))


def _for_all_salts(minima: DataFrame) -> DataFrame:
    return minima.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of ``edges`` (one, two) with its component's least node.

    Large-star and small-star rounds: every node ties its neighbours to the least of them,
    first the larger neighbours, then the smaller ones, until no edge changes.  The least
    neighbour is a map-side combined minimum and meets the neighbours in ``SALTS`` parts, so
    a node with very many neighbours is no group in a task.  Every round is written.
    """
    arcs = stored(edges.where(F.col("one") != F.col("two"))
                  .select(F.greatest("one", "two").alias("high"),
                          F.least("one", "two").alias("low")).distinct())
    mark = _mark(arcs)
    while mark[0]:
        both = arcs.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
            arcs.select(F.col("low").alias("node"), F.col("high").alias("other")))
        least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
        large = (_salted(both.where(F.col("other") > F.col("node")), "other")
                 .join(_for_all_salts(least), ["node", "salt"])
                 .select(F.col("other").alias("high"), F.col("least").alias("low"))
                 .where(F.col("high") != F.col("low")).distinct())
        large = stored(large)
        floor = large.groupBy("high").agg(F.min("low").alias("floor"))
        tied = _salted(large, "low").join(_for_all_salts(floor), ["high", "salt"])
        arcs = stored(tied.select(F.col("low").alias("high"), F.col("floor").alias("low"))
                      .unionByName(tied.select("high", F.col("floor").alias("low")))
                      .where(F.col("high") != F.col("low")).distinct())
        fresh = _mark(arcs)
        if fresh == mark:
            break
        mark = fresh
    stars = arcs.groupBy("high").agg(F.min("low").alias("low"))
    return (stars.select(F.col("high").alias("node"), F.col("low").alias("component"))
            .unionByName(stars.select(F.col("low").alias("node"),
                                      F.col("low").alias("component")).distinct()))


def _mark(arcs: DataFrame) -> tuple:
    """Count and order-free digest of the edges: equal for equal edge sets."""
    return tuple(arcs.agg(F.count(F.lit(1)), F.coalesce(
        F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")), F.lit(0))).first())
