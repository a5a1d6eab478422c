"""Connected components of a link table by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.session import cut_lineage

ONE_TASK = 50_000  # links that need no more than one task


def _dealt(edges: DataFrame, links: int) -> DataFrame:
    """A few links in one partition, where Spark has nothing to shuffle; more as they lie."""
    return edges.coalesce(1) if links <= ONE_TASK else edges


def _low(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("low"))


def _with_low(edges: DataFrame, links: int) -> DataFrame:
    """Adds the smallest v of each u. A join would shuffle even a single partition."""
    if links <= ONE_TASK:
        return edges.withColumn("low", F.min("v").over(Window.partitionBy("u")))
    return edges.join(_low(edges), "u")


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")
    ).first()
    return row.n, row.h


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every linked node other than a root; root is the smallest node reached.

    Alternating star steps: first every neighbour above a node is tied to the smallest
    neighbour, then every node below. The table never outgrows the links, each round is a few
    joins whose hot side adaptive execution can split, and rounds grow with the logarithm of
    the size. Loops and NULL ends are ignored; an empty table gives an empty result.

    A round is some ten shuffles, each of as many tasks as there are shuffle partitions. For few
    links these move next to nothing, so up to ``ONE_TASK`` of them a round is one task instead.
    """
    edges = cut_lineage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    before = _signature(edges)
    edges = _dealt(edges, before[0])
    while before[0]:
        both = _dealt(edges.union(edges.select("v", "u")), before[0])
        large = (
            _with_low(both, before[0])
            .filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "low").alias("v"))
            .distinct()
        )
        small = (
            _with_low(large, before[0])
            .filter(F.col("v") != F.col("low"))
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
        )
        tied = _dealt(small.union(_low(large)), before[0])
        edges = cut_lineage(tied.distinct())
        now = _signature(edges)
        edges = _dealt(edges, now[0])
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
