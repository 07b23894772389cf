"""Connected components of an edge table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.frames import stored


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _lowest(pairs: DataFrame) -> DataFrame:
    """u and its least neighbour, itself included."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): each node of an edge with the least node it is connected to.

    Every round hangs larger neighbours, then smaller ones, on the least neighbour, and writes the
    edges; the number of rounds grows with the logarithm of the number of nodes. Only minima are
    gathered per node, so a node with very many neighbours is no trouble. Loops are passed over."""
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v")
    edges = stored(edges.distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), "u").filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(_lowest(large), "u")
        linked = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = stored(linked, "edges")
        last, state = state, _state(edges)
        if last == state:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
