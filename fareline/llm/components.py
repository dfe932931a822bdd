"""Connected components of a graph given as an edge table.

Alternating large and small stars: each round every node points its larger
neighbours, then its smaller ones, at the least node it knows. Every round is
written under ``spark.checkpoint.dir``; the rounds grow with the logarithm of
the longest path. A node's least neighbour comes from a map-side combined
aggregate that is written before the join, so both sides of the join come
straight from an exchange and adaptive execution can split a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_merge, forget, written


def _star(edges: DataFrame, large: bool, name: str) -> DataFrame:
    """One star step on edges (a, b), a > b; written."""
    near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        near = near.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = written(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star")
    if large:
        out = near.where("v > u").join(by_merge(least), "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:       # a's smaller neighbours and a itself point at the least of them
        out = (near.join(by_merge(least), "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
    done = written(out.where("a <> b").distinct(), name)
    forget(least)
    return done


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; root is the least node of its
    component. Loops, repeated edges and null ends are ignored."""
    x, y = F.col(a), F.col(b)
    now = written(edges.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        large = _star(now, True, "large")
        small = _star(large, False, "small")
        forget(now, large)
        now, before, state = small, state, _state(small)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
