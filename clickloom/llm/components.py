"""Connected components of a stored edge list, by alternating large-star and small-star steps.

Every step is a few joins and aggregates over the edges; the edges of each round are a table in the shared folder. A hub's
edges are joined with its minimum by an ordinary equi-join, which adaptive execution may split. Nothing is collected but
one count and one checksum a round. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import staged


def _with_minimum(edges: DataFrame) -> DataFrame:
    """``u``, ``v`` and ``m``, the smallest of u and its neighbours v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("m", "u"))


def components(edges: DataFrame) -> DataFrame:
    """From edges ``u``, ``v`` (any order, repeats allowed): ``node`` and ``root``, the smallest node that it reaches.

    Nodes without an edge to another node have no row. No edges: no rows.
    """
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state[0] == 0 or tuple(state) == before:
            break
        before = tuple(state)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _with_minimum(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        now = staged(small.where("u <> v").distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
