"""Connected components as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.plans.staging import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its least node.

    Nodes may be of any ordered type; null ends, loops and repeated edges say
    nothing.  Alternates two steps until nothing changes: every node's larger
    neighbours are tied to its least one, then its smaller ones.  Each step moves
    edges, never whole neighbourhoods, and takes the least by partial aggregation,
    so a node with very many edges is no hot spot; rounds grow with the logarithm
    of the largest component.  Every round is a table in the shared folder.
    """
    u, v = F.col(a), F.col(b)
    pairs = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter(u.isNotNull() & v.isNotNull() & (u != v))
    pairs = written(pairs.distinct())
    state = _state(pairs)
    while state[0]:
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the join below has plain exchanges, which Spark can split at a hot node
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        larger = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = written(smaller.unionAll(least.withColumnRenamed("m", "v")).distinct())
        before, state = state, _state(pairs)
        if state == before:
            break
    roots = pairs.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
