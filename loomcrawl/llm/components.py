"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _least(pairs: DataFrame) -> DataFrame:
    """For each a of the pairs (a, b): m, the smallest of a and its neighbours; lo and hi, its smallest and largest neighbour."""
    lo = F.min("b").alias("lo")
    return saved(pairs.groupBy("a").agg(lo, F.max("b").alias("hi")).withColumn("m", F.least("a", "lo")), "least")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component is the smallest node reachable.

    Edges may repeat, point either way or be loops; rows with a null end are no edges. Labels only
    ever shrink, and the steps needed grow with the logarithm of the longest path. They end when every
    node that has a smaller neighbour has no other: what is left are stars, each around its smallest node.
    Each step is written to the shared folder. Nodes are never gathered on the driver.
    """
    e = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    while True:
        # both sides of a join are read from files, so adaptive execution can split a hub's rows
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both)
        if least.where("lo < a and hi <> lo").isEmpty():
            return least.select(F.col("a").alias("node"), F.col("m").alias("component"))
        # large star: each node's larger neighbours move to its smallest; repeats go in the other step
        large = both.where("b > a").join(least.select(F.col("a").alias("of"), "m"), F.col("a") == F.col("of"))
        e = saved(large.select(F.col("b").alias("a"), F.col("m").alias("b")), "large-star")
        # small star: each node and its smaller neighbours move to the smallest
        least = _least(e)
        small = e.join(least.select(F.col("a").alias("of"), "m"), F.col("a") == F.col("of")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = saved(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
