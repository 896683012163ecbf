"""Connected components by alternating large-star and small-star steps (DataFrame operations only).

A step joins each edge with the least neighbour of one end; the edges shrink
to stars around the least member in about log(n) rounds, whatever the paths'
lengths.  Each round is checkpointed to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.session import shared_dir


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (its least member) for all ends of the links (x, y), as longs."""
    shared_dir(links.sparkSession)
    edges = (links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u > v").distinct().checkpoint())
    before = None
    while True:
        # Large star: larger neighbours move to the least of a node and its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # Small star: a node and its smaller neighbours move to the least of these.
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = (edges.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.*").where("u > v").distinct().checkpoint())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
