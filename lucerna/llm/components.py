"""Connected components of a graph that no machine holds: alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()


def _small(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("low"))
    return e.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("x")).select("x.*").where("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges (a, b) -> (node, component): the smallest node that each node with an edge reaches.  Nulls and self-loops are left out."""
    now = scratch.table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u is not null and v is not null and u <> v").distinct(), "edges")
    seen = None
    while True:
        new = scratch.table(_small(_large(now)), "stars")
        sign = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(now)
        now = new
        if sign == seen:
            break
        seen = sign
    own = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)
