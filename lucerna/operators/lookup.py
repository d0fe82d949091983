"""Lookups: unambiguous maps, priorities of keys, consensus, nearest neighbours."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_m


def unique_only(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with exactly one distinct value; minimum and maximum tell, so no set is collected."""
    return rows.where(F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("_m")).where(F.col("_m") == F.col(value)).drop("_m")


def priority_lookup(rows: DataFrame, keys: list[str], table: DataFrame, found: str) -> DataFrame:
    """The value of the first of the row's keys that table (kind, key, value) holds; kinds are the keys' names."""
    out = rows
    for k in keys:
        side = table.where(F.col("kind") == k).select(F.col("key").alias(k), F.col("value").alias(f"_{k}"))
        out = out.join(side, k, "left")
    return out.withColumn(found, F.coalesce(*[F.col(f"_{k}") for k in keys])).drop(*[f"_{k}" for k in keys])


def consensus_backfill(rows: DataFrame, target: str, by: list[str]) -> DataFrame:
    """Fills a missing target where the unambiguous values of the columns agree; all maps are made before anything is filled."""
    out = rows
    for c in by:
        out = out.join(unique_only(rows, c, target).withColumnRenamed(target, f"_{c}"), c, "left")
    votes = F.array_distinct(F.filter(F.array(*[F.col(f"_{c}") for c in by]), lambda x: x.isNotNull()))
    return out.withColumn(target, F.coalesce(target, F.when(F.size(votes) == 1, F.get(votes, F.lit(0))))).drop(*[f"_{c}" for c in by])


def nearest_within(points: DataFrame, targets: DataFrame, metres: float, cell: float | None = None) -> DataFrame:
    """The nearest target (tid, tlat, tlng) of each point (pid, lat, lng) within the distance; ties go to the smallest tid.

    Targets are copied to the nine cells about theirs and joined by cell.  Cells are at least as wide as the distance wherever targets
    are: their width in degrees of longitude follows the target farthest from the equator (one row from the cluster); cell (degrees) may
    only widen them.  Points and targets of one place are one each, so what is compared are pairs of distinct places.  A task holds the
    places of a cell and the targets' about it.
    """
    targets = targets.groupBy("tlat", "tlng").agg(F.min("tid").alias("tid"))
    places = points.select("lat", "lng").where("lat is not null and lng is not null").distinct()
    least = metres / 110_000.0  # a degree of latitude is longer
    far = targets.agg(F.max(F.abs("tlat"))).first()[0] or 0.0
    high = max(least, cell or 0.0)
    wide = max(360.0 if far + least >= 89.9 else least / math.cos(math.radians(far + least)), cell or 0.0)
    near = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    spread = targets.withColumn("cx", F.floor(F.col("tlat") / high)).withColumn("cy", F.floor(F.col("tlng") / wide))
    spread = spread.withColumn("_x", near).withColumn("cx", F.col("cx") + F.col("_x")).withColumn("_y", near).withColumn("cy", F.col("cy") + F.col("_y"))
    met = places.withColumn("cx", F.floor(F.col("lat") / high)).withColumn("cy", F.floor(F.col("lng") / wide)).join(spread, ["cx", "cy"])
    met = met.withColumn("metres", haversine_m(F.col("lat"), F.col("lng"), F.col("tlat"), F.col("tlng"))).where(F.col("metres") <= metres)
    near = met.groupBy("lat", "lng").agg(F.min(F.struct("metres", "tid")).alias("m"))
    return points.join(near, ["lat", "lng"]).groupBy("pid").agg(F.min("m").alias("m")).select("pid", "m.tid", "m.metres")
