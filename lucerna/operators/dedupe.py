"""De-duplication: first, last and best row of a key, ranked and folded merges.  Order always comes from columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _one(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the order.  A task sends one row a key, as the limit of a group is applied before the exchange too."""
    return rows.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_at = 1").drop("_at")


def first_wins(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the (ascending) order; null keys are equal."""
    return _one(rows, keys, order)


def placed(rows: DataFrame, keys: list[str], order: list, place: str) -> DataFrame:
    """rows with their place, from 1, among those of their key."""
    return rows.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def last_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in the order."""
    return _one(rows, keys, [F.desc(c) for c in order])


def best(rows: DataFrame, keys: list[str], priority: str, tie: str) -> DataFrame:
    """Highest priority, then the smallest tie value."""
    return _one(rows, keys, [F.desc(priority), F.col(tie)])


def ranked_merge(rows: DataFrame, keys: list[str], rank: Column, order: str, fill: list[str], largest: list[str]) -> DataFrame:
    """One row a key: columns to fill take their first non-null by descending rank, then order; the others their maximum.

    min_by over a struct aggregates partially before the exchange, so a hot key sends a row for each task only.
    """
    place = F.struct((-rank).alias("r"), F.col(order).alias("o"))
    filled = [F.expr(f"min_by({c}, _place) filter (where {c} is not null)").alias(c) for c in fill]
    return rows.withColumn("_place", place).groupBy(*keys).agg(*filled, *[F.max(c).alias(c) for c in largest])


def fold_merge(rows: DataFrame, keys: list[str], order: str, score: str, fill: str) -> DataFrame:
    """Left fold in the order: a higher score takes over, ties keep the row at hand, empty fields fill from the other."""
    items = F.array_sort(F.collect_list(F.struct(order, score, fill)))
    first = F.get(F.col("_l"), F.lit(0))
    step = lambda a, x: F.when(x[score] > a[score], F.struct(x[order].alias(order), x[score].alias(score), F.coalesce(x[fill], a[fill]).alias(fill))).otherwise(F.struct(a[order].alias(order), a[score].alias(score), F.coalesce(a[fill], x[fill]).alias(fill)))
    folded = rows.groupBy(*keys).agg(items.alias("_l"))
    return folded.select(*keys, F.aggregate(F.slice("_l", F.lit(2), F.size("_l")), first, step).alias("_m")).select(*keys, "_m.*")
