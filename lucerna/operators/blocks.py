"""Rows that belong together by place: blocks under a title, steps to report, maps merged by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def carry_forward(rows: DataFrame, keys: list[str], order: str, title: Column, text: str, keep: list[str]) -> DataFrame:
    """One row for each title of a key (a page, a document): what it keeps, its place, and the texts from it to the next title as one.

    Rows before the first title go.  A key's rows meet in one task, as its titles are a matter of their order.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    led = rows.withColumn("_n", F.sum(title.cast("int")).over(w)).where("_n > 0")
    said = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    one = led.groupBy(*keys, "_n").agg(F.min(order).alias(order), said.alias("_l"), *[F.min_by(c, order).alias(c) for c in keep])
    joined = F.array_join(F.filter(F.transform("_l", lambda x: F.trim(x.t)), lambda x: x != ""), " ")
    return one.select(*keys, order, joined.alias(text), *keep)


def reported(rows: DataFrame, keys: list[str], order: list, every: int) -> DataFrame:
    """The rows at which progress is told, with `current` and `total`: every so many of a key, and its last."""
    w = Window.partitionBy(*keys)
    counted = rows.withColumn("current", F.row_number().over(w.orderBy(*order)).cast("long")).withColumn("total", F.count("*").over(w))
    return counted.where((F.col("current") % max(every, 1) == 0) | (F.col("current") == F.col("total")))


def merged_map(old: Column, new: Column) -> Column:
    """Both maps' entries by key, in the keys' order; new ones win, a null map is empty."""
    none = F.create_map().cast("map<string,string>")
    a, b = F.coalesce(old, none), F.coalesce(new, none)
    entries = F.concat(F.map_entries(F.map_filter(a, lambda k, v: ~F.map_contains_key(b, k))), F.map_entries(b))
    return F.map_from_entries(F.array_sort(entries))
