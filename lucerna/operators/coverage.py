"""Coverage metrics, gates and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coverage(rows: DataFrame, metrics: dict[str, Column], by: list[str] = ()) -> DataFrame:
    """total, and for each metric its count and ratio (0 for no rows), in one pass."""
    counts = [F.count_if(x).alias(k) for k, x in metrics.items()]
    out = rows.groupBy(*by).agg(F.count("*").alias("total"), *counts)
    for k in metrics:
        out = out.withColumn(f"{k}_ratio", F.when(F.col("total") == 0, 0.0).otherwise(F.col(k) / F.col("total")))
    return out


def gate(before: DataFrame, after: DataFrame, falls: str, complete: str) -> DataFrame:
    """Both one-row reports: `falls` must not fall and `complete` must equal the total."""
    b = before.select(F.col(falls).alias("before"))
    return after.join(b, F.lit(True)).select((F.col(falls) >= F.col("before")).alias("not_fallen"), (F.col(complete) == F.col("total")).alias("is_complete"))


def manifest(tables: dict[str, DataFrame], line: dict[str, Column]) -> DataFrame:
    """name, records and digest of each table.  The digest is the SHA-256 of the sorted SHA-256 digests of rows, by two levels of
    prefixes, so that no task holds more than a share of the rows."""
    out = None
    for name, rows in tables.items():
        d = rows.select(F.sha2(line[name], 256).alias("d")).groupBy(F.substring("d", 1, 3).alias("p")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("d")), "\n"), 256).alias("d"), F.count("*").alias("n"))
        one = d.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "d"))), lambda x: x.d), "\n"), 256).alias("digest"), F.sum("n").alias("records")).select(F.lit(name).alias("name"), "records", "digest")
        out = one if out is None else out.unionByName(one)
    return out
