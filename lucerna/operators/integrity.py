"""Constraint checks: each yields (level, file, message, record_id)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def issue(rows: DataFrame, level: str, file: str, message: Column, record: Column) -> DataFrame:
    return rows.select(F.lit(level).alias("level"), F.lit(file).alias("file"), message.alias("message"), record.cast("string").alias("record_id"))


def dangling(rows: DataFrame, fk: str, ref: DataFrame, key: str) -> DataFrame:
    """Rows whose foreign key is given and not in the reference."""
    return rows.where(F.col(fk).isNotNull()).join(ref.select(F.col(key).alias(fk)).distinct(), fk, "left_anti")


def repeats(rows: DataFrame, keys: list[str], record: str, order: list[str]) -> DataFrame:
    """Rows after the first of their key, with the first one's id; the order tells any two rows of a key apart, null keys are equal.

    The first is found by an aggregate, and only keys of several rows are joined, so a frequent key is no long window.
    """
    at = F.struct(*order)
    first = rows.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.min(at).alias("_first"), F.min_by(record, at).alias("first_id"), F.count("*").alias("_n")).where("_n > 1")
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return rows.join(first, same).where(at > F.col("_first")).select(*rows.columns, "first_id")


def conflicts(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys with more than one value, and their values in order."""
    return rows.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(value)), ",").alias("found"), F.min(value).alias("_a"), F.max(value).alias("_b")).where("_a <> _b").drop("_a", "_b")


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
