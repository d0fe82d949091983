"""Merges that keep what the new rows don't say, rule engines, and release differences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def baseline_merge(old: DataFrame, new: DataFrame, key: str, overwrite_nulls: bool = False) -> DataFrame:
    """New values win; rows and fields that only the baseline has survive."""
    others = [c for c in old.columns if c != key]
    o = old.select(key, *[F.col(c).alias(f"_o_{c}") for c in others])
    n = new.select(key, *[F.col(c).alias(f"_n_{c}") for c in others], F.lit(True).alias("_in"))
    pick = lambda c: F.when(F.col("_in"), F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")) if overwrite_nulls else F.coalesce(f"_n_{c}", f"_o_{c}")
    return o.join(n, key, "full_outer").select(key, *[pick(c).alias(c) for c in others])


def partition_replace(old: DataFrame, new: DataFrame, replaced, key: str) -> DataFrame:
    """Rows of the replaced part go, then new rows are put in by key."""
    rest = old.where(~F.coalesce(replaced, F.lit(False))).join(new.select(key), key, "left_anti")
    return rest.unionByName(new)


def apply_corrections(rows: DataFrame, key: str, field: str, rules: DataFrame) -> DataFrame:
    """rules (target, action, value, priority, id): the highest priority of a target wins, then the smallest id.

    Actions: set_null, replace, override (only where empty), drop_if_prefix (any case).  `changed` tells whether the value did.
    """
    win = rules.groupBy("target").agg(F.min(F.struct((-F.col("priority")).alias("p"), "id", "action", "value")).alias("r")).select(F.col("target").alias(key), "r.action", "r.value")
    old = F.col(field)
    new = (
        F.when(F.col("action") == "set_null", F.lit(None))
        .when(F.col("action") == "replace", F.col("value"))
        .when(F.col("action") == "override", F.coalesce(F.nullif(old, F.lit("")), F.col("value")))
        .when((F.col("action") == "drop_if_prefix") & F.startswith(F.lower(old), F.lower("value")), F.lit(None))
        .otherwise(old)
    )
    out = rows.join(win, key, "left").withColumn("_new", new)
    return out.withColumn("changed", ~old.eqNullSafe(F.col("_new"))).withColumn(field, F.col("_new")).drop("_new", "action", "value")


def first_rule(rows: DataFrame, text: str, rules: list[tuple[str, str]], found: str) -> DataFrame:
    """The value of the first rule whose part the text holds."""
    out = F.lit(None).cast("string")
    for part, value in reversed(rules):
        out = F.when(F.col(text).contains(part), F.lit(value)).otherwise(out)
    return rows.withColumn(found, out)


def release_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(field, kind, n): rows removed and added, values lost and changed."""
    o = old.select(key, *[F.col(c).cast("string").alias(f"_o_{c}") for c in fields], F.lit(1).alias("_o"))
    n = new.select(key, *[F.col(c).cast("string").alias(f"_n_{c}") for c in fields], F.lit(1).alias("_n"))
    j = o.join(n, key, "full_outer")
    both, full = F.col("_o").isNotNull() & F.col("_n").isNotNull(), lambda c: F.nullif(F.col(c), F.lit("")).isNotNull()
    counts = [("*", "removed", F.col("_n").isNull()), ("*", "added", F.col("_o").isNull())]
    for c in fields:
        counts += [(c, "lost", both & full(f"_o_{c}") & ~full(f"_n_{c}")), (c, "changed", both & ~F.col(f"_o_{c}").eqNullSafe(F.col(f"_n_{c}")))]
    one = j.agg(*[F.count_if(x).alias(f"c{i}") for i, (_, _, x) in enumerate(counts)])
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lit(k).alias("kind"), F.col(f"c{i}").alias("n")) for i, (f, k, _) in enumerate(counts)]))
    return one.select(rows.alias("x")).select("x.*")
