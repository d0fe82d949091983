"""Links between entities: word and pattern candidates, rule chains whose targets must exist, link rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import unique_only


def word_links(rows: DataFrame, key: str, words: Column, targets: DataFrame) -> DataFrame:
    """(key, target) where the row's words name exactly one target; targets has word and target.  An equi join by word, not a substring test."""
    named = rows.select(key, F.explode(F.array_distinct(words)).alias("word")).join(targets, "word")
    return unique_only(named, key, "target")


def existing_rule(rows: DataFrame, rules: list[tuple[Column, Column]], targets: DataFrame, target: str, found: str) -> DataFrame:
    """The first matching rule's target that exists; a rule whose target is missing falls through."""
    out = rows
    for i, (cond, value) in enumerate(rules):
        known = targets.select(F.col(target).alias(f"_t{i}")).distinct()
        out = out.withColumn(f"_v{i}", F.when(cond, value)).join(known, F.col(f"_v{i}") == F.col(f"_t{i}"), "left")
    return out.withColumn(found, F.coalesce(*[F.col(f"_t{i}") for i in range(len(rules))])).drop(*[f"_{x}{i}" for i in range(len(rules)) for x in "vt"])


def link_id(parent: Column, relation: Column, child: Column) -> Column:
    return F.concat_ws("__", parent, F.lower(relation), child)
