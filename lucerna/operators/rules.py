"""Checks of tables against declared fields, checkpoints and pagination."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def schema_errors(rows: DataFrame, key: str, required: list[str] = (), enums: dict[str, list] | None = None, minimum: dict[str, float] | None = None, patterns: dict[str, str] | None = None) -> DataFrame:
    """(key, field, error) of every broken declaration, in one pass over the rows."""
    tests: list[tuple[str, str, Column]] = [(c, "required", F.col(c).isNull()) for c in required]
    tests += [(c, "enum", ~F.col(c).isin(v)) for c, v in (enums or {}).items()]
    tests += [(c, "minimum", F.col(c) < v) for c, v in (minimum or {}).items()]
    tests += [(c, "pattern", ~F.col(c).rlike(v)) for c, v in (patterns or {}).items()]
    found = F.array(*[F.when(bad, F.struct(F.lit(c).alias("field"), F.lit(e).alias("error"))) for c, e, bad in tests])
    return rows.select(key, F.explode(F.filter(found, lambda x: x.isNotNull())).alias("x")).select(key, "x.*")


def cut(rows: DataFrame) -> DataFrame:
    """rows from the folder that spark.checkpoint.dir names; where it is unset, a folder of this machine, which only a local master may use."""
    sc = rows.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        base = rows.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not base and not re.match(r"local($|\[)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(base or tempfile.mkdtemp())
    return rows.checkpoint()


def pages_in_order(first: DataFrame, pages: DataFrame, limit: int | None = None) -> DataFrame:
    """Follows `next` from the first urls over replayed pages (url, next), each url once, to the end or at most `limit` steps: (url, step).

    A frontier a step; what was visited is left out before the next one.
    """
    seen = front = cut(first.select("url", F.lit(0).alias("step")).join(pages.select("url"), "url", "left_semi"))
    i = 0
    while limit is None or i < limit:
        i += 1
        front = front.join(pages, "url").where("next is not null").select(F.col("next").alias("url"), F.lit(i).alias("step")).distinct()
        front = cut(front.join(pages.select("url"), "url", "left_semi").join(seen.select("url"), "url", "left_anti"))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen
