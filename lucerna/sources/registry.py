"""Folders of datasets: objects, the registry of sources, placeholders, seeds, and which folder may be written."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Datasets that a folder has even where nothing was crawled.
PLACEHOLDERS = ("aliases", "departments", "entity_links", "people", "places")


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _path(spark, path)
    return fs.exists(at)


def json_object(spark: SparkSession, path: str, strict: bool = False) -> dict:
    """The object of a JSON document of reviewed size.  Lenient: empty if it is missing or no object; strict: ValueError."""
    if not exists(spark, path):
        if strict:
            raise ValueError(f"{path} is missing")
        return {}
    text = spark.read.text(path, wholetext=True).first()
    try:
        found = json.loads(text[0]) if text else None
    except ValueError:
        found = None
    if not isinstance(found, dict):
        if strict:
            raise ValueError(f"{path} is no object")
        return {}
    return found


def upsert_sources(old: DataFrame, new: DataFrame) -> DataFrame:
    """The registry of sources with new entries in place of those of their id, whole; of several new ones the last by `ordinal`."""
    names = [c for c in old.columns if c != "source_id"]
    latest = new.groupBy("source_id").agg(F.max_by(F.struct(*names), "ordinal").alias("_n")) if "ordinal" in new.columns else new.select("source_id", F.struct(*names).alias("_n"))
    both = old.select("source_id", F.struct(*names).alias("_o")).join(latest, "source_id", "full_outer").withColumn("_r", F.coalesce("_n", "_o"))
    return both.select("source_id", *[F.col(f"_r.{c}").alias(c) for c in names])


def dataset_paths(folder: str, names) -> dict[str, str]:
    return {name: f"{folder.rstrip('/')}/{name}.jsonl" for name in names}


def placeholders(spark: SparkSession, folder: str, schemas: dict[str, str]) -> list[str]:
    """Writes empty datasets for those that a folder lacks, and says which."""
    made = []
    for name, path in dataset_paths(folder, PLACEHOLDERS).items():
        if not exists(spark, path) and not exists(spark, path.removesuffix("l")):
            spark.createDataFrame([], schemas[name]).write.json(path)
            made.append(name)
    return made


def seed(spark: SparkSession, source: str, target: str, names) -> list[str]:
    """Copies the datasets that the source folder has, and says which."""
    if same_folder(spark, source, target):
        raise ValueError("a folder is no seed of itself")
    done = []
    for name in names:
        for end in ("json", "jsonl"):
            at, fs = _path(spark, f"{source.rstrip('/')}/{name}.{end}")
            if fs.exists(at):
                to, there = _path(spark, f"{target.rstrip('/')}/{name}.{end}")
                there.delete(to, True)
                spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, at, there, to, False, spark._jsc.hadoopConfiguration())
                done.append(name)
    return done


def same_folder(spark: SparkSession, a: str, b: str) -> bool:
    of = lambda p: _path(spark, p.rstrip("/"))[1].makeQualified(_path(spark, p.rstrip("/"))[0]).toString()
    return of(a) == of(b)


def guard(spark: SparkSession, target: str, canonical: str, allowed: bool, seed_from: str | None = None) -> None:
    """Refuses to write the canonical folder unless that is allowed, and a folder that is its own seed."""
    if same_folder(spark, target, canonical) and not allowed:
        raise PermissionError(f"{target} is the canonical folder")
    if seed_from and same_folder(spark, target, seed_from):
        raise ValueError("a folder is no seed of itself")
