"""Scans: Parquet tables of a directory, lenient and strict JSON arrays, replayed responses, pagination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .requests import cache_key


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt over all cores in turn.  Scans are cut by bytes, and a small file whose rows are much work would be one task's."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def json_array(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Objects of a JSON array.  Lenient: a missing file or one that is no array has no rows and other elements are left out.  Strict: they raise."""
    if not strict:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            return spark.createDataFrame([], schema)
    text = spark.read.text(path, wholetext=True)
    items = text.select(F.from_json("value", "array<string>").alias("items"))
    if strict:
        bad = text.where(F.from_json("value", "array<string>").isNull() | F.exists(F.from_json("value", "array<string>"), lambda x: ~F.startswith(F.ltrim(x), F.lit("{"))))
        if not bad.isEmpty():
            raise ValueError(f"{path} is not an array of objects")
    rows = items.select(F.explode("items").alias("v")).where(F.startswith(F.ltrim("v"), F.lit("{"))).select(F.from_json("v", schema).alias("r"))
    return rows.select("r.*")


def json_texts(rows: DataFrame, key: str, text: str, schema: str) -> DataFrame:
    """Objects of the JSON arrays that a column holds; a text that is no array has no rows, other elements are left out."""
    items = rows.select(key, F.explode(F.from_json(text, "array<string>")).alias("v"))
    return items.where(F.startswith(F.ltrim("v"), F.lit("{"))).select(key, F.from_json("v", schema).alias("r")).select(key, "r.*")


def replayed(requests: DataFrame, responses: DataFrame, strict: bool = False) -> DataFrame:
    """Bodies for (method, url); misses are left out, or raise when the plan runs.

    If both have a payload (JSON or null), requests are met by method, url and payload, in whatever form the payload is written.
    """
    if "payload" in requests.columns and "payload" in responses.columns:
        keyed = lambda x: x.withColumn("_key", cache_key(F.col("method"), F.col("url"), F.col("payload")))
        out = keyed(requests).join(keyed(responses).select("_key", "body"), "_key", "left").drop("_key")
    else:
        out = requests.join(responses.select("method", "url", "body"), ["method", "url"], "left")
    if strict:
        return out.withColumn("body", F.coalesce("body", F.raise_error(F.concat(F.lit("missing "), "url")).cast("string")))
    return out.where("body is not null")


def write_json(rows: DataFrame, path: str, key: str) -> None:
    """JSON lines ordered by key, with sorted fields and without nulls."""
    rows.select(*sorted(rows.columns)).repartitionByRange(key).sortWithinPartitions(key).write.json(path)
