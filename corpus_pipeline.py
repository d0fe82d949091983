"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's docs.  All but
the last return the columns of documents.

1. language ID: documents without any letter (`und`) go; `lang` becomes what was found.  A doubtful language is no reason to go.
2. near-dedup: of each group of near-duplicates the smallest doc_id stays.
3. substring dedup: words that stand in a window of 50 which a smaller doc_id also has go; `n_chars` follows.  A document stays even if
   nothing of its text does.
4. decontamination: contaminated documents go.
5. packing: the pieces of what is left, with their places in sequences.

Rows that share a doc_id stay or go together; rows without one are never near-duplicates, shortened or dropped for contamination.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lucerna.llm.common import Scratch, having, remainder
from lucerna.llm.op1_minhash import near_duplicates
from lucerna.llm.op2_language import identify
from lucerna.llm.op4_substring import substring_dedup
from lucerna.llm.op9_decontamination import decontaminate
from lucerna.llm.op10_packing import pack

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = identify(docs, docs.where(remainder("doc_id", 4) != 2), carry=COLUMNS).where("lang_pred <> 'und'")
    return found.select("row.*", "text", "lang_pred").withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = near_duplicates(docs).where("not kept and doc_id is not null").select("doc_id").distinct()
    return having(docs, gone, Scratch(spark), without=True).select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    changed = scratch.table(substring_dedup(docs).where("n_removed > 0 and doc_id is not null").groupBy("doc_id").agg(F.first("kept_text").alias("text")), "changed")
    same = having(docs, changed, scratch, without=True)
    rest = having(docs.drop("text"), changed, scratch).join(changed, "doc_id").withColumn("n_chars", F.length("text").cast("long"))
    return same.select(*COLUMNS).unionByName(rest.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated and doc_id is not null").select("doc_id").distinct()
    return having(docs, gone, Scratch(spark), without=True).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("language_id", language), ("near_dedup", near_dedup), ("substring_dedup", substrings), ("decontamination", decontamination), ("packing", packing)]

#: SQL can express neither the language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
