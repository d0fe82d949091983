"""How five filters interact: what each removes at each place of each order, and what of it another one would have removed.

1. The filters A to D judge each text where it is read; what goes on is doc_id, part, mask and the text's fingerprint (SHA-256).  These rows are
   range-sorted by fingerprint and doc_id, so bounds have a fixed size, and a large group of copies is dealt over many tasks.
2. A task compares each fingerprint with the one before it; equal texts are those of equal fingerprints.  A row is a duplicate (filter E) if its doc_id is larger than the first of its run of equal
   texts.  Only rows that have the very doc_id a task begins with can depend on the task before; they carry their fingerprint.  Each task
   also says which text it ends with and the smallest doc_id it has of it, one row a task, and the open rows are decided by these.
3. The five failures are bits of a mask.  Documents are counted by part, mask and labels, and only these counts (32 masks and 4 kinds of
   labels a part at most) meet the table of what each order does with each mask.

Texts don't move and no task sorts them; a lost task is run again from its range.

Nulls and edges: a null text is empty, and empty texts equal each other; a null lang is the part ''; a null doc_id is never a duplicate, makes no
other row one and has no labels; repeated rows are counted each, and rows that share doc_id and text are duplicates of a smaller doc_id only;
a doc_id with several labels is good (toxic) if any says so; an empty table has no parts and no rows; other columns are ignored; whole texts
of any length are read.
"""

from __future__ import annotations

import re
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, ids, raw, slices, texts

# The filters and their bounds.
LETTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
_SIGNS = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(65, 91))
_FOLLOWING = bytes(range(128, 192))

_JUDGED = "doc_id long, part string, sha string, mask int"
_SORTED = "doc_id long, part string, mask int, sha string, low long"


def failures(text: bytes) -> int:
    """Bits of the filters A to D that a text (UTF-8) fails."""
    words = text.split()
    points = len(text.translate(None, _FOLLOWING))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (len(words) < LEAST_WORDS) | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1 | (100 * capitals > MOST_CAPITALS * points) << 2 | bool(_SIGNS.search(text)) << 3


def _judged(batches):
    """Rows without their text, which its fingerprint stands for, each with the bits of the filters A to D."""
    for b in slices(batches):
        kept = [b.column(b.schema.get_field_index(c)) for c in ("doc_id", "part", "sha")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array([failures(x) for x in raw(b)], pa.int32())], names=["doc_id", "part", "sha", "mask"])


def _compared(batches):
    """Rows of one sorted range, each with its mask; sha is set on rows that the range before decides, and on the last row, which has no
    mask and says the smallest doc_id (low) of the text that the range ends with."""
    before, low, head, sha = None, None, True, None
    for b in slices(batches, "sha"):
        out = []
        hashes, parts, failed = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("sha", "part", "mask"))
        for own, doc_id, part, mask in zip(hashes, ids(b).to_pylist(), parts, failed):
            if own != before:
                head = before is None
                before, low, sha = own, doc_id, own
            copy = doc_id is not None and doc_id > low
            out.append((doc_id, part, mask | copy << 4, own if head and doc_id is not None and not copy else None, None))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64()))], names=["doc_id", "part", "mask", "sha", "low"])
    if sha is not None:
        yield pa.RecordBatch.from_pylist([{"doc_id": None, "part": None, "mask": None, "sha": sha, "low": low}], schema=pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("sha", pa.string()), ("low", pa.int64())]))


def masks(docs: DataFrame, scratch: Scratch, part: str = "lang") -> DataFrame:
    """doc_id, part and mask (bit i: fails the filter of letter i) of every row."""
    keyed = texts(docs, F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part")).withColumn("sha", F.sha2("text", 256))
    judged = scratch.table(keyed.mapInArrow(_judged, _JUDGED), "judged")
    ranged = judged.repartitionByRange("sha", "doc_id").sortWithinPartitions("sha", F.asc_nulls_last("doc_id"))
    found = scratch.table(ranged.mapInArrow(_compared, _SORTED), "compared")
    ends = found.where("mask is null").groupBy("sha").agg(F.min("low").alias("first"))  # a row a task at most
    rows = found.where("mask is not null").drop("low")
    copy = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    return rows.join(F.broadcast(ends), "sha", "left").select("doc_id", "part", F.when(copy, F.col("mask").bitwiseOR(16)).otherwise(F.col("mask")).alias("mask"))


def effects(spark: SparkSession) -> DataFrame:
    """What each order's steps do with a document of each mask: 120 orders, 5 steps, 32 masks."""
    rows = []
    for order in permutations(range(5)):
        name, gone = "".join(LETTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            own = 1 << i
            for m in range(32):
                fails, earlier = bool(m & own), bool(m & gone)
                rows.append((name, step, m, int(not m & (gone | own)), int(fails and not earlier), int(fails and earlier), int(m == own), 120 // m.bit_count() if fails else 0))
            gone |= own
    return spark.createDataFrame(rows, "filter_order string, step int, mask int, kept int, removed int, redundant int, alone int, share int")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Counters of every part, order and step."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    marked = F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id is not null").groupBy("doc_id").agg(*marked)
    said = masks(docs, scratch, part).join(known, "doc_id", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("int").alias(c)
    cells = scratch.table(said.groupBy("part", "mask", yes("good"), yes("toxic")).agg(F.count("*").alias("n")), "cells")
    total = lambda c, name: F.sum(F.col("n") * c).cast("long").alias(name)
    kept, removed, redundant, alone, share = map(F.col, ("kept", "removed", "redundant", "alone", "share"))
    sums = total(kept, "kept"), total(removed, "removed"), total(redundant, "redundant"), total(alone, "unique_fails"), total(removed * F.col("good"), "good_lost"), total(removed * F.col("toxic"), "toxic_lost"), total(share, "shapley")
    return cells.join(F.broadcast(effects(spark)), "mask").groupBy("part", "filter_order", "step").agg(*sums)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLE = r"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws, min(doc_id) over (partition by t) as first_id from d),
f as (select doc_id, part, [len(ws) < 100, 100 * len(list_distinct(ws)) < 80 * len(ws), 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > first_id, false)] as x from w),
g as (select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic from labels group by doc_id),
c as (select part, x, coalesce(good, false) as good, coalesce(toxic, false) as toxic, count(*) as n from f left join g using (doc_id) group by all),
l as (select unnest(['A', 'B', 'C', 'D', 'E']) as a, unnest([1, 2, 3, 4, 5]) as i),
o as (select [p.i, q.i, r.i, s.i, u.i] as places, p.a || q.a || r.a || s.a || u.a as filter_order from l p, l q, l r, l s, l u where len(list_distinct([p.i, q.i, r.i, s.i, u.i])) = 5),
e as (select filter_order, places, unnest([1, 2, 3, 4, 5]) as step from o),
y as (select part, filter_order, step, places[step] as own, n, good, toxic, x[places[step]] as fails, list_bool_or(list_transform(places[1:step - 1], lambda p: x[p])) as earlier, len(list_filter(x, lambda b: b)) as fails_all from c, e),
z as (select part, filter_order, step, any_value(own) as own, sum(n) filter (not fails and not coalesce(earlier, false)) as kept, sum(n) filter (fails and not coalesce(earlier, false)) as removed, sum(n) filter (fails and coalesce(earlier, false)) as redundant,
  sum(n) filter (fails and fails_all = 1) as unique_fails, sum(n) filter (fails and not coalesce(earlier, false) and good) as good_lost, sum(n) filter (fails and not coalesce(earlier, false) and toxic) as toxic_lost from y group by part, filter_order, step)
select part, filter_order, step::int as step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost,
  coalesce(toxic_lost, 0)::bigint as toxic_lost, (sum(coalesce(removed, 0)) over (partition by part, own))::bigint as shapley from z
"""
