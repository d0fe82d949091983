"""Document fingerprints by a threshold-scaled sketch.

A sketch keeps every hash of a five-word shingle (A-Z lower-cased) that lies below 1 / SCALE of the hash range, so its size follows the
document's, sketches of parts merge by union, and both similarity and containment are estimated between documents of any sizes.  A
document whose hashes all lie above keeps its least one, marked, and is like another only if that is equal.

The next document by descending doc_id comes from one range-wise exchange of the texts: doc_ids are counted in equal-width bins, bins are
dealt to ranges of about equal numbers, each range is sorted, and the first document of the range below is added to its end.

Nulls and edges: a null text is empty; two sketches without shingles are alike (1), one is like no other (0); rows that share a doc_id
follow one another by descending text; a row without doc_id has no neighbours and is its own next document, as is the only document of
a table; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, hashed, ids, raw, shingles, slices, split_all, texts

SCALE, BINS = 4, 4096
LIMIT = np.uint64((1 << 64) // SCALE)
RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, contained_edited double, contained_next double"


def sketches(data: list[bytes]) -> list[np.ndarray]:
    """Sorted kept hashes of each text; a single one at or above LIMIT if none lies below."""
    words, starts = split_all([t.lower() for t in data])
    h = hashed(words)
    out = []
    for s, e in zip(starts[:-1], starts[1:]):
        x = shingles(h[s:e])
        out.append(x[: max(min(1, len(x)), int(np.searchsorted(x, LIMIT)))])
    return out


def fingerprint(x: np.ndarray) -> str:
    """40 leading bits of each kept hash below the limit as hex digits; `m` and all 64 bits of a least one above."""
    if len(x) == 1 and x[0] >= LIMIT:
        return f"m{int(x[0]):016x}"
    return ((x << np.uint64(2)) >> np.uint64(24)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes().hex()


def likeness(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Estimates of the Jaccard similarity and of the share of x's shingles that y holds."""
    if not len(x) or not len(y):
        return (float(len(x) == len(y)),) * 2
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both), both / len(x)


def edited(text: str, following: str) -> str:
    m = len(text) // 3
    return text[: len(text) - m] + following[:m]


def _run(batches):
    held = None  # (range, doc_id, text, sketch) whose next document hasn't come
    for b in slices(batches):
        data = raw(b)
        rows = list(zip(ids(b, "part").to_pylist(), ids(b).to_pylist(), ids(b, "added").to_pylist(), (t.decode() for t in data), sketches(data)))
        pairs = []
        for part, d, added, text, x in rows:
            if part < 0:
                pairs.append((d, text, x, text, x))
                continue
            if held and held[0] == part:
                pairs.append((*held[1:], text, x))
            held = None if added else (part, d, text, x)
        if not pairs:
            continue
        new = [edited(p[1], p[3]) for p in pairs]
        coded = [t.encode() for t in new]
        own = sketches(coded)
        like = [likeness(p[2], y) for p, y in zip(pairs, own)]
        after = [likeness(p[2], p[4]) for p in pairs]
        columns = [[p[0] for p in pairs], [len(p[1]) for p in pairs], [hashlib.sha256(t).hexdigest() for t in coded], [fingerprint(p[2]) for p in pairs], [fingerprint(y) for y in own], [x[0] for x in like], [x[0] for x in after], [x[1] for x in like], [x[1] for x in after]]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in RESULT.split(", ")])


def fingerprints(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    n = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts(docs)
    low, high, total = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    part = F.lit(None).cast("int")
    if total:
        width = -(-(high - low + 1) // BINS)
        place = F.expr(f"cast((cast(doc_id as decimal(20,0)) - cast('{low}' as decimal(20,0))) div cast('{width}' as decimal(20,0)) as int)")
        counts = dict(rows.where("doc_id is not null").groupBy(place.alias("bin")).count().collect())  # BINS rows at most
        at, of = 0, []
        for b in range(BINS):
            of.append(at * n // total)
            at += counts.get(b, 0)
        part = F.when(F.col("doc_id").isNotNull(), F.element_at(F.lit(of), place + 1))
    part = F.coalesce(part, -1 - F.pmod(F.xxhash64("text"), F.lit(n)).cast("int"))  # rows without id have no neighbours and may be anywhere
    rows = rows.select("doc_id", "text", part.alias("part"), F.lit(False).alias("added"))
    if total:
        tops = dict(rows.where("part >= 0").groupBy("part").agg(F.max("doc_id")).collect())  # a row for each range
        order = sorted(tops)
        below = spark.createDataFrame([(p, tops[order[i - 1]]) for i, p in enumerate(order)], "part int, doc_id long")
        first = texts(docs).where(F.col("doc_id").isin(list(tops.values()))).groupBy("doc_id").agg(F.max("text").alias("text"))
        rows = rows.unionByName(first.join(F.broadcast(below), "doc_id").select("doc_id", "text", "part", F.lit(True).alias("added")))
    dealt = rows.repartition(n, "part").sortWithinPartitions(F.asc("part"), F.asc("added"), F.desc("doc_id"), F.desc("text"))
    return dealt.mapInArrow(_run, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))
