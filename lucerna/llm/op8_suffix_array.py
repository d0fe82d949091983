"""Suffix-array dedup over bytes by external induced sorting.

A string of LEAST bytes is keyed by the least hash of its 64-byte substrings, so equal strings have equal keys wherever they stand, and so
have the 400-byte strings that begin with them.  Neighbouring strings of one key make a segment of a document, to the end of the last
400-byte string that begins in it.

1. The keys of all segments meet; a key that stands in one place only rules its strings out.  Of equal documents one stands for all: each byte of
   each of them goes if they are long enough.
2. Segments with shared keys are brought together by key, equal contents once with their number, and cut at keys into shards of about
   `shard` bytes.  A shard's suffixes are ordered by induced sorting (induced.py), whose queues go to disk beyond `memory` bytes, so a
   single key may be far larger than a shard.  Neighbours in the order with 400 bytes in common mark repeated strings; those with
   LEAST bytes in common tell the longest run of a document that repeats, which is only reported.
3. Repeated strings go back to the documents that hold the segment; covered bytes go.

Common prefixes are compared once the order is known (two 64-bit hashes of the 400 bytes) and not carried through the induction.

Nulls and edges: a null text is empty; texts under 400 bytes lose nothing (and share nothing under LEAST bytes); rows that share a doc_id and text count as copies of each other;
a null doc_id takes part like any other; an empty table gives no rows; other columns are ignored.  A row is told apart by doc_id and text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, having, ids, raw, slices, spans_of, texts, window_hashes
from .induced import repeated

WIDTH, LEAST, GRAM = 400, 256, 64
SHARD, MEMORY = 2 << 20, 64 << 20
NOTHING = hashlib.sha256(b"").hexdigest()
BASE = 0x9E3779B97F4A7C15
SCANNED = "doc_id long, n_bytes long, sha string, segments array<struct<key:long,start:int,n:int,moves:boolean>>"


def segments(text: np.ndarray, starts: np.ndarray, width: int = LEAST, gram: int = GRAM):
    """Document, key, first string, number of strings and whether the key's place moves, for each segment; starts: where documents begin, and the end."""
    n = np.maximum(np.diff(starts) - width + 1, 0)
    none = np.zeros(0, np.int64)
    if not n.sum():
        return none, none, none, none, none.astype(bool)
    g = window_hashes(text.astype(np.uint64) + np.uint64(1), gram, BASE)
    bits = np.uint64(len(g).bit_length())  # the leftmost of equal hashes, by its place in the low bits
    packed = (g >> bits << bits) | np.arange(len(g), dtype=np.uint64)
    span = width - gram + 1  # minima over so many grams: of a block's end and the next one's beginning
    size = -(-len(g) // span) * span
    padded = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(g)] = packed
    square = padded.reshape(-1, span)
    forward = np.minimum.accumulate(square, axis=1).ravel()
    backward = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(backward[: len(g) - span + 1], forward[span - 1 : len(g)])
    doc = np.repeat(np.arange(len(n)), n)
    at = np.repeat(starts[:-1] - np.cumsum(n) + n, n) + np.arange(n.sum())
    place = (low[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    key = g[place].view(np.int64)
    head = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]))
    tail = np.append(head[1:], len(at)) - 1
    return doc[head], key[head], at[head] - starts[doc[head]], tail - head + 1, place[head] != place[tail]


def _scanned(batches):
    kind = pa.list_(pa.struct([("key", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("moves", pa.bool_())]))
    for b in slices(batches, limit=1 << 19):
        data = raw(b)
        sizes = np.array([len(x) for x in data], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        doc, key, start, n, moves = segments(np.frombuffer(b"".join(data), np.uint8), starts)
        offsets = pa.array(np.searchsorted(doc, np.arange(len(starts))).astype(np.int32))
        values = pa.StructArray.from_arrays([pa.array(key), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(moves)], fields=list(kind.value_type))
        yield pa.RecordBatch.from_arrays([ids(b), pa.array(sizes), pa.array([hashlib.sha256(x).hexdigest() for x in data]), pa.ListArray.from_arrays(offsets, values, type=kind)], names=["doc_id", "n_bytes", "sha", "segments"])


def _contents(batches):
    """(sha, start, key, n, digest, content) of the segments listed with each text."""
    for b in slices(batches, limit=1 << 18):
        out = ([], [], [], [], [], [])
        for sha, t, segs in zip(ids(b, "sha").to_pylist(), raw(b), ids(b, "segments").to_pylist()):
            for s in segs:
                part = t[s["start"] : s["start"] + s["n"] - 1 + WIDTH]
                for col, x in zip(out, (sha, s["start"], s["key"], s["n"], xxhash.xxh3_128_digest(part, s["n"]), part)):
                    col.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["sha", "start", "key", "n", "digest", "content"])


def _sorted_shards(shard: int, memory: int):
    def solve(rows):
        key, digest, copies, starts, content = (list(x) for x in zip(*rows))
        out = ([], [], [], [])
        for k, d, c, n, most, found in zip(key, digest, content, copies, starts, repeated(content, (WIDTH, LEAST), memory, starts)):
            places = [np.arange(min(most, max(0, len(c) - w + 1))) for w in (WIDTH, LEAST)] if n > 1 else found
            if len(places[1]):
                for col, x in zip(out, (k, d, *(np.array(spans_of(p, 1), np.int32).ravel() for p in places))):
                    col.append(x)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())))], names=["key", "digest", "spans", "near"])

    def run(batches):
        rows, size = [], 0
        for b in batches:
            for row in zip(ids(b, "key").to_pylist(), ids(b, "digest").to_pylist(), ids(b, "copies").to_pylist(), ids(b, "n").to_pylist(), ids(b, "content").to_pylist()):
                if size >= shard and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
        if rows:
            yield solve(rows)

    return run


def _kept(batches):
    for b in slices(batches):
        removed, spans_n, sha, left, longest = [], [], [], [], []
        for t, lists in zip(raw(b), ids(b, "found").to_pylist()):
            wide, near = (spans_of(np.concatenate([np.arange(x["start"] + a, x["start"] + e) for x in lists for a, e in zip(x[c][::2], x[c][1::2])] or [np.zeros(0, np.int64)]), w) for c, w in (("spans", WIDTH), ("near", LEAST)))
            out, at = [], 0
            for s, e in wide:
                out.append(t[at:s])
                at = e
            out = b"".join([*out, t[at:]])
            removed.append(len(t) - len(out))
            spans_n.append(len(wide))
            sha.append(hashlib.sha256(out).hexdigest())
            left.append(out if wide else None)
            longest.append(max(e - s for s, e in near))
        yield pa.RecordBatch.from_arrays([ids(b, "sha"), pa.array(removed, pa.int64()), pa.array(spans_n, pa.int64()), pa.array(sha, pa.string()), pa.array(left, pa.binary()), pa.array(longest, pa.int64())], names=["sha", "n_removed", "n_spans", "kept_sha256", "kept", "longest_shared"])


def suffix_dedup(docs: DataFrame, shard: int = SHARD, memory: int = MEMORY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept: the bytes left, or null where none went, and longest_shared: bytes of the
    longest run covered by strings of LEAST bytes that also start elsewhere (0 without any).
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    scanned = scratch.table(texts(docs).mapInArrow(_scanned, SCANNED), "scanned")
    classes = scanned.where(f"n_bytes >= {LEAST}").groupBy("sha").agg(F.count("*").alias("copies"), F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("first_id"))
    member = scratch.table(scanned.join(classes, "sha", "left").withColumn("own", F.coalesce("doc_id", F.lit(-(1 << 63))) == F.col("first_id")).withColumn("segments", F.when(F.col("own"), F.col("segments"))), "members")
    scratch.drop(scanned)
    listed = member.where("own").select("sha", F.col("doc_id"), "segments").dropDuplicates(["sha"])
    rows = listed.select("sha", "doc_id", F.inline("segments"))
    shared = scratch.table(rows.groupBy("key").agg(F.count("*").alias("k"), F.max("moves").alias("moves")).where("k > 1 or moves").select("key"), "shared")
    wanted = rows.join(shared, "key").groupBy("doc_id", "sha").agg(F.collect_list(F.struct("key", "start", "n")).alias("segments"))
    wanted = scratch.table(wanted, "wanted")
    somewhere = having(texts(docs), wanted.select("doc_id").where("doc_id is not null").distinct(), scratch).unionByName(texts(docs.where("doc_id is null")))
    keyed = somewhere.join(wanted.withColumnRenamed("doc_id", "id"), F.col("doc_id").eqNullSafe(F.col("id"))).drop("id")
    candidates = scratch.table(keyed.where(F.sha2(F.col("text").cast("binary"), 256) == F.col("sha")).dropDuplicates(["sha"]), "candidates")
    scratch.drop(wanted)
    parts = candidates.mapInArrow(_contents, "sha string, start int, key long, n int, digest binary, content binary")
    distinct = parts.groupBy("key", "digest").agg(F.count("*").alias("copies"), F.first("n").alias("n"), F.first("content").alias("content"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spans = distinct.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_sorted_shards(shard, memory), "key long, digest binary, spans array<int>, near array<int>")
    spans = scratch.table(spans, "spans")
    found = parts.drop("content", "n").join(spans, ["key", "digest"]).groupBy("sha").agg(F.collect_list(F.struct("start", "spans", "near")).alias("found"))
    kept = scratch.table(candidates.select("doc_id", "sha", "text").join(found, "sha").mapInArrow(_kept, "sha string, n_removed long, n_spans long, kept_sha256 string, kept binary, longest_shared long"), "kept")
    scratch.drop(candidates, spans)
    again = F.coalesce("copies", F.lit(1)) > 1
    copy = again & (F.col("n_bytes") >= WIDTH)
    return member.join(kept, "sha", "left").select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(NOTHING)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        F.when(again, F.col("n_bytes")).otherwise(F.coalesce("longest_shared", F.lit(0))).cast("long").alias("longest_shared"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir)).drop("kept")
