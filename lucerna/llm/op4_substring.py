"""Substring dedup by recompression (Jez, 2013), over words.

Rounds rename runs of one symbol and then pairs of a left and a right symbol, the side of a symbol drawn from its name.  A new name is a
hash of what it stands for, so it is the same in every document without a table of names to agree on.  Each symbol carries the words
that it depends on: its own, and the neighbours that decided how it was parsed.  A window of 50 words therefore fixes, by its content
alone, which symbols it holds with all they depend on; equal windows hold the same ones.  A window's key is the least name among the
longest of them; a window without any (such as one within a long run) takes its key from fewer rounds, in the end from its words.

1. The keys of all documents (a few per 50 words) meet; a key seen in one document only rules its windows out.
2. Windows with shared keys are verified: equal hashes of all 50 words (96 bits), and the smallest doc_id that holds them.
3. Words covered by a window that also starts in a smaller doc_id go.

Equal documents are settled beforehand: all but the smallest doc_id lose every word, if they have a window at all.

Nulls and edges: null texts have no words; documents with fewer than 50 words lose none; a null doc_id is no smaller than any and loses
nothing; rows that share a doc_id are the same document; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, hashed, having, ids, mix, range_minima, raw, slices, spans_of, split_all, texts, window_hashes

WINDOW, LEVELS = 50, 4
NOTHING = hashlib.sha256(b"").hexdigest()
PARSED = "doc_id long, n_words long, sha string, keys array<long>"
BASES = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03


def parse(h: np.ndarray, starts: np.ndarray, levels: int = LEVELS):
    """Names and lengths of the symbols after the rounds, and the first and last word that each depends on (outside the document: on its edge)."""
    sym, first = h, np.arange(len(h))
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    last, lo, hi = first, first, first
    for level in range(levels):
        if not len(sym):
            break
        new = doc[1:] != doc[:-1]  # a document begins
        for step in ("runs", "pairs"):
            inner_l = np.concatenate([[False], ~new])
            inner_r = np.concatenate([~new, [False]])
            left = np.where(inner_l, np.concatenate([[0], lo[:-1]]), first - 1)
            right = np.where(inner_r, np.concatenate([hi[1:], [0]]), last + 1)
            if step == "runs":
                head = np.flatnonzero(np.concatenate([[True], (sym[1:] != sym[:-1]) | new]))
                tail = np.append(head[1:] - 1, len(sym) - 1)
                n = tail - head + 1
                name = np.where(n > 1, mix(sym[head] + mix(n.astype(np.uint64))), sym[head])
                lo, hi = left[head], right[tail]
            else:
                side = (mix(sym + np.uint64(level + 1)) & np.uint64(1)).astype(bool)  # right
                pair = np.concatenate([~side[:-1] & side[1:] & ~new, [False]])
                second = np.concatenate([[False], pair[:-1]])
                lo = np.where(side & ~second, left, lo)
                hi = np.where(~side & ~pair, right, hi)
                head = np.flatnonzero(~second)
                tail = head + pair[head]
                name = np.where(pair[head], mix(mix(sym[head]) + sym[tail]), sym[head])
                lo, hi = lo[head], hi[tail]
            sym, first, last, doc = name, first[head], last[tail], doc[head]
            new = doc[1:] != doc[:-1]
    return sym, last - first + 1, lo, hi


def window_keys(h: np.ndarray, starts: np.ndarray, window: int = WINDOW):
    """Starts of all windows, their document and their key."""
    n = np.maximum(np.diff(starts) - window + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    at = np.repeat(starts[:-1] - np.cumsum(n) + n, n) + np.arange(n.sum())
    key, open_ = np.zeros(len(at), np.uint64), np.arange(len(at))
    for levels in (LEVELS, 2, 0):
        if not len(open_):
            break
        sym, length, lo, hi = parse(h, starts, levels)
        short = np.uint64(3) - np.minimum(length, 4).astype(np.uint64) + np.uint64(1)  # 0 for four words or more
        name = (mix(sym + np.uint64(levels)) >> np.uint64(2)) | (short << np.uint64(62))
        a, b = np.searchsorted(lo, at[open_], "left"), np.searchsorted(hi, at[open_] + window - 1, "right")
        has = b > a
        key[open_[has]] = range_minima(name, a[has], b[has])
        open_ = open_[~has]
    return at, doc, key


def _words(b):
    words, starts = split_all(raw(b))
    return words, starts, hashed(words)


def _parsed(batches):
    for b in slices(batches):
        words, starts, h = _words(b)
        _, doc, key = window_keys(h, starts)
        change = np.ones(len(key), bool)
        change[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        key, owner = key[change].view(np.int64), doc[change]
        at = np.searchsorted(owner, np.arange(len(starts)))
        sha = [hashlib.sha256(b" ".join(words[s:e])).hexdigest() for s, e in zip(starts[:-1].tolist(), starts[1:].tolist())]
        yield pa.RecordBatch.from_arrays([ids(b), pa.array(np.diff(starts)), pa.array(sha), pa.array([np.unique(key[s:e]) for s, e in zip(at[:-1], at[1:])], pa.list_(pa.int64()))], names=["doc_id", "n_words", "sha", "keys"])


def _candidates(batches):
    for b in slices(batches):
        _, starts, h = _words(b)
        at, doc, key = window_keys(h, starts)
        shared = [np.array(x or [], np.int64).view(np.uint64) for x in ids(b, "shared").to_pylist()]
        own = np.searchsorted(doc, np.arange(len(starts)))
        keep = np.concatenate([np.isin(key[s:e], shared[i]) for i, (s, e) in enumerate(zip(own[:-1], own[1:]))])
        at, doc = at[keep], doc[keep]
        m = mix(h)
        w1, w2 = window_hashes(m, WINDOW, BASES[0])[at], window_hashes(m, WINDOW, BASES[1])[at] if len(at) else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(w1.view(np.int64)), pa.array((w2 >> np.uint64(32)).astype(np.uint32).view(np.int32)), ids(b).take(pa.array(doc)), pa.array((at - starts[doc]).astype(np.int32))], names=["w1", "w2", "doc_id", "place"])


def _kept(batches):
    for b in slices(batches):
        n, sha, left = [], [], []
        for t, places in zip(raw(b), ids(b, "places").to_pylist()):
            words = t.split()
            spans = spans_of(np.array(places or [], np.int64), WINDOW)
            kept, at = [], 0
            for s, e in spans:
                kept += words[at:s]
                at = e
            kept += words[at:]
            out = b" ".join(kept)
            n.append(len(words) - len(kept))
            sha.append(hashlib.sha256(out).hexdigest())
            left.append(out.decode() if spans else None)
        yield pa.RecordBatch.from_arrays([ids(b), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(left, pa.string())], names=["doc_id", "n_removed", "kept_sha256", "kept_text"])


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and kept_text: the words left, or null where none went."""
    scratch = Scratch(docs.sparkSession)
    parsed = scratch.table(texts(docs).mapInArrow(_parsed, PARSED), "parsed")
    first = parsed.where(f"doc_id is not null and n_words >= {WINDOW}").groupBy("sha").agg(F.min("doc_id").alias("first_id"))
    own = F.col("doc_id") == F.col("first_id")
    member = scratch.table(parsed.join(first, "sha", "left").select("doc_id", "n_words", "sha", own.alias("own"), F.when(own, F.col("keys")).alias("keys")), "members")
    scratch.drop(parsed)
    rows = member.where("own").select(F.explode("keys").alias("key"), "doc_id")
    # what several documents have is a table of its own: a join of two tables can split the rows of a key that many have
    shared = scratch.table(rows.groupBy("key").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x < y").select("key"), "shared")
    wanted = scratch.table(rows.join(shared, "key").groupBy("doc_id").agg(F.collect_set("key").alias("shared")), "wanted")
    candidates = scratch.table(having(texts(docs.where("doc_id is not null")), wanted, scratch).join(wanted, "doc_id"), "candidates")
    scratch.drop(wanted, shared)
    windows = candidates.mapInArrow(_candidates, "w1 long, w2 int, doc_id long, place int")
    earliest = scratch.table(windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x < y").select("w1", "w2", "x"), "earliest")
    places = windows.join(earliest, ["w1", "w2"]).where("doc_id > x").groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    kept = scratch.table(candidates.select("doc_id", "text").join(places, "doc_id").mapInArrow(_kept, "doc_id long, n_removed long, kept_sha256 string, kept_text string").distinct(), "kept")
    scratch.drop(candidates, earliest)
    copy = ~F.coalesce("own", F.lit(True))
    return member.join(kept, "doc_id", "left").select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(NOTHING)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir)).drop("kept_text")


ORACLE = r"""
with words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
places as materialized (
  select doc_id, p, md5(array_to_string(w[p : p + 49], ' ')) as s
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as p from words where len(w) >= 50)),
firsts as (select s, min(doc_id) as d from places group by s),
gone as (select distinct doc_id, unnest(range(p, p + 50)) as i from places join firsts using (s) where doc_id > d),
left_over as (select doc_id, list(i) as g from gone group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(g), 0) as bigint) as n_removed,
  sha256(coalesce(array_to_string(case when g is null then w else list_filter(w, lambda x, i: not list_contains(g, i)) end, ' '), '')) as kept_sha256
from words left join left_over using (doc_id)
"""
