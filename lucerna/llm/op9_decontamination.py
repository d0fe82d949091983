"""Benchmark decontamination by Wu-Manber search over words.

A pattern is a window of 13 consecutive item words, or a whole shorter item.  The symbols are word numbers of the benchmark's own
vocabulary, so comparisons are exact.  Patterns of one length m are searched together: the shift table says for each block of two
symbols how far a position can move on; a block that ends some pattern has shift 0 and leads to the patterns with that suffix block,
which are compared symbol by symbol.  Many places of many documents move on at once, each by its own shift.

The tables are built in blocks of `block_items` items, so that a broadcast's size has a bound whatever the benchmark's; with several blocks
each one is a pass over the documents and what the passes found is merged by doc_id and SHA-256 of the text, then given to each equal row.

Nulls and edges: null or wordless texts have no words and no hits; null or wordless items are no patterns; a null item_id is left out;
repeated document rows each get their own row; an empty table gives no rows or no hits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, documents, ids, raw, slices, texts

WINDOW = 13
BLOCK_ITEMS = 20_000
#: Places in a document that one search lane starts from.
LANE = 256
FOUND = "doc_id long, n_words long, spans array<long>, items array<long>, content binary"
RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class Patterns:
    """Wu-Manber tables for one block of items."""

    def __init__(self, items: list[tuple[int, bytes]], window: int = WINDOW):
        split = [(i, t.translate(ALNUM).split()) for i, t in items]
        self.number: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[int]]] = {}
        for i, ws in split:
            syms = [self.number.setdefault(w, len(self.number) + 1) for w in ws]
            m = min(window, len(syms))
            for at in range(len(syms) - m + 1) if m else ():
                by_length.setdefault(m, {}).setdefault(tuple(syms[at : at + m]), set()).add(i)
        self.base = len(self.number) + 1
        self.groups = [self._tables(m, pats) for m, pats in sorted(by_length.items())]

    def _tables(self, m: int, pats: dict[tuple[int, ...], set[int]]):
        p = np.array(list(pats), np.int64)
        owners = list(pats.values())
        b = min(2, m)
        shift: dict[int, int] = {}
        for end in range(b - 1, m):  # later ends overwrite with smaller shifts
            key = p[:, end] if b == 1 else p[:, end - 1] * self.base + p[:, end]
            shift.update(dict.fromkeys(key.tolist(), m - 1 - end))
        keys = np.array(sorted(shift), np.int64)
        last = p[:, m - 1] if b == 1 else p[:, m - 2] * self.base + p[:, m - 1]
        order = np.argsort(last, kind="stable")
        return m, b, keys, np.array([shift[k] for k in keys.tolist()], np.int64), p[order], last[order], [owners[k] for k in order]

    def search(self, syms: np.ndarray, starts: np.ndarray):
        """(first word, one past the last, items) of every occurrence; starts: where documents begin in syms, and the end."""
        out = []
        for m, b, keys, shifts, pats, suffix, owners in self.groups:
            lanes = [np.arange(s, e - m + 1, LANE) for s, e in zip(starts[:-1], starts[1:]) if e - s >= m]
            if not lanes:
                continue
            ends = np.concatenate([np.minimum(x + LANE, e - m + 1) for x, e in zip(lanes, (e for s, e in zip(starts[:-1], starts[1:]) if e - s >= m))])
            at = np.concatenate(lanes)
            while len(at):
                block = syms[at + m - 1] if b == 1 else syms[at + m - 2] * self.base + syms[at + m - 1]
                k = np.minimum(np.searchsorted(keys, block), len(keys) - 1)
                move = np.where(keys[k] == block, shifts[k], m - b + 1)
                zero = np.flatnonzero(move == 0)
                if len(zero):
                    lo, hi = np.searchsorted(suffix, block[zero], "left"), np.searchsorted(suffix, block[zero], "right")
                    n = hi - lo
                    which = np.repeat(zero, n)
                    cand = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                    same = np.ones(len(which), bool)
                    for j in range(m):
                        same &= pats[cand, j] == syms[at[which] + j]
                    out += [(int(at[w]), int(at[w]) + m, owners[c]) for w, c in zip(which[same], cand[same])]
                    move[zero] = 1
                at = at + move
                going = at < ends
                at, ends = at[going], ends[going]
        return out


def found(docs: DataFrame, patterns, content: bool = False) -> DataFrame:
    """For every document the covered spans (begin, end, begin, end, ...), the items found and, if wanted, a hash of the text."""

    def run(batches):
        pats = patterns.value
        get = pats.number.get
        for b in slices(batches):
            syms, starts = [], [0]
            for t in raw(b):
                syms += [get(w, 0) for w in t.translate(ALNUM).split()]
                starts.append(len(syms))
            starts = np.array(starts, np.int64)
            hits: dict[int, tuple[list, set]] = {}
            for first, past, items in pats.search(np.array(syms, np.int64), starts):
                d = int(np.searchsorted(starts, first, "right") - 1)
                spans, own = hits.setdefault(d, ([], set()))
                spans += [first - int(starts[d]), past - int(starts[d])]
                own |= items
            none: tuple[list, set] = ([], set())
            yield pa.RecordBatch.from_arrays([ids(b), pa.array(np.diff(starts)), pa.array([hits.get(d, none)[0] for d in range(len(starts) - 1)], pa.list_(pa.int64())), pa.array([sorted(hits.get(d, none)[1]) for d in range(len(starts) - 1)], pa.list_(pa.int64())), pa.array([hashlib.sha256(t).digest() if content else None for t in raw(b)], pa.binary())], names=["doc_id", "n_words", "spans", "items", "content"])

    return texts(docs).mapInArrow(run, FOUND)


def covered(spans: list[int]) -> int:
    total, reach = 0, 0
    for a, e in sorted(zip(spans[::2], spans[1::2])):
        total += max(0, e - max(a, reach))
        reach = max(reach, e)
    return total


def _summary(batches):
    for b in batches:
        n = ids(b, "n_words").to_pylist()
        hit = [covered(x) for x in ids(b, "spans").to_pylist()]
        items = [sorted(map(str, set(x))) for x in ids(b, "items").to_pylist()]
        sha = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
        yield pa.RecordBatch.from_arrays([ids(b), ids(b, "n_words"), pa.array(hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(sha, pa.string()), pa.array([h > 0 and 20 * h >= k for h, k in zip(hit, n)], pa.bool_())], names=[c.split()[0] for c in RESULT.split(", ")])


def _summary_of_equal(batches):
    """The same with how often each document was found in all passes."""
    for b in batches:
        (out,) = _summary([b])
        yield pa.RecordBatch.from_arrays([*out.columns, ids(b, "n")], names=[*out.schema.names, "n"])


def blocks(benchmark: DataFrame, block_items: int):
    """Lists of (item_id, bytes), each of at most about block_items items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("i"), F.col("text").cast("string").alias("t")).where("i is not null and t is not null")
    n = max(1, -(-items.count() // block_items))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("i"), F.lit(n)) == k)
        yield [(r.i, r.t.encode()) for r in part.collect()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row per document with its hit words and the items that it holds."""
    sc = docs.sparkSession.sparkContext
    tables = [sc.broadcast(Patterns(part, window)) for part in blocks(benchmark, block_items)]
    if len(tables) == 1:
        return found(docs, tables[0]).mapInArrow(_summary, RESULT)
    passes = [found(docs, x, content=True) for x in tables]
    merged = None
    for part in passes:
        merged = part if merged is None else merged.unionByName(part)
    merged = merged.groupBy("doc_id", "content").agg(F.first("n_words").alias("n_words"), F.count("*").alias("n"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    equal = F.explode(F.sequence(F.lit(1), (F.col("n") / len(passes)).cast("int")))
    return merged.mapInArrow(_summary_of_equal, f"{RESULT}, n long").select("*", equal).drop("n", "col")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
pats as (
  select distinct item_id, m, array_to_string(w[p : p + m - 1], ' ') as s
  from (select item_id, w, least(13, len(w)) as m, unnest(range(1, len(w) - least(13, len(w)) + 2)) as p from items where len(w) > 0)),
lens as (select distinct m from pats),
places as (
  select doc_id, m, p, array_to_string(w[p : p + m - 1], ' ') as s
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as p from words cross join lens where len(w) >= m)),
hits as (select doc_id, p, places.m, item_id from places join pats on places.m = pats.m and places.s = pats.s),
hit_words as (select doc_id, count(distinct x) as n_hit from (select doc_id, unnest(range(p, p + m)) as x from hits) group by doc_id),
hit_items as (select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as l from (select distinct doc_id, cast(item_id as varchar) as i from hits) group by doc_id)
select words.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(l, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from words left join hit_words using (doc_id) left join hit_items using (doc_id)
"""
