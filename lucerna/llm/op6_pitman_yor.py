"""Language-model scoring by a hierarchical Pitman-Yor model.

Each word is a customer in the restaurant of its context, the whole word before it (64 bits of its hash).  Tables there are customers of the
root, which all contexts share.  The root's base has no atoms, so a dish has one table there, and a new dish is an unknown word.

Words meet the counts of their contexts in one exchange: texts are cut into slices, a slice's tokens are packed into one block for each
bucket of contexts, and a bucket's blocks are merged to one row with its words, training counts by (context, word), and tokens.  A
context's customers and tables are all in its bucket.  What a bucket lacks is how many tables a word has in all contexts: it asks the parts
that words are dealt to, before the first sweep and after burn-in, and gets the sums back in the same order.  Words that never follow a
context twice have a table for each context and are asked for once.  The rows are stored by bucket, so the answers travel to them.

A Gibbs sweep takes all customers of a dish out of its restaurant and seats them anew, given the restaurant's other tables and the root:
the number of tables t of c customers has weight S(c, t) * P^t * (strength + discount * T) * ... (t factors), with S the generalised
Stirling numbers, and is drawn from exactly these weights up to LARGEST customers; beyond, customers come one after another and then in
groups of a sixteenth.  All dishes of a restaurant are drawn given its tables of the sweep before.  Predictive probabilities are averaged
over the sweeps after burn-in.  Draws come from seeds by bucket and sweep, so scoring repeats them instead of keeping tables.  Discounts are
estimated from how many counts are one and two; strengths are 1.

What travels to the driver is one row of sums.  Partial scores go back to slices in blocks.

Nulls and edges: a null text is empty and consists of its end; a null doc_id is neither held out nor learned from; repeated rows count and are
scored each; with nothing to learn from both scores are 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, hashed, ids, mix, raw, remainder, slices, texts
from .subword import indexed

SWEEPS, BURN_IN, STRENGTH, LARGEST = 4, 2, 1.0, 128
#: Bytes of text in a slice, and for each bucket.
SLICE, BUCKET = 6 << 20, 6 << 20
END = b"\n"  # no word holds it
UNTRAINED = np.uint16(1 << 15)
BLOCKS = "bucket int, slice long, block binary"
MERGED = "bucket int, slice long, docs binary, words binary, cells binary, tokens binary"
ASKED = "part int, bucket int, block binary"
ANSWERED = "bucket int, part int, block binary, sums array<double>"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def evenly(spark: SparkSession, n: int) -> np.ndarray:
    """n numbers of which an exchange to n partitions deals one to each, as buckets that share a task share its memory."""
    size = 8 * n
    while True:
        rows = spark.range(size).groupBy(F.pmod(F.hash(F.col("id").cast("int")), F.lit(n))).agg(F.min("id").alias("id")).collect()
        if len(rows) == n:
            return np.array(sorted(r.id for r in rows), np.int32)
        size *= 2


def packed(*arrays: np.ndarray) -> bytes:
    return b"".join([np.array([len(arrays), *(x.nbytes for x in arrays)], "<i8").tobytes(), *(x.tobytes() for x in arrays)])


def unpacked(data: bytes, *kinds) -> list[np.ndarray]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    sizes = np.frombuffer(data, "<i8", n, 8)
    ends = 8 * (n + 1) + np.cumsum(sizes)
    return [np.frombuffer(data[e - s : e], k) for s, e, k in zip(sizes.tolist(), ends.tolist(), kinds)]


def small(data: bytes) -> bytes:
    """data compressed, its length before it, closer than an exchange's own compression does."""
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(data, asbytes=True)


def large(data: bytes) -> bytes:
    """What small() compressed."""
    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def planes(x: np.ndarray) -> np.ndarray:
    """All lowest bytes of the numbers, then the next ones: the high bytes say little and are compressed well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).ravel()


def joined(x: np.ndarray, kind: str) -> np.ndarray:
    """The numbers that planes() took apart."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(x.view(np.uint8).reshape(size, len(x) * x.itemsize // size).T).ravel().view(kind)


def whole(x: np.ndarray) -> np.ndarray:
    """x, of whole numbers, in the fewest bytes."""
    return x.astype(next(k for k in ("u1", "<u2", "<u4") if x.max(initial=0) <= np.iinfo(k).max) if x.max(initial=0) < 1 << 32 else "<i8")


def opened(data: bytes, n: int) -> list[np.ndarray]:
    """The arrays that whole() packed, each with n numbers."""
    return [x.view({0: "u1", 1: "u1", 2: "<u2", 4: "<u4", 8: "<i8"}[len(x) // max(1, n)]).astype(np.int64) for x in unpacked(data, *["u1"] * 9)]


def gathered(batches, limit: int):
    """Batches put together to about limit bytes of text."""
    held, size = [], 0
    for b in slices(batches, limit=limit):
        n = b.column(b.schema.get_field_index("text")).nbytes
        if held and (size + n > limit or sum(x.num_rows for x in held) + b.num_rows > 1 << 15):
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(b)
        size += n
    if held:
        yield pa.concat_batches(held)


def _split(buckets: np.ndarray):
    """Blocks of (bucket, slice): context hashes, tokens of each context, and each token's word and document; and the slice's documents."""

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for b in gathered(batches, SLICE):
            number += 1
            owner, trained = ids(b), ids(b, "trained").to_numpy(zero_copy_only=False).astype(bool)
            words, starts = [], [0]
            for t in raw(b):
                words += t.lower().split()
                words.append(END)
                starts.append(len(words))
            n = np.diff(np.array(starts, np.int64))
            distinct, token = indexed(words)
            del words
            doc = np.repeat(np.where(trained, 0, UNTRAINED).astype(np.uint16) | np.arange(len(n), dtype=np.uint16), n)
            h = hashed(distinct)
            del distinct
            before = np.concatenate([token[-1:], token[:-1]])  # a text's start follows the end of one
            bucket = buckets[mix(h) % np.uint64(len(buckets))]
            rank = np.empty(len(h), np.int64)
            by_bucket = np.lexsort((h, bucket))
            rank[by_bucket] = np.arange(len(h))
            order = np.argsort(rank[before] * len(h) + token, kind="stable")
            bucket, size = bucket[by_bucket], np.bincount(before, minlength=len(h))[by_bucket].astype(np.uint32)
            ends = np.cumsum(size, dtype=np.int64)
            follow, doc = token[order], doc[order]
            del token, before, rank, order
            cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            home = -1 - int(mix(np.array([number], np.uint64))[0] % np.uint64(len(buckets)))
            rows = [(home, packed(np.array(owner.fill_null(0).to_numpy(), np.int64), np.array(owner.is_valid().to_numpy(zero_copy_only=False), np.uint8), np.array(ids(b, "held").to_numpy(zero_copy_only=False), np.uint8), n))]
            for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(h)]):
                t0, t1 = int(ends[s]) - int(size[s]), int(ends[e - 1])
                own, of = np.unique(follow[t0:t1], return_inverse=True)
                rows.append((int(bucket[s]), packed(h[by_bucket[s:e]], planes(size[s:e]), h[own], planes(of.astype("<u2" if len(own) <= 1 << 16 else "<u4")), planes(doc[t0:t1]))))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([number] * len(rows), pa.int64()), pa.array([r[1] if r[0] < 0 else small(r[1]) for r in rows], pa.binary())], names=["bucket", "slice", "block"])

    return run


def _merge(bucket: int, parts: list[tuple[int, bytes]]) -> dict:
    """A bucket's words in the order of their hashes, training counts by (context, word), and tokens by (context, word) with slice and document."""
    names = np.array(sorted({s for s, _ in parts}), np.int64)
    blocks = []
    for s, x in parts:
        own, size, word, of, doc = unpacked(large(x), "<u8", "u1", "<u8", "u1", "u1")
        doc = joined(doc, "<u2")
        blocks.append((np.searchsorted(names, s), own, joined(size, "<u4"), word, joined(of, "<u2" if len(of) == 2 * len(doc) else "<u4"), doc))
    own, of = np.unique(np.concatenate([x[1] for x in blocks]), return_inverse=True)
    context = np.repeat(of.astype(np.int64), np.concatenate([x[2] for x in blocks]))
    word, of = np.unique(np.concatenate([x[3] for x in blocks]), return_inverse=True)
    first = np.cumsum([0, *(len(x[3]) for x in blocks)])
    context *= len(word)
    key = context + np.concatenate([of[f + x[4].astype(np.int64)] for f, x in zip(first.tolist(), blocks)])
    del context
    doc = np.concatenate([x[5] for x in blocks])
    place = np.repeat(np.arange(len(names), dtype=np.uint32)[[x[0] for x in blocks]], [len(x[5]) for x in blocks])
    del blocks
    order = np.argsort(key, kind="stable")
    key, doc, place = key[order], doc[order], place[order]
    del order
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    c = np.add.reduceat(doc < UNTRAINED, new, dtype=np.int64)
    cell = key[new]
    sizes = np.diff(np.concatenate([new, [len(key)]]))
    return {"bucket": bucket, "slice": None, "docs": None, "words": packed(word), "cells": packed(np.bincount(cell // len(word), minlength=len(own)).astype("<u4"), (cell % len(word)).astype("<u4"), c.astype("<u4")), "tokens": packed(sizes.astype("<u4"), doc & ~UNTRAINED, place, names)}


def _merged(batches):
    schema = pa.schema([("bucket", pa.int32()), ("slice", pa.int64()), *((x, pa.binary()) for x in ("docs", "words", "cells", "tokens"))])
    empty = dict.fromkeys(schema.names)
    now, parts = None, []
    for b in batches:
        for bucket, number, block in zip(ids(b, "bucket").to_pylist(), ids(b, "slice").to_pylist(), ids(b, "block").to_pylist()):
            if bucket < 0:
                yield pa.RecordBatch.from_pylist([empty | {"bucket": bucket, "slice": number, "docs": block}], schema)
                continue
            if bucket != now and parts:
                yield pa.RecordBatch.from_pylist([_merge(now, parts)], schema)
                parts = []
            now = bucket
            parts.append((number, block))
    if parts:
        yield pa.RecordBatch.from_pylist([_merge(now, parts)], schema)


@lru_cache(maxsize=2)
def stirling(discount: float, most: int = LARGEST) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers S(c, t) for c, t up to most: weights of the ways to seat c customers at t tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0
    t = np.arange(most + 1)
    with np.errstate(divide="ignore"):
        for c in range(most):
            out[c + 1, 1:] = np.logaddexp(out[c, :-1], out[c, 1:] + np.log(np.maximum(c - discount * t[1:], 0)))
    return out


def _one_by_one(c: np.ndarray, a: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes with many customers, who open one with probability a / (j - discount * t + a); after 32 in groups of a sixteenth."""
    tables, j = np.ones(len(c), np.int64), 1
    live = np.arange(len(c))
    while len(live):
        m = 1 if j < 32 else j // 16
        p = a[live] / (j - discount * tables[live] + a[live])
        tables[live] += rng.binomial(np.minimum(m, c[live] - j), p)
        j += m
        live = live[c[live] > j]
    return tables


def seat(c: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish with c customers, all seated anew, given the restaurant's tables of other dishes and the dish's probability in the parent."""
    tables = np.minimum(c, 1).astype(np.int64)
    by_count = np.argsort(c, kind="stable")
    kinds, first = np.unique(c[by_count], return_index=True)
    ways = stirling(discount)
    for k, at in zip(kinds.tolist(), np.split(by_count, first[1:])):
        if k < 2:
            continue
        if k > LARGEST:
            rest = by_count[np.searchsorted(c[by_count], k) :]
            tables[rest] = _one_by_one(c[rest], (STRENGTH + discount * others[rest]) * parent[rest], discount, rng)
            break
        for part in np.split(at, range(1 << 18, len(at), 1 << 18)):
            steps = np.log((STRENGTH + discount * (others[part, None] + np.arange(k))) * parent[part, None])
            weight = ways[k, 1 : k + 1] + np.cumsum(steps, axis=1)
            total = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            tables[part] = 1 + (total < (rng.random(len(part)) * total[:, -1])[:, None]).sum(axis=1)
    return tables


class Bucket:
    """A bucket's counts: cells are (context, word)."""

    def __init__(self, row: dict, parts: np.ndarray):
        self.number, self.parts = row["bucket"], parts
        (self.words,) = unpacked(row["words"], "<u8")
        n, self.word, c = unpacked(row["cells"], "<u4", "<u4", "<u4")
        self.c = c.astype(np.int64)
        self.context = np.repeat(np.arange(len(n)), n)
        self.customers = np.bincount(self.context, self.c, len(n))
        self.told: dict[int, list[np.ndarray]] = {}
        answers = sorted((a["round"], a["part"], a["block"]) for a in row.get("answers") or [])
        for i in range(2):
            places = dict(self.dealt(self.asked(i)))
            if i and not any(a[0] == i for a in answers):
                break
            sums = [np.zeros(len(self.words), np.int64) for _ in range(2)] if not i else [self.told[0][1].copy()]
            for _, part, block in (a for a in answers if a[0] == i):
                for to, x in zip(sums, opened(block, len(places[part]))):
                    to[places[part]] = x
            self.told[i] = sums

    def asked(self, i: int) -> np.ndarray:
        """Words whose sums a round asks for: all, then those that follow some context more than once."""
        return np.flatnonzero(self.told[0][0] > self.told[0][1]) if i else np.arange(len(self.words))

    def dealt(self, some: np.ndarray):
        """Numbers of words by the part that sums them."""
        part = self.parts[mix(self.words[some]) % np.uint64(len(self.parts))]
        order = np.argsort(part, kind="stable")
        names, first = np.unique(part[order], return_index=True)
        return zip(names.tolist(), np.split(some[order], first[1:]))

    def root(self, known: list[dict], i: int) -> np.ndarray:
        """Probability of each word at the root, whose customers are the tables of round i; a word never learned is a new dish."""
        g = known[i]
        at_root = self.told[i][-1] if i in self.told else self.told[0][1]
        new = (STRENGTH + g["root_discount"] * g["words"]) / (STRENGTH + g["root"])
        return np.where(self.told[0][0] > 0, (at_root - g["root_discount"]) / (STRENGTH + g["root"]), new)

    def chain(self, known: list[dict], sweeps: int):
        """Tables of each cell, tables of each context, and the root's probabilities, after each sweep."""
        tables = np.minimum(self.c, 1)
        again, d = np.flatnonzero(self.c > 1), known[0]["discount"]
        for i in range(1, sweeps + 1):
            root = self.root(known, int(i > BURN_IN))
            all_ = np.bincount(self.context, tables, len(self.customers))
            of = self.context[again]
            tables = tables.copy()
            tables[again] = seat(self.c[again], all_[of] - tables[again], root[self.word[again]], d, np.random.default_rng([self.number, i]))
            yield tables, np.bincount(self.context, tables, len(self.customers)), root


def _rows(batches):
    for b in batches:
        for i in range(b.num_rows):
            yield from b.slice(i, 1).to_pylist()


def _asks(known: list[dict], parts: np.ndarray):
    """What a bucket holds of each word, by the part that sums it, and in a part below 0 its numbers of counts that are one and two."""

    def run(batches):
        for own in (Bucket(row, parts) for row in _rows(batches)):
            n, i = len(own.words), len(known)
            tables = np.minimum(own.c, 1)
            if i:
                for tables, _, _ in own.chain(known, BURN_IN):
                    pass
            values = [np.bincount(own.word, tables, n)] if i else [np.bincount(own.word, own.c, n), np.bincount(own.word, tables, n)]
            out = [(-1 - own.number, np.array([(own.c == 1).sum(), (own.c == 2).sum()], "<f8").tobytes())]
            out += [(part, packed(own.words[some], *(whole(x[some]) for x in values))) for part, some in own.dealt(own.asked(i))]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([own.number] * len(out), pa.int32()), pa.array([x[1] for x in out], pa.binary())], names=["part", "bucket", "block"])

    return run


#: What the sums of a round are: counts of one and two; then of words, by whether they ever follow a context twice: all tokens, how many
#: were learned, their tables, and how many have one and two tables.
SUMS = 2 + 2 * 5


def _answers(batches):
    """To each bucket that asked a part, the sums of its words in the order of its asking; and in bucket -1 the sums of all."""

    def row(bucket, part, blocks, sums=None):
        n = len(bucket)
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(blocks, pa.binary()), pa.array([sums] * n, pa.list_(pa.float64()))], names=["bucket", "part", "block", "sums"])

    def summed(part: int, asked: list[tuple[int, bytes]]):
        hashes = [unpacked(x, "<u8")[0] for _, x in asked]
        word, of = np.unique(np.concatenate(hashes), return_inverse=True)
        values = [opened(x, len(h))[1:] for h, (_, x) in zip(hashes, asked)]
        totals = [np.bincount(of, np.concatenate(x), len(word)).astype(np.int64) for x in zip(*values)]
        ends = np.cumsum([len(h) for h in hashes]).tolist()
        yield row([b for b, _ in asked], part, [packed(*(whole(x[of[e - len(h) : e]]) for x in totals)) for h, e in zip(hashes, ends)])
        tables, count = totals[-1], totals[0] if len(totals) > 1 else None
        more = np.ones(len(word), bool) if count is None else count > tables
        each = [[0.0 if count is None else count[x].sum(), 0.0 if count is None else (count[x] > 0).sum(), tables[x].sum(), (tables[x] == 1).sum(), (tables[x] == 2).sum()] for x in (~more, more)]
        yield row([-1], part, [b""], [0.0, 0.0, *map(float, each[0] + each[1])])

    now, asked = None, []
    for r in _rows(batches):
        if r["part"] < 0:
            yield row([-1], r["part"], [b""], [*np.frombuffer(r["block"], "<f8").tolist(), *[0.0] * (SUMS - 2)])
            continue
        if r["part"] != now and asked:
            yield from summed(now, asked)
            asked = []
        now = r["part"]
        asked.append((r["bucket"], r["block"]))
    if asked:
        yield from summed(now, asked)


#: Fixed-point units of partial base scores on their way back.
UNIT = float(1 << 21)


def _fixed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """x in fixed-point numbers of 32 bits, or as it is where they don't reach."""
    if np.abs(x).max(initial=0) < 1000:
        return np.rint(x * UNIT).astype("<i4"), np.zeros(0)
    return np.zeros(0, "<i4"), x


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the place of each key among them, in 32 bits."""
    order = np.argsort(key, kind="stable").astype(np.int32)
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    of = np.empty(len(key), np.int32)
    of[order] = np.cumsum(new, dtype=np.int32) - 1
    return key[new].astype(np.int64), of


def _scored(known: list[dict], parts: np.ndarray):
    """For each (bucket, slice): documents with tokens there, and sums over those tokens."""

    def run(batches):
        for row in _rows(batches):
            own = Bucket(row, parts)
            size, doc, place, names = unpacked(row["tokens"], "<u4", "<u2", "<u4", "<i8")
            p, d, seated = np.zeros(len(own.c)), known[0]["discount"], STRENGTH + own.customers
            for i, (tables, all_, root) in enumerate(own.chain(known, SWEEPS), 1):
                if i > BURN_IN:
                    p += (own.c - d * tables + ((STRENGTH + d * all_))[own.context] * root[own.word]) / seated[own.context]
            who, of = _grouped(place.astype(np.uint32 if len(names) < 1 << 16 else np.int64) << 16 | doc)
            count = own.told[0][0][own.word]
            sums = [np.bincount(of, np.repeat(x, size), len(who)) for x in (np.log10(p / (SWEEPS - BURN_IN)), np.log10(count + 0.5), count > 0)]
            cut = np.searchsorted(who >> 16, np.arange(len(names) + 1)).tolist()
            blocks = [packed((who[s:e] & 0xFFFF).astype("<u2"), sums[0][s:e].astype("<f4"), *_fixed(sums[1][s:e]), sums[2][s:e].astype("<u2" if e == s or sums[2][s:e].max() < 1 << 16 else "<u4")) for s, e in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(blocks, pa.binary()), pa.array([False] * len(names))], names=["slice", "block", "is_docs"])

    return run


def _summed(n_train: float, n_words: float):
    norm = np.log10(n_train + 0.5 * (n_words + 1))

    def finish(docs: bytes, blocks: list[bytes]):
        owner, valid, held, n = unpacked(docs, "<i8", "u1", "u1", "<i8")
        score, base, seen = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n))
        for x in blocks:
            doc, s, fixed, exact, k = unpacked(x, "<u2", "<f4", "<i4", "<f8", "u1")
            k = k.view("<u2" if len(k) == 2 * len(doc) else "<u4")
            score[doc] += s
            base[doc] += fixed / UNIT if len(fixed) else exact
            seen[doc] += k
        return pa.RecordBatch.from_arrays([pa.array(owner, mask=valid == 0), pa.array(held.astype(bool)), pa.array(n), pa.array(seen.astype(np.int64)), pa.array(np.full(len(n), int(n_train), np.int64)), pa.array(base - n * norm), pa.array(score)], names=[c.split()[0] for c in RESULT.split(", ")])

    def run(batches):
        now, docs, blocks = None, None, []
        for b in batches:
            for number, block, is_docs in zip(ids(b, "slice").to_pylist(), ids(b, "block").to_pylist(), ids(b, "is_docs").to_pylist()):
                if number != now and docs is not None:
                    yield finish(docs, blocks)
                    docs, blocks = None, []
                now = number
                if is_docs:
                    docs = block
                else:
                    blocks.append(block)
        if docs is not None:
            yield finish(docs, blocks)

    return run


def score(docs: DataFrame, held_out) -> DataFrame:
    """held_out: a boolean column of the rows not to learn from, null for rows neither held out nor learned from."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts(docs, F.coalesce(held_out, F.lit(False)).alias("held"), F.coalesce(~held_out, F.lit(False)).alias("trained"))
    size = rows.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    buckets = max(8, -(-size // BUCKET))
    names = evenly(spark, buckets)
    blocks = rows.mapInArrow(_split(names), BLOCKS)
    merged = scratch.bucketed(blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_merged, MERGED), "merged", buckets, "bucket")
    counted = merged.where("bucket >= 0")
    known: list[dict] = []
    told: list[DataFrame] = []

    def rows_with_answers(*more: str) -> DataFrame:
        rows = counted.select("bucket", "words", "cells", *more)
        if not told:
            return rows
        answers = reduce(DataFrame.unionByName, told).groupBy("bucket").agg(F.collect_list(F.struct("round", "part", "block")).alias("answers"))
        return rows.join(answers.hint("merge"), "bucket", "left")

    sums = np.zeros((2, SUMS))
    for i in range(2):
        asked = rows_with_answers().mapInArrow(_asks(known, names), ASKED)
        answered = scratch.table(asked.repartition(buckets, "part").sortWithinPartitions("part").mapInArrow(_answers, ANSWERED), "answered")
        for pos, x in answered.where("bucket < 0").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col")).collect():
            sums[i, pos] = x
        seldom, often = sums[0, 2:7], sums[0, 7:] if not i else sums[1, 7:]
        tokens, words = sums[0, 2] + sums[0, 7], sums[0, 3] + sums[0, 8]
        root, once, twice = seldom[2:] + often[2:]
        known.append({"n_train": tokens, "words": words, "root": root, "root_discount": once / max(1.0, once + 2 * twice), "discount": sums[0, 0] / max(1.0, sums[0, 0] + 2 * sums[0, 1])})
        told.append(answered.where("bucket >= 0").select("bucket", "part", "block", F.lit(i).alias("round")))
    out = rows_with_answers("tokens").mapInArrow(_scored(known, names), "slice long, block binary, is_docs boolean")
    listed = merged.where("bucket < 0").select("slice", F.col("docs").alias("block"), F.lit(True).alias("is_docs"))
    back = out.unionByName(listed).repartition(shuffle, "slice").sortWithinPartitions("slice", F.desc("is_docs"))
    return back.mapInArrow(_summed(float(known[0]["n_train"]), float(known[0]["words"])), RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir), remainder("doc_id", 5) == 1)
