"""Hashed character n-grams of words, for many words at once, and bounded samples of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_STEP = np.uint64(0x9FB21C651E98DF25)


def indexed(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Distinct words and the place of each word among them."""
    place = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return list(place), np.fromiter(map(place.__getitem__, words), np.int32, len(words))


def _points(words: list[bytes]):
    """Code points of the words with a mark before and after each, the word of each code point, and where words begin."""
    text = "".join(["\x02" + w.decode("utf-8", "replace").replace("\x02", " ") + "\x03" for w in words])
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.flatnonzero(points == 2)
    word = np.zeros(len(points), np.int32)
    word[starts[1:]] = 1
    return points, np.cumsum(word, dtype=np.int32), starts


def _grams(points, word, lengths, bits):
    """For each length: buckets of the n-grams by first code point, and which of them lie within a word."""
    acc = np.zeros(len(points), np.uint64)
    for n in range(1, max(lengths) + 1):
        if len(points) < n:
            return
        acc = acc[: len(points) - n + 1]
        acc = (acc + points[n - 1 :] + np.uint64(n)) * _STEP
        acc = acc ^ (acc >> np.uint64(29))
        if n in lengths:
            yield ((acc * _STEP) >> np.uint64(64 - bits)).astype(np.int32), word[n - 1 :] == word[: len(word) - n + 1]


def gram_sums(words: list[bytes], table: np.ndarray, lengths) -> tuple[np.ndarray, np.ndarray]:
    """For each word the sum of the table's rows over its n-grams, and their number.  The table has a power of two rows."""
    k = table.shape[1]
    if not words:
        return np.zeros((0, k), np.float32), np.zeros(0, np.int64)
    points, word, starts = _points(words)
    bits = len(table).bit_length() - 1
    total, count = np.zeros((len(words), k), np.float32), np.zeros(len(words), np.int64)
    for bucket, inside in _grams(points, word, lengths, bits):
        pad = len(points) - len(bucket)
        values = table[bucket]
        values[~inside] = 0
        if pad:
            values = np.concatenate([values, np.zeros((pad, k), np.float32)])
            inside = np.concatenate([inside, np.zeros(pad, bool)])
        total += np.add.reduceat(values, starts, axis=0)
        count += np.add.reduceat(inside.astype(np.int64), starts)
    return total, count


def gram_lists(words: list[bytes], lengths, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, word after word, and where each word's begin (one more entry than words)."""
    if not words:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    points, word, _ = _points(words)
    found = [(bucket[inside], word[: len(bucket)][inside]) for bucket, inside in _grams(points, word, lengths, bits)]
    bucket, owner = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.searchsorted(owner[order], np.arange(len(words) + 1))


def spread(offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the lists of the chosen rows in a concatenation of lists, and the number of places of each."""
    n = offsets[which + 1] - offsets[which]
    return np.repeat(offsets[which] - np.cumsum(n) + n, n) + np.arange(n.sum()), n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_label: int) -> list[tuple]:
    """(text, label) of about per_label documents of each label, twice as many at most, the same ones each time: those with the least hashes.

    labels has doc_id and the label, docs has doc_id and text.  Labels are counted over all rows; a document stays if its hash is below its
    label's share.  Only the ids chosen, whose number is bounded, meet the texts.  Of rows that share an id the least text is taken, whole.
    """
    labels = labels.select("doc_id", label).distinct()
    counts = {r[0]: r[1] for r in labels.groupBy(label).count().collect()}
    if not counts:
        return []
    most = 2 * per_label * len(counts)
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, per_label / n)))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    picked = labels.where(draw < F.element_at(share, F.col(label))).orderBy(draw, "doc_id", label).limit(most).collect()
    if not picked:
        return []
    kind = labels.schema[label].dataType.simpleString()
    chosen = docs.sparkSession.createDataFrame([tuple(r) for r in picked], f"doc_id long, {label} {kind}")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").where("text is not null").groupBy("doc_id", label).agg(F.min("text").alias("text"))
    return [(r["text"], r[label]) for r in sorted(rows.collect(), key=lambda r: (r["doc_id"], r[label]))]
