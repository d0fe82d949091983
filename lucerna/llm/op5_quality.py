"""Quality classifier by supervised subword embeddings.

A text is the average of learned vectors: one for each character n-gram of each word (case kept, ends marked), for each word and for each
pair of neighbouring words, all hashed into one table, and one for repeats of the word before.  A softmax over the labels follows.  Both
are trained by stochastic gradient descent in numpy on the whole of at most 2 * PER_LABEL texts of each label, chosen by the hash of doc_id.  The
output is linear in the average, so a trained table shrinks to one number for each row, which is what scoring reads.

Nulls and edges: a null text is empty; an empty text scores what the labels' share says; with nothing to learn from every score is 0.5;
labels of unknown documents, null labels and null ids teach nothing; repeated rows are scored each; a score of 0.7 is predicted 1; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, hashed, ids, mix, raw, remainder, slices, split_all, texts
from .subword import gram_lists, gram_sums, indexed, labelled_sample, spread

PER_LABEL = 600
GRAMS, BITS, DIM = (2, 3, 4), 16, 12


def _bucket(h: np.ndarray) -> np.ndarray:
    return (mix(h) >> np.uint64(64 - BITS)).astype(np.int64)


def _pairs(h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with the one before it in its text, and whether it has one (its place counts as no pair otherwise)."""
    inner = np.ones(len(h), bool)
    inner[starts[:-1][starts[:-1] < len(h)]] = False
    before = np.concatenate([np.zeros(min(1, len(h)), np.uint64), h[:-1]])
    pair = mix(before + np.uint64(1)) + h
    pair[inner & (before == h)] = np.uint64(0xA5A5)  # a repeat
    return pair, inner


def train(sample: list[tuple[str, int]], epochs: int = 6, rate: float = 2.0, seed: int = 5) -> tuple[np.ndarray, float]:
    """One number for each row of the table, and the bias: their mean over a text's features plus the bias is its log odds."""
    rng = np.random.default_rng(seed)
    y = np.array([q for _, q in sample], np.float64)
    if not len(y) or y.min() == y.max():
        return np.zeros(1 << BITS, np.float32), 0.0 if not len(y) else (4.0 if y[0] else -4.0)
    words, starts = split_all([t.encode() for t, _ in sample])
    distinct, token = indexed(words)
    bucket, offsets = gram_lists(distinct, GRAMS, BITS)
    h = hashed(distinct)[token] if words else np.zeros(0, np.uint64)
    pair, inner = _pairs(h, starts)
    lists = []
    for s, e in zip(starts[:-1], starts[1:]):
        places, _ = spread(offsets, token[s:e])
        each, times = np.unique(np.concatenate([bucket[places], _bucket(h[s:e]), _bucket(pair[s:e][inner[s:e]])]), return_counts=True)
        lists.append((each.astype(np.int32), times.astype(np.float32)))
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    out, bias = np.zeros((2, DIM)), np.log(np.array([1 - y.mean(), y.mean()]))
    steps, done = epochs * len(y) / 16, 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for b in range(0, len(y), 16):
            own = order[b : b + 16]
            n = np.array([len(lists[i][0]) for i in own])
            feats, times = (np.concatenate([lists[i][j] for i in own]) for j in (0, 1))
            total = np.array([lists[i][1].sum() for i in own])
            rows, inv = np.unique(feats, return_inverse=True)
            mean = np.zeros((len(own), DIM))
            full = np.flatnonzero(n)
            if len(full):
                mean[full] = np.add.reduceat(vectors[feats] * times[:, None], (np.cumsum(n) - n)[full], axis=0) / total[full, None]
            z = mean @ out.T + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(own)), y[own].astype(int)] -= 1
            lr = rate * (1 - done / steps)
            done += 1
            back = (p @ out) / np.maximum(total, 1)[:, None]
            grad = np.stack([np.bincount(inv, np.repeat(back[:, j], n) * times, len(rows)) for j in range(DIM)], 1)
            out -= lr * (p.T @ mean) / len(own) * 4
            bias = bias - 0.05 * lr * p.mean(0)
            vectors[rows] -= (lr * 30 * grad).astype(np.float32)
    return (vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0])


def score(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """doc_id and score of every row; labels: doc_id and quality to learn from."""
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)")
    sample = labelled_sample(docs, labels, "quality", per_label)
    model = docs.sparkSession.sparkContext.broadcast(train(sample))

    def run(batches):
        table, bias = model.value
        for b in slices(batches):
            words, starts = split_all(raw(b))
            n = np.diff(starts)
            total, count = np.zeros(len(n)), np.ones(len(n))
            if words:
                distinct, token = indexed(words)
                sums, grams = gram_sums(distinct, table[:, None], GRAMS)
                h = hashed(distinct)[token]
                pair, inner = _pairs(h, starts)
                own = sums[:, 0].astype(np.float64)[token] + table[_bucket(h)] + np.where(inner, table[_bucket(pair)], 0)
                full = np.flatnonzero(n)
                total[full] = np.add.reduceat(own, starts[:-1][full])
                count[full] = np.add.reduceat(grams[token] + 1 + inner, starts[:-1][full])
            yield pa.RecordBatch.from_arrays([ids(b), pa.array(1 / (1 + np.exp(-np.clip(total / count + bias, -30, 30))))], names=["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder("doc_id", 4) != 2)
    out = score(docs, labels)
    return out.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))
