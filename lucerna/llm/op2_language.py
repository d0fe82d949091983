"""Language identification by a linear-chain conditional random field over words.

Each word is labelled with a language.  Its features are its character n-grams with marks for its ends (so affixes too) and its entry in
a lexicon of words that training texts use often; transitions between neighbouring labels are learned.  Training sequences are cut from
labelled texts and some change language on the way, so that the chain learns how code-switched text changes.  Forward-backward gives each
word's label probabilities; a text's language is the one with the largest mean, and its score that mean.

Training reads the whole of at most 2 * PER_LANGUAGE texts for each language, chosen by the hash of doc_id.  Forward-backward runs over blocks of
words: transfer matrices of all blocks at once, then along each text's blocks, then inside all blocks.

Nulls and edges: a text that is null or has no letter is `und` with score 0; with nothing to learn from every text is; rows whose lang is
null teach nothing; a null doc_id is neither held out nor learned from; repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, documents, ids, raw, remainder, slices, split_all
from .subword import gram_lists, gram_sums, indexed, labelled_sample, spread

PER_LANGUAGE, LEXICON = 150, 20_000
GRAMS, BITS = (1, 2, 3, 4), 16
BLOCK, CHUNK, LENGTH = 32, 12, 60


class Field:
    """Languages, emission weights of n-grams and lexicon entries, and transition weights."""

    def __init__(self, languages: list[str]):
        k = len(languages)
        self.languages, self.grams, self.lexicon = languages, np.zeros((1 << BITS, k), np.float32), {}
        self.entries, self.moves = np.zeros((1, k), np.float32), np.zeros((k, k))

    def emissions(self, words: list[bytes]) -> np.ndarray:
        """Log weights of each label for each (distinct) word."""
        total, count = gram_sums(words, self.grams, GRAMS)
        entry = np.fromiter((self.lexicon.get(w, 0) for w in words), np.int32, len(words))
        return total / np.maximum(count, 1)[:, None] * 4 + self.entries[entry]


def has_letter(text: str) -> bool:
    """Whether any character is a letter (Unicode's categories L*); numerals such as fractions and circled digits are none."""
    return any(map(str.isalpha, text))


def lowered(data: bytes) -> bytes:
    return data.decode("utf-8", "replace").lower().encode()


def forward_backward(e: np.ndarray, moves: np.ndarray):
    """Label and transition probabilities of sequences of one length: e (sequences, words, labels) log weights."""
    s, n, k = e.shape
    w, a = np.exp(e - e.max(2, keepdims=True)), np.exp(moves - moves.max())
    alpha, beta = np.empty_like(w), np.ones_like(w)
    alpha[:, 0] = w[:, 0] / w[:, 0].sum(1, keepdims=True)
    for t in range(1, n):
        x = (alpha[:, t - 1] @ a) * w[:, t]
        alpha[:, t] = x / x.sum(1, keepdims=True)
    for t in range(n - 2, -1, -1):
        x = (w[:, t + 1] * beta[:, t + 1]) @ a.T
        beta[:, t] = x / x.sum(1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(2, keepdims=True)
    pair = alpha[:, :-1, :, None] * a * (w[:, 1:] * beta[:, 1:])[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    return gamma, pair.sum((0, 1))


def dealt(by_language: list[np.ndarray], rng: np.random.Generator) -> np.ndarray:
    """All words in sequences of LENGTH: each language's in chunks, a few chunks in a row, then perhaps another language's."""
    runs = []
    for own in by_language:
        chunks = np.resize(own, (-(-len(own) // CHUNK), CHUNK))
        chunks = chunks[rng.permutation(len(chunks))]
        runs += np.split(chunks, np.flatnonzero(rng.random(len(chunks) - 1) < 0.2) + 1)
    chunks = np.concatenate([runs[i] for i in rng.permutation(len(runs))])
    each = LENGTH // CHUNK
    return np.resize(chunks, (-(-len(chunks) // each) * each, CHUNK)).reshape(-1, LENGTH)


def train(sample: list[tuple[str, str]], epochs: int = 2, rate: float = 0.3, seed: int = 7) -> Field | None:
    """A field fitted by stochastic gradient steps (Adagrad) on sequences of LENGTH words, all words of the sample in each epoch."""
    rng = np.random.default_rng(seed)
    languages = sorted({lang for _, lang in sample})
    words, label = [], []
    for text, lang in sample:
        own = lowered(text.encode()).split()
        words += own
        label += [languages.index(lang)] * len(own)
    if not words:
        return None
    field, k = Field(languages), len(languages)
    distinct, token = indexed(words)
    label = np.array(label, np.int64)
    counts = np.bincount(token, minlength=len(distinct))
    often = [i for i in np.argsort(-counts, kind="stable")[:LEXICON] if counts[i] >= 5]
    field.lexicon = {distinct[i]: n + 1 for n, i in enumerate(often)}
    field.entries = np.zeros((len(often) + 1, k), np.float32)
    entry = np.zeros(len(distinct), np.int64)
    entry[often] = np.arange(1, len(often) + 1)
    bucket, offsets = gram_lists(distinct, GRAMS, BITS)
    by_language = [x for x in (np.flatnonzero(label == j) for j in range(k)) if len(x)]
    g_sum, e_sum, m_sum = np.full_like(field.grams, 1e-3), np.full_like(field.entries, 1e-3), np.full_like(field.moves, 1e-3)
    for _ in range(epochs):
        at = dealt(by_language, rng)
        for b in range(0, len(at), 100):
            seq, gold = token[at[b : b + 100]], label[at[b : b + 100]]
            used, inner = np.unique(seq, return_inverse=True)
            places, n = spread(offsets, used)
            grams = bucket[places]
            heads = np.cumsum(n) - n
            scale = (4 / np.maximum(n, 1)).astype(np.float32)
            e = np.add.reduceat(field.grams[grams], heads, axis=0) * scale[:, None] + field.entries[entry[used]]
            gamma, pairs = forward_backward(e[inner.reshape(seq.shape)].astype(np.float64), field.moves)
            seen = np.zeros((k, k))
            np.add.at(seen, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
            gamma[np.arange(len(seq))[:, None], np.arange(LENGTH), gold] -= 1
            per_word = np.stack([np.bincount(inner.ravel(), gamma[:, :, j].ravel(), len(used)) for j in range(k)], 1) / len(seq)
            spread_out = np.repeat(per_word * scale[:, None], n, axis=0)
            g = np.stack([np.bincount(grams, spread_out[:, j], 1 << BITS) for j in range(k)], 1).astype(np.float32)
            x = np.stack([np.bincount(entry[used], per_word[:, j], len(field.entries)) for j in range(k)], 1).astype(np.float32)
            x[0] = 0
            m = (pairs - seen) / len(seq)
            for weight, grad, square in ((field.grams, g, g_sum), (field.entries, x, e_sum), (field.moves, m, m_sum)):
                square += grad * grad
                weight -= rate * grad / np.sqrt(square)
    return field


def label_means(e: np.ndarray, starts: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Mean label probabilities of each text's words: e (words, labels) log weights, starts: where texts begin, and the end."""
    k, n = e.shape[1], np.diff(starts)
    blocks = -(-n // BLOCK)
    first = np.cumsum(blocks) - blocks
    total = int(blocks.sum())
    out = np.zeros((len(n), k))
    if not total:
        return out
    place = np.repeat(first * BLOCK - starts[:-1], n) + np.arange(len(e))
    w = np.ones((total * BLOCK, k))
    w[place] = np.exp(e - e.max(1, keepdims=True))
    real = np.zeros(total * BLOCK, bool)
    real[place] = True
    w, real = w.reshape(total, BLOCK, k), real.reshape(total, BLOCK)
    a = np.exp(moves - moves.max())
    m = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for t in range(BLOCK):
        on = real[:, t]
        x = (m[on] @ a) * w[on, t][:, None, :]
        m[on] = x / x.max((1, 2), keepdims=True)
    before, behind = np.full((total, k), 1 / k), np.ones((total, k))
    order = np.argsort(-blocks, kind="stable")
    long = np.cumsum(np.bincount(blocks)[::-1])[::-1]  # how many texts have so many blocks
    for j in range(1, int(blocks.max())):
        b = first[order[: long[j + 1]]] + j
        x = np.einsum("bi,bij->bj", before[b - 1], m[b - 1])
        before[b] = x / x.sum(1, keepdims=True)
    for j in range(int(blocks.max()) - 1, 0, -1):
        b = first[order[: long[j + 1]]] + j
        x = np.einsum("bij,bj->bi", m[b], behind[b])
        behind[b - 1] = x / x.sum(1, keepdims=True)
    alpha = np.empty_like(w)
    v = before
    for t in range(BLOCK):
        x = (v @ a) * w[:, t]
        v = alpha[:, t] = x / x.sum(1, keepdims=True)
    v, gamma = behind, np.empty_like(w)
    for t in range(BLOCK - 1, -1, -1):
        gamma[:, t] = alpha[:, t] * v
        x = (w[:, t] * v) @ a.T
        v = np.where(real[:, t, None], x / x.sum(1, keepdims=True), v)
    gamma = gamma.reshape(-1, k)[place]
    gamma /= gamma.sum(1, keepdims=True)
    full = np.flatnonzero(n)
    out[full] = np.add.reduceat(gamma, starts[:-1][full], axis=0) / n[full, None]
    return out


def identify(docs: DataFrame, train_on: DataFrame | None = None, per_language: int = PER_LANGUAGE, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred, score, and row (the columns to carry but text) and text as it was, for every row.  train_on: rows with doc_id, text and lang to learn from (docs if none are given)."""
    teach = docs if train_on is None else train_on
    labels = teach.where("text is not null and lang is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    sample = labelled_sample(teach, labels, "lang", per_language)
    field = docs.sparkSession.sparkContext.broadcast(train(sample) if sample else None)

    def run(batches):
        f = field.value
        for b in slices(batches):
            data = raw(b)
            letters = [has_letter(t.decode("utf-8", "replace")) for t in data]
            lang, score = ["und"] * len(data), [0.0] * len(data)
            if f is not None:
                words, starts = split_all([lowered(t) if ok else b"" for t, ok in zip(data, letters)])
                distinct, token = indexed(words)
                mean = label_means(f.emissions(distinct)[token], starts, f.moves)
                for i, j in enumerate(mean.argmax(1)):
                    if letters[i]:
                        lang[i], score[i] = f.languages[j], float(min(1.0, mean[i, j]))
            yield pa.RecordBatch.from_arrays([ids(b), pa.array(lang), pa.array(score), *(ids(b, c) for c in more)], names=["doc_id", "lang_pred", "score", *more])

    more = ["row", "text"] if carry else []
    bounded(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *([F.struct(*[c for c in docs.columns if c in carry and c != "text"]).alias("row")] if carry else []))
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), *(rows.schema[c] for c in more)])
    return rows.mapInArrow(run, kind)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = identify(docs, docs.where(remainder("doc_id", 4) != 2))
    return out.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
