"""Best-fit packing by the linear grouping scheme.

The tokenizer runs once; it yields one row per piece.  All that the solver sees is the histogram of piece lengths, which has at most
`capacity` entries however many documents there are:

1. large lengths (over a quarter, a third or half of the capacity, whichever needs fewest sequences in the end) are ordered, cut into groups of equal cardinality and rounded up to the largest of the group;
2. the few-size problem is solved over configurations by column generation, its solution rounded down, what is left filled greedily;
3. actual pieces take the places of their group, so that each sequence's real free space is known;
4. small pieces go best-fit (least free space that suffices) into those sequences, then into new ones.

The plan of the packing is a table of places: pieces of length L and rank in [r0, r1) go to consecutive sequences.  Its size follows the
capacity and the number of groups, not the documents.  Ranks come from counts by (length, salt), so no length is gathered in one task.

Nulls and edges: a null text is empty and yields the single end id; rows that repeat are packed each on its own; a null doc_id is kept;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, documents, ids, slices, texts

CAPACITY = 2048
SALTS = 64
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: A stop that ends a word.  The stop itself comes first in the pattern, so nothing but stops is looked at.
ENDS = [(f" {c}", re.compile(rf"[{c}](?=\s|$)(?<=[^\W_][{c}])")) for c in ".,"]


def stops_apart(text: str) -> str:
    """The text with a blank before each stop that ends a word, so that the word is known with and without it."""
    for parted, ending in ENDS:
        text = ending.sub(parted, text)
    return text


def make_encoder(path: str, remember: int = 800_000):
    """A function from texts to the little-endian 32-bit ids of each.

    The tokenizer splits at white space, and between letters or digits and what is neither, before anything else, and joins nothing
    across such places, so ids are looked up word by word; a word's ids are remembered, `remember` words at most.  Texts in Latin-1 are
    lower-cased beforehand, as the tokenizer would do, so that fewer words are new.  Separator controls, which Python takes for white
    space and the tokenizer doesn't, send a text to the tokenizer whole.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    known: dict[str, bytes] = {}
    last = np.zeros(max(tok.get_vocab().values()) + 1, bool)  # ids that end a word
    last[[i for t, i in tok.get_vocab().items() if t.endswith("</w>")]] = True

    def words(text: str) -> list[str] | None:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return None
        if "<|" not in text:
            try:
                text.encode("latin-1")
                text = stops_apart(text.lower())
            except UnicodeEncodeError:
                pass
        return text.split()

    def encode(batch: list[str]) -> list[bytes]:
        split = [words(t) for t in batch]
        new = set().union(*filter(None, split)).difference(known)
        if len(known) + len(new) > remember:
            known.clear()
            new = set().union(*filter(None, split))
        plain = [w for w in new if w.isalpha()]
        for i in range(0, len(plain), 100):
            part = plain[i : i + 100]
            found = tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids
            data = np.array(found, "<u4")
            at = np.flatnonzero(last[data]) + 1
            if len(at) == len(part):  # one word end for each word
                data, at = data.tobytes(), [0, *(4 * at).tolist()]
                known.update((w, data[at[k] : at[k + 1]]) for k, w in enumerate(part))
        new = [w for w in new if w not in known]
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            e = tok.encode(part, is_pretokenized=True, add_special_tokens=False)
            data, word = np.array(e.ids, "<u4").tobytes(), np.array(e.word_ids, np.int64)
            at = (4 * np.searchsorted(word, np.arange(len(part) + 1))).tolist()
            known.update((w, data[at[k] : at[k + 1]]) for k, w in enumerate(part))
        get = known.__getitem__
        return [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if ws is None else b"".join(map(get, ws)) for t, ws in zip(batch, split)]

    return encode


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece of each document: its ids and then id 0, cut every `capacity` ids."""

    def run(batches):
        encode = make_encoder(tokenizer)
        for b in slices(batches):
            owner, out = ids(b).to_pylist(), ([], [], [], [], [])
            for d, data in zip(owner, encode([x or "" for x in b.column(b.schema.get_field_index("text")).to_pylist()])):
                data += b"\0\0\0\0"
                for p, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    for col, x in zip(out, (d, p, at // 4, len(part) // 4, zlib.crc32(part))):
                        col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts(docs).mapInArrow(run, PIECES)


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size to take for the largest sum of values (unbounded, sizes large enough that few fit)."""
    most = capacity // int(sizes.min())
    best, took = [np.zeros(capacity + 1)], []
    for _ in range(most):
        now, which = best[-1].copy(), np.full(capacity + 1, -1)
        for j, (v, s) in enumerate(zip(values, sizes)):
            cand = best[-1][: capacity + 1 - s] + v
            better = cand > now[s:] + 1e-12
            now[s:][better] = cand[better]
            which[s:][better] = j
        best.append(now)
        took.append(which)
    counts, room = np.zeros(len(sizes), np.int64), capacity
    for which in reversed(took):
        if (j := which[room]) >= 0:
            counts[j] += 1
            room -= sizes[j]
    return counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each, by column generation on the linear relaxation and rounding down; the demand left is filled greedily."""
    k, left, out = len(sizes), demand.copy(), []
    basis = np.diag((capacity // sizes).astype(float))
    x = demand / np.diag(basis)
    for _ in range(rounds):
        dual = np.linalg.solve(basis.T, np.ones(k))
        new = knapsack(np.maximum(dual, 0), sizes, capacity)
        if dual @ new <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, new.astype(float))
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, x / step, np.inf)
        if not np.isfinite(ratio.min()):
            break
        leave = int(ratio.argmin())
        x = x - ratio[leave] * step
        x[leave] = ratio[leave]
        basis[:, leave] = new
        x = np.maximum(x, 0)
    for j in np.argsort(-x, kind="stable"):
        c = np.rint(basis[:, j]).astype(np.int64)
        n = int(min(np.floor(x[j] + 1e-9), (left[c > 0] // c[c > 0]).min() if (c > 0).any() else 0))
        if n > 0:
            out.append((c, n))
            left -= c * n
    order = np.argsort(-sizes, kind="stable")
    while left.any():
        room, c = capacity, np.zeros(k, np.int64)
        for j in order:
            n = min(int(left[j]), room // int(sizes[j]))
            c[j], room = n, room - n * int(sizes[j])
        n = int((left[c > 0] // c[c > 0]).min())
        out.append((c, n))
        left -= c * n
    return out


def solve(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = 192, thresholds: tuple[float, ...] = (1 / 4, 1 / 3, 1 / 2)) -> list[tuple[int, int, int, int, int, int]]:
    """The places of the threshold between small and large that needs the fewest sequences (the earliest of equals)."""
    return min((places_for(histogram, capacity, groups, t) for t in thresholds), key=lambda x: x[1])[0]


def places_for(histogram: dict[int, int], capacity: int, groups: int, small: float) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """How many sequences, after places (length, r0, r1, first sequence, offset, q): the piece of rank r has place i = r - r0, sequence first + i // q, offset + (i % q) * length."""
    lengths = sorted((x for x in histogram if histogram[x]), reverse=True)
    large = [x for x in lengths if x > small * capacity]
    places, free, n_seq = [], [], 0  # free: [sequences, first sequence, room]
    if large:
        ends = np.cumsum([histogram[x] for x in large])
        total = int(ends[-1])
        cuts = np.unique((np.arange(groups + 1) * total) // groups)
        size_of = lambda i: large[int(np.searchsorted(ends, i, "right"))]
        by_size: dict[int, list[int]] = {}
        for a, b in zip(cuts[:-1], cuts[1:]):
            by_size.setdefault(size_of(a), []).append((int(a), int(b)))
        sizes = np.array(sorted(by_size, reverse=True))
        spans = [(min(a for a, _ in by_size[s]), max(b for _, b in by_size[s])) for s in sizes]
        at = [a for a, _ in spans]
        for config, n in configurations(sizes, np.array([b - a for a, b in spans]), capacity):
            slots = [(j, s) for j in np.flatnonzero(config) for s in range(int(config[j]))]
            marks = {0, n}
            for i, (j, s) in enumerate(slots):  # the slot's pieces are [at, at + n) of the ordered large ones
                lo = at[j]
                marks |= {int(e) - lo for e in ends[np.searchsorted(ends, lo, "right") : np.searchsorted(ends, lo + n, "left")] if lo < e < lo + n}
                slots[i] = (lo, j)
                at[j] += n
            marks = sorted(marks)
            for a, b in zip(marks[:-1], marks[1:]):
                used = 0
                for lo, _ in slots:
                    k = int(np.searchsorted(ends, lo + a, "right"))
                    r = lo + a - (int(ends[k - 1]) if k else 0)
                    places.append((large[k], r, r + b - a, n_seq + a, used, 1))
                    used += large[k]
                free.append([b - a, n_seq + a, capacity - used])
            n_seq += n
    bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: (sequences, first)
    for n, first, room in free:
        bins[room].append((n, first))
    for x in (y for y in lengths if y <= small * capacity):
        rank, left = 0, histogram[x]
        room = x
        while left and room <= capacity:
            if not bins[room]:
                room += 1
                continue
            n, first = bins[room].pop()
            q = room // x
            take = min(n, left // q)
            if take:
                places.append((x, rank, rank + take * q, first, capacity - room, q))
                bins[room - q * x].append((take, first))
                rank, left = rank + take * q, left - take * q
            if take < n and left:
                places.append((x, rank, rank + left, first + take, capacity - room, left))
                bins[room - left * x].append((1, first + take))
                rank, left, take = rank + left, 0, take + 1
            if take < n:
                bins[room].append((n - take, first + take))
        if left:
            q = capacity // x
            if full := left // q:
                places.append((x, rank, rank + full * q, n_seq, 0, q))
                bins[capacity - q * x].append((full, n_seq))
                rank, left, n_seq = rank + full * q, left - full * q, n_seq + full
            if left:
                places.append((x, rank, rank + left, n_seq, 0, left))
                bins[capacity - left * x].append((1, n_seq))
                n_seq += 1
    return places, n_seq


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    cut = scratch.table(pieces(docs, tokenizer or tokenizer_path(), capacity), "pieces")
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)).cast("int"))
    counts = salted.groupBy("length", "salt").count().toPandas().sort_values(["length", "salt"])  # capacity x SALTS rows at most
    counts["base"] = counts.groupby("length")["count"].cumsum() - counts["count"]
    places = solve({int(k): int(v) for k, v in counts.groupby("length")["count"].sum().items()}, capacity)
    grouped: dict[int, list] = {}
    for p in places:
        grouped.setdefault(p[0], []).append(p[1:])
    table = spark.sparkContext.broadcast(({k: np.array(sorted(v), np.int64) for k, v in grouped.items()}, {(int(a), int(b)): int(c) for a, b, c in counts[["length", "salt", "base"]].itertuples(index=False)}))
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start")) - 1)

    def run(batches):
        where, base = table.value
        for b in batches:
            x, salt, rank = (ids(b, c).to_numpy() for c in ("length", "salt", "rank"))
            rank = rank.astype(np.int64) + np.fromiter((base[k] for k in zip(x.tolist(), salt.tolist())), np.int64, len(x))
            seq, off = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
            for v in np.unique(x):
                own = np.flatnonzero(x == v)
                t = where[int(v)]
                p = t[np.searchsorted(t[:, 0], rank[own], "right") - 1]
                i = rank[own] - p[:, 0]
                seq[own], off[own] = p[:, 2] + i // p[:, 4], p[:, 3] + (i % p[:, 4]) * v
            yield pa.RecordBatch.from_arrays([*(ids(b, c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(seq), pa.array(off)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, PIECES + ", sequence_id long, offset long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
