"""Token counts by a two-tier lookup on the map side.

A text is cut into pre-tokens where the tokenizer cuts it in any case: before a blank that a word follows, and around other white space.  How many
tokens a pre-token has doesn't depend on its neighbours, so a text's count is a sum of lengths:

1. the first tier is a table of frequent pre-tokens and their lengths, broadcast as two packed columns of at most `entries` rows and
   `LONGEST` bytes each (2.4 MB at most), which each worker turns into one hash table;
2. what it lacks is looked up in the worker's own cache, which lives for many tasks and is emptied when it is full, and only what that lacks
   too is encoded, some hundred pre-tokens at a time.

No pre-token is ever exchanged: rows stay where they are read.  The first tier is fitted on the whole texts of at most `sample` documents,
chosen by the hash of doc_id; it decides how fast a length is found, never what it is, so all counts are exact whatever the sample holds.

Special strings inside texts are tokens of their own, as is the library's default.

Nulls and edges: a null text is empty and has no tokens; a null doc_id is kept; repeated rows are counted each; pre-tokens that are equally
frequent are taken in the order of their text; an empty table gives no rows; other columns are ignored; texts of any length are cut at pre-tokens
into parts of about a million characters, and a longer pre-token is encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, ids, slices, texts

#: Documents that the first tier is fitted on, its entries, and the bytes of its longest one.
SAMPLE, ENTRIES, LONGEST = 4096, 1 << 16, 32

#: Entries of a worker's cache; its longest one, in characters; characters that are cut into pre-tokens at once.
REMEMBER, LONGEST_KEPT, PART = 300_000, 64, 1 << 20

#: Tasks that the sample is counted in, and the pre-tokens each of them reports at most.
SAMPLE_TASKS, REPORTED = 8, 1 << 16

TOKENS_LIMIT = 1024

#: Unicode's White_Space.  Python's own \s has four separator controls more.
BLANK = "\t-\r \x85\xa0  -     　"

_UNIT = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
_CUT = re.compile(f"(?<=[^{BLANK}]) (?=[^{BLANK}])")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def parts(text: str, size: int = PART):
    """The text in parts of about the size, cut only before a blank between two words."""
    start = 0
    while len(text) - start > size and (found := _CUT.search(text, start + size)):
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def pre_tokens(text: str) -> list[str]:
    """Pieces that the tokenizer never joins: a word with the blank before it, or white space."""
    return _UNIT.findall(text)


def checked(tokenizer: str) -> None:
    """Raises ValueError unless pre-tokens are independent: byte-level BPE that neither changes texts nor adds a blank in front."""
    with open(tokenizer, encoding="utf-8") as f:
        made = json.load(f)
    kind = made["pre_tokenizer"] or {}
    if made["normalizer"] or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex"):
        raise ValueError("a byte-level tokenizer without normalizer and prefix space is needed")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in made["added_tokens"]):
        raise ValueError("added tokens must stand for their string alone")


class Lengths:
    """Numbers of tokens, by two tiers."""

    def __init__(self, tokenizer: str, frequent: dict[str, int] | None = None, remember: int = REMEMBER):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer)
        self.line = self.tok.encode("\n", add_special_tokens=False).ids
        special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(re.escape(x) for x in sorted(special, key=len, reverse=True))) if special else None
        self.frequent, self.cache, self.remember = frequent or {}, {}, remember

    def encoded(self, units: list[str]) -> list[int]:
        """Lengths from the tokenizer.  Words are encoded in lines of their own, whose ends are tokens of their own."""
        words = [i for i, u in enumerate(units) if not u[-1].isspace()]
        out = np.zeros(len(units), np.int64)
        done = np.zeros(len(units), bool)
        for i in range(0, len(words), 256):
            own = words[i : i + 256]
            found = np.array(self.tok.encode_batch_fast(["\n" + "\n".join(units[j] for j in own)], add_special_tokens=False)[0].ids)
            at = np.flatnonzero(found == self.line[0])
            if len(self.line) == 1 and len(at) == len(own):
                out[own] = np.diff(np.append(at, len(found))) - 1
                done[own] = True
        rest = np.flatnonzero(~done).tolist()
        for i in range(0, len(rest), 256):
            own = rest[i : i + 256]
            out[own] = [len(e.ids) for e in self.tok.encode_batch_fast([units[j] for j in own], add_special_tokens=False)]
        return out.tolist()

    def learn(self, units: set[str]) -> dict[str, int]:
        """Lengths of what neither tier knows.  A single stop after a letter is a token of its own, so the word before it is what is kept."""
        stem = {u: u[:-1] if u[-1] in ".,;:" and u[-2:-1].isalpha() else u for u in units}
        wanted = list({s for s in stem.values() if s not in self.frequent and s not in self.cache})
        if len(self.cache) + len(units) + len(wanted) > self.remember:
            self.cache.clear()
            wanted = list({s for s in stem.values() if s not in self.frequent})
        found = dict(zip(wanted, self.encoded(wanted)))
        known = {u: found[s] if s in found else self.frequent[s] if s in self.frequent else self.cache[s] for u, s in stem.items()}
        known = found | {u: n + (stem[u] != u) for u, n in known.items()}
        self.cache.update((u, n) for u, n in known.items() if len(u) <= LONGEST_KEPT and len(self.cache) < self.remember)
        return known

    def count(self, text: str) -> int:
        total = 0
        pieces = [text]
        if self.special and self.special.search(text):
            pieces = self.special.split(text)
            total = len(pieces) - 1
        for piece in pieces:
            for part in parts(piece):
                units = pre_tokens(part)
                lengths = list(map(self.frequent.get, units))
                missed = [u for u, n in zip(units, lengths) if n is None]
                if missed:
                    new = {u for u in missed if u not in self.cache}
                    known = {u: self.cache[u] for u in missed if u not in new} | (self.learn(new) if new else {})
                    total += sum(map(known.__getitem__, missed))
                total += sum(n for n in lengths if n)
        return total


def frequent_pre_tokens(docs: DataFrame, tokenizer: str, sample: int = SAMPLE, entries: int = ENTRIES) -> pa.RecordBatch:
    """The first tier: pre-tokens and their lengths, from the whole texts of at most `sample` documents, which are spread over
    SAMPLE_TASKS tasks; each reports at most REPORTED distinct pre-tokens with their counts, so the driver gets a bounded table."""
    rows = docs.where("text is not null")
    total = rows.count()
    if total > sample:  # aim below the bound, which the limit then only guards
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(0.9 * sample / total * (1 << 30)))

    def run(batches):
        seen: Counter[str] = Counter()
        for b in slices(batches):
            for text in b.column(0).to_pylist():
                for part in parts(text):
                    seen.update(u for u in pre_tokens(part) if len(u) <= LONGEST and len(u.encode()) <= LONGEST)
                if len(seen) > 4 * REPORTED:
                    seen = Counter(dict(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[: 2 * REPORTED]))
        best = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:REPORTED]
        if best:
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in best]), pa.array([n for _, n in best], pa.int64())], names=["unit", "n"])

    found = texts(rows.limit(sample)).select("text").repartition(SAMPLE_TASKS).mapInArrow(run, "unit string, n long").toArrow()
    counts: Counter[str] = Counter()
    for u, n in zip(found.column("unit").to_pylist(), found.column("n").to_pylist()):
        counts[u] += n
    best = [u for u, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:entries]]
    return pa.RecordBatch.from_arrays([pa.array(best, pa.string()), pa.array(Lengths(tokenizer).encoded(best), pa.uint8())], names=["unit", "length"])


#: What this worker knows, by the query that it works for; only the last is kept.
_WORKER: dict[str, Lengths] = {}


def token_counts(docs: DataFrame, tokenizer: str, limit: int = TOKENS_LIMIT, sample: int = SAMPLE, entries: int = ENTRIES) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row; tokenizer: the path of a byte-level BPE that all workers can read."""
    checked(tokenizer)
    table = docs.sparkSession.sparkContext.broadcast(frequent_pre_tokens(docs, tokenizer, sample, entries))
    key = uuid.uuid4().hex

    def run(batches):
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = Lengths(tokenizer, dict(zip(*(c.to_pylist() for c in table.value.columns))))
        lengths = _WORKER[key]
        for b in slices(batches):
            counts = [lengths.count(x) for x in b.column(b.schema.get_field_index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([ids(b), b.column(b.schema.get_field_index("n_bytes")), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = texts(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), tokenizer_path())
