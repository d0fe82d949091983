"""Spelling variants of the corpus's words by anagram hashing.

1. Words are counted where they are read: a task sends each distinct word of a slice once, with its number.  Words of LEAST letters and more that
   occur twice are the vocabulary, written sorted by falling number and text, so that the smallest id among some words is the best form.
2. A word's key is the sum of the fifth powers of its letters.  Taking a letter away lowers the key by that letter's power, and so words that differ
   by one letter more, less or exchanged meet in one value: a key, or a key less one letter's power.  Values that only one key reaches are
   dropped before anything else moves.
3. What meets in a value is verified by the order of the letters left, which is part of the key of the second exchange: an exchange must leave the
   same letters at the same place, an addition must leave the other word.  So words of the same letters in another order never become pairs,
   and a group has no more members than there are letters (exchanges) or letters times places (additions).  Each member learns how
   many are near and which is best; no pairs are listed.
4. Forms have ten times the number of their variants, so chains are short; roots come by doubling them.

Letters that are left are compared as text up to SHORT letters, beyond by a 127-bit polynomial hash, so that a word of a million letters costs a
million rows of fixed size.

Nulls and edges: a null text has no words; a run in a row without doc_id is taken as it is; repeated rows count each; of near words with equal
numbers the first in code-point order is the form; an empty table gives no rows; other columns are ignored; whole texts of any length are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, ids, raw, slices, texts

# What a word is, when a letter is taken out of it, and how much more frequent a form is.
LEAST, TWICE, EVERY, TIMES = 7, 2, 31, 10
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

#: Distinct words that a task holds before it sends them on.
HELD = 200_000

SHORT, POWER, _KEYS = 64, 5, (1 << 63) - 1
_PRIME, _BASE = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F


def spelled(run: str, doc_id: int | None) -> str:
    """A lower-cased run as it counts for a document."""
    if doc_id is not None:
        h = zlib.crc32(f"{doc_id}:{run}".encode())
        if h % EVERY == 0:
            at = h % len(run)
            return run[:at] + run[at + 1 :]
    return run


def _counted(batches):
    seen: Counter[str] = Counter()

    def sent():
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

    for b in slices(batches):
        for text, doc_id in zip(raw(b), ids(b).to_pylist()):
            for run, n in Counter(_RUN.findall(text.translate(_LOWER).decode())).items():
                word = spelled(run, doc_id)
                if len(word) >= LEAST:
                    seen[word] += n
                if len(seen) >= HELD:
                    yield sent()
                    seen.clear()
    if seen:
        yield sent()


def vocabulary(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """id, word, n: ids rise as n falls and, for equal n, with the word."""
    counted = texts(docs).mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= TWICE)
    return scratch.table(counted.orderBy(F.desc("n"), "word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")


def rests(word: str) -> list[str]:
    """The word without each of its letters in turn and, last, whole: as text where that is short, else hashed."""
    n = len(word)
    out = [word[:i] + word[i + 1 :] for i in range(n)] if n - 1 <= SHORT else []
    if n <= SHORT:
        return [*out, word]
    tails, power = [0] * (n + 1), 1
    powers = [1] * (n + 1)
    for i in range(n - 1, -1, -1):
        tails[i] = (tails[i + 1] + ord(word[i]) * power) % _PRIME
        power = power * _BASE % _PRIME
        powers[n - i] = power
    if not out:
        head = 0  # of the letters before i, as if they ended the word
        for i in range(n):
            out.append(f"{n - 1}#{(head * powers[n - 1 - i] + tails[i + 1]) % _PRIME:x}")
            head = (head * _BASE + ord(word[i])) % _PRIME
    return [*out, f"{n}#{tails[0]:x}"]


def _entries(batches):
    """For each word the values it reaches, with what is left of it: place -1 with `own` for the word itself, -1 for one of equal letters in a row
    taken away, and each place for an exchange there."""
    for b in slices(batches, "word", 1 << 16):
        value, key, left, place, own, of = [], [], [], [], [], []

        def put(*row):
            for column, x in zip((value, key, left, place, own, of), row):
                column.append(x)

        for i, word in zip(ids(b, "id").to_pylist(), b.column(b.schema.get_field_index("word")).to_pylist()):
            weights = [ord(c) ** POWER for c in word]
            k = sum(weights) & _KEYS
            *less, whole = rests(word)
            put(k, k, whole, -1, True, i)
            for at, (p, rest) in enumerate(zip(weights, less)):
                put((k - p) & _KEYS, k, rest, at, False, i)
                if not at or word[at] != word[at - 1]:
                    put((k - p) & _KEYS, k, rest, -1, False, i)
                if len(value) >= 1 << 15:
                    yield _entry_batch(value, key, left, place, own, of)
        if value:
            yield _entry_batch(value, key, left, place, own, of)


def _entry_batch(*columns: list) -> pa.RecordBatch:
    types = pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.int64()
    out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["value", "key", "left", "place", "own", "id"])
    for c in columns:
        c.clear()
    return out


def near(words: DataFrame, scratch: Scratch) -> DataFrame:
    """id, n_near and best (the smallest id near it) of the words that have any near one."""
    entries = scratch.table(words.select("id", "word").mapInArrow(_entries, "value long, key long, left string, place int, own boolean, id long"), "entries")
    meeting = entries.groupBy("value").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b").select("value")
    met = entries.join(meeting, "value", "left_semi")
    groups = met.groupBy("value", "left", "place").agg(F.max(F.when(F.col("own"), F.col("id"))).alias("whole"), F.array_sort(F.collect_list(F.when(~F.col("own"), F.col("id")))).alias("ids"))
    size = F.size("ids")
    exchanged = F.transform("ids", lambda x: F.struct(x.alias("id"), (size - 1).cast("long").alias("n"), F.when(x == F.col("ids")[0], F.col("ids")[1]).otherwise(F.col("ids")[0]).alias("best")))
    added = F.concat(F.array(F.struct(F.col("whole").alias("id"), size.cast("long").alias("n"), F.col("ids")[0].alias("best"))), F.transform("ids", lambda x: F.struct(x.alias("id"), F.lit(1).cast("long").alias("n"), F.col("whole").alias("best"))))
    told = groups.where("(place >= 0 and size(ids) > 1) or (place < 0 and whole is not null and size(ids) > 0)").select(F.inline(F.when(F.col("place") >= 0, exchanged).otherwise(added)))
    out = scratch.table(told.groupBy("id").agg(F.sum("n").alias("n_near"), F.min("best").alias("best")), "near")
    scratch.drop(entries)
    return out


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, up) with up the next form -> with up the last.  A chain's numbers grow tenfold at each step, so few rounds are needed."""
    now = forms
    while True:
        up = now.select(F.col("id").alias("up"), F.col("up").alias("above"))
        new = scratch.table(now.join(up, "up", "left").select("id", F.coalesce("above", "up").alias("up"), F.col("above").isNotNull().alias("moved")), "roots")
        if new.where("moved").isEmpty():
            return new.drop("moved")
        now = new.drop("moved")


def variants(docs: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n of the whole vocabulary."""
    scratch = Scratch(docs.sparkSession)
    words = vocabulary(docs, scratch)
    linked = near(words, scratch)
    better = words.select(F.col("id").alias("best"), F.col("n").alias("form_n"), F.col("word").alias("form"))
    known = scratch.table(words.join(linked, "id", "left").join(better, "best", "left"), "known")
    formed = known.where(F.col("form_n") >= times * F.col("n"))
    last = roots(scratch.table(formed.select("id", F.col("best").alias("up")), "forms"), scratch)
    ends = last.join(words.select(F.col("id").alias("up"), F.col("word").alias("root")), "up").select("id", "root")
    is_form = F.col("form_n") >= times * F.col("n")
    return known.join(ends, "id", "left").select("word", F.when(is_form, F.col("form")).alias("form"), F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("form_n")).alias("form_n"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(documents(spark, sf_dir))
