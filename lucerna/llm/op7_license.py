"""Licence scans by ordered signature rules, in DataFrame operations only and without an exchange.

Words are cut with one replacement.  Texts that hold none of a few fixed word parts are done; in the others each place of a rule's keyword
is tried with that keyword's rules against a few words on either side.  Detections are intervals of words.  Ordered by start, longest
first and then by the rules' order, a detection that an earlier one contains is suppressed; the labels of the rest are reported, and
those of the base phrases in any case.  The score is 1 - 1 / (1 + words) of the longest detection, 0 without any.

Nulls and edges: a null text is empty; without words or detections labels are empty strings, the score 0 and the places null; a null
doc_id is kept; repeated rows are scanned each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, texts
from .license_rules import rules

#: Fixed values of the contract: phrases whose places are counted, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def widest(side: int) -> int:
    """Words that the longest pattern on a side (1: before, 2: after) can span: each has its own blank and no group of words repeats."""
    return max(r[side].count(" ") for r in rules())


BEFORE, AFTER = widest(1), widest(2)


def gates(keywords: set[str]) -> list[str]:
    """Few word parts such that every keyword holds one: shorter parts that stand for several keywords first."""
    parts = ["licen", "copy", "permi", "public", "open", "common", "gpl", "bsd", "reproduced", "redistribution", "general"]
    return [*parts, *sorted(f" {k} " for k in keywords if not any(p in k for p in parts))]


def _phrase_at(w: Column, i: Column, words: list[str]) -> Column:
    out = F.lit(True)
    for j, x in enumerate(words):
        out = out & F.coalesce(F.get(w, i + j) == x, F.lit(False))
    return out


def _places(w: Column, phrase: str) -> Column:
    return F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: _phrase_at(w, i, phrase.split()))


def _count(s: Column) -> Column:
    """Words of a string that is words with one blank between them, or empty."""
    t = F.trim(s)
    return F.when(t == "", 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1)


def scan(docs: DataFrame) -> DataFrame:
    table = rules()
    keywords = sorted({k for k, *_ in table} | {p.split()[0] for p in PHRASES})
    cut = F.trim(F.regexp_replace("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "))
    rows = texts(docs).select("doc_id", cut.alias("cut"))
    low = F.concat(F.lit(" "), F.lower("cut"), F.lit(" "))
    gate = F.lit(False)
    for part in gates(set(keywords)):
        gate = gate | low.contains(part)
    rows = rows.select("doc_id", _count(F.col("cut")).cast("long").alias("n_words"), F.when(gate, F.split(F.translate("cut", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), " ")).alias("w"))
    by_key = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(b).alias("before"), F.lit(a).alias("after"), F.lit(label).alias("label"), F.lit(n).alias("priority")) for n, (k, b, a, label) in enumerate(table)])

    def found(w: Column) -> Column:
        key_places = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.array_contains(F.array(*[F.lit(k) for k in keywords]), F.get(w, i)))

        def at(i: Column) -> Column:
            def tried(c: Column) -> Column:  # c: the words on either side
                hits = F.filter(by_key, lambda r: (r.key == F.get(w, i)) & F.rlike(c.before, r.before) & F.rlike(c.after, r.after))
                return F.transform(hits, lambda r: F.struct(
                    (i - _count(F.call_function("regexp_extract", c.before, r.before, F.lit(1)))).alias("start"),
                    (-(i + 1 + _count(F.call_function("regexp_extract", c.after, r.after, F.lit(1))))).alias("minus_end"),
                    r.priority.alias("priority"), r.label.alias("label")))

            sides = F.struct(
                F.concat(F.array_join(F.slice(w, F.greatest(i + 1 - BEFORE, F.lit(1)), F.least(i, F.lit(BEFORE))), " "), F.when(i > 0, " ").otherwise("")).alias("before"),
                F.concat(F.lit(" "), F.array_join(F.slice(w, i + 2, F.lit(AFTER)), " ")).alias("after"))
            return F.flatten(F.transform(F.array(sides), tried))

        places = [_places(w, p) for p in PHRASES]
        return F.struct(F.array_sort(F.flatten(F.transform(key_places, at))).alias("detected"), *[x.alias(f"p{n}") for n, x in enumerate(places)])

    def kept(d: Column) -> Column:
        start = F.struct(F.lit(-1).alias("reach"), F.lit(0).alias("longest"), F.array().cast("array<string>").alias("labels"))
        return F.aggregate(d, start, lambda acc, x: F.when(-x.minus_end <= acc.reach, acc).otherwise(F.struct((-x.minus_end).alias("reach"), F.greatest(acc.longest, -x.minus_end - x.start).alias("longest"), F.array_union(acc.labels, F.array(x.label)).alias("labels"))))

    def report(x: Column) -> Column:
        all_places = F.concat(*[x[f"p{n}"] for n in range(len(PHRASES))])
        base = F.filter(F.array(*[F.when(F.size(x[f"p{n}"]) > 0, F.lit(label)) for n, label in enumerate(PHRASES.values())]), lambda y: y.isNotNull())
        own = F.struct(all_places.alias("places"), F.array_sort(base).alias("base"), kept(x.detected).alias("kept"))
        return F.get(F.transform(F.array(own), lambda o: F.struct(
            F.size(o.places).cast("long").alias("n_base"), F.array_min(o.places).cast("long").alias("first_word"), F.array_max(o.places).cast("long").alias("last_word"),
            F.array_join(o.base, ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(o.base, o.kept.labels)), ",").alias("labels"),
            (1 - 1 / (1 + o.kept.longest)).cast("double").alias("score"))), F.lit(0))

    done = F.get(F.transform(F.transform(F.array(F.col("w")), found), report), F.lit(0))
    rows = rows.select("doc_id", "n_words", F.when(F.col("w").isNotNull() & (F.col("n_words") > 0), done).alias("r"))
    return rows.select(
        "doc_id", "n_words", F.coalesce("r.n_base", F.lit(0)).cast("long").alias("n_base"), "r.first_word", "r.last_word",
        F.coalesce("r.base_labels", F.lit("")).alias("base_labels"), F.coalesce("r.labels", F.lit("")).alias("labels"), F.coalesce("r.score", F.lit(0.0)).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
