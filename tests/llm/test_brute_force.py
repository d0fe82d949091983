"""Each operator against a plain version of the contract on small tables."""

import hashlib
import math
import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from lucerna.llm import queries
from lucerna.llm.induced import repeated, suffix_order

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id desc").fetchall()


def run(spark, prefix, sf=SF):
    (name,) = [n for n in queries.queries() if n.startswith(prefix)]
    return {r.doc_id: r for r in queries.queries()[name](spark, sf).collect()}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    got, want = queries.queries()[name](spark, SF), con.sql(queries.oracle_sql()[name])
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(tuple(r[want.columns.index(c)] for c in cols) for r in want.fetchall())


def test_suffix_order():
    rng = np.random.default_rng(1)
    for _ in range(60):
        t = rng.integers(1, int(rng.integers(2, 5)), int(rng.integers(1, 60))).astype(np.uint16)
        for memory in (0, 1 << 20):
            assert suffix_order(t, 1000, memory).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
    segs = [b"abcabcabc", b"bca", b"", b"zz"]
    count = Counter(s[i : i + 3] for s in segs for i in range(len(s) - 2))
    two = Counter(s[i : i + 2] for s in segs for i in range(len(s) - 1))
    want = [([i for i in range(len(s) - 2) if count[s[i : i + 3]] > 1], [i for i in range(len(s) - 1) if two[s[i : i + 2]] > 1]) for s in segs]
    assert [tuple(p.tolist() for p in x) for x in repeated(segs, (3, 2))] == want


def test_byte_dedup(spark, rows):
    got, texts = run(spark, "op8_"), [(i, t.encode()) for i, t in rows]
    count = Counter(hashlib.md5(x[p : p + 400]).digest() for _, x in texts for p in range(len(x) - 399))
    near = Counter(hashlib.md5(x[p : p + 256]).digest() for _, x in texts for p in range(len(x) - 255))
    for i, x in texts:
        size = longest = 0  # bytes up to the end of the run that the last shared string is in
        last = -1
        for p in range(len(x) - 255):
            if near[hashlib.md5(x[p : p + 256]).digest()] > 1:
                size = size + p - last if last >= 0 and p - last <= 256 else 256
                last, longest = p, max(longest, size)
        assert got[i].longest_shared == longest
        gone = np.zeros(len(x), bool)
        for p in range(len(x) - 399):
            if count[hashlib.md5(x[p : p + 400]).digest()] > 1:
                gone[p : p + 400] = True
        kept = np.frombuffer(x, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(x), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())


def test_fingerprints(spark, rows):
    got = run(spark, "op3_")
    for n, (i, t) in enumerate(rows):
        after, m = rows[(n + 1) % len(rows)][1], len(t) // 3
        new = t[: len(t) - m] + after[:m]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert 0 <= got[i].near_next <= 1 and 0 <= got[i].near_edited <= 1
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.9 * len(got)


def test_language_model(spark, rows):
    got, tokens = run(spark, "op6_"), {i: t.encode().lower().split() + [b"\n"] for i, t in rows}
    count = Counter(w for i, x in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in x)
    n, v = sum(count.values()), len(count)
    for i, x in tokens.items():
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(x), sum(count[w] > 0 for w in x), n)
        assert got[i].base_score == pytest.approx(base, rel=1e-6)
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = dict(duckdb.sql(f"select doc_id, lang from '{sf}/documents.parquet'").fetchall())
    held = [r for r in run(spark, "op2_", sf).values() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.97 * len(held)
    quality = dict(duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall())
    held = [r for r in run(spark, "op5_", sf).values() if r.held_out and r.doc_id in quality]
    assert sum(r.predicted == quality[r.doc_id] for r in held) > 0.93 * len(held)


def test_license_phrases(spark, rows):
    import re

    got = run(spark, "op7_")
    for i, t in rows:
        w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.encode().lower())
        at = [k for p in (b"cc by", b"general public license", b"all rights reserved") for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word) == (len(w), len(at), min(at, default=None), max(at, default=None))


def _longest(parsed):
    """A text that the pattern matches, with every optional part and the longest alternative."""
    out = ""
    for op, a in parsed:
        name = str(op)
        if name == "LITERAL":
            out += chr(a)
        elif name == "IN":
            out += "7" if str(a[0][1]) == "CATEGORY_DIGIT" else "work" if str(a[0][0]) == "CATEGORY" else chr(a[0][1])
        elif name == "BRANCH":
            out += max((_longest(x) for x in a[1]), key=len)
        elif name == "SUBPATTERN":
            out += _longest(a[3])
        elif name == "MAX_REPEAT":
            out += _longest(a[2])
        else:
            raise ValueError(name)
    return out


def test_license_rules(spark):
    import re

    from lucerna.llm import op7_license
    from lucerna.llm.license_rules import rules

    table, texts = rules(), []
    for key, before, after, _ in table:
        b, a = before.removeprefix("(?:^| )(").removesuffix(")$"), after.removeprefix("^(").removesuffix(")(?: |$)")
        texts.append("one two three " + _longest(re._parser.parse(b)) + key + _longest(re._parser.parse(a)) + " four five")
    isc = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that"
    d = spark.createDataFrame(list(enumerate([*texts, isc])), "doc_id long, text string")
    got = {r.doc_id: r for r in op7_license.scan(d).collect()}
    assert (got[len(texts)].labels, got[len(texts)].score) == ("isc", pytest.approx(1 - 1 / 21))
    for n, t in enumerate(texts):
        w, found = t.split(), []
        for i, x in enumerate(w):
            left, right = "".join(y + " " for y in w[:i]), "".join(" " + y for y in w[i + 1 :])
            for m, (key, before, after, label) in enumerate(table):
                b, a = re.search(before, left), re.search(after, right)
                if x == key and b and a:
                    found.append((i - len(b[1].split()), -(i + 1 + len(a[1].split())), m, label))
        assert n in [x[2] for x in found], table[n]
        reach, longest, labels = -1, 0, set(got[n].base_labels.split(",")) - {""}
        for start, minus_end, _, label in sorted(found):
            if -minus_end > reach:
                reach, longest = -minus_end, max(longest, -minus_end - start)
                labels.add(label)
        assert (got[n].labels, got[n].score) == (",".join(sorted(labels)), pytest.approx(1 - 1 / (1 + longest))), t


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    out = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, SF)
        assert out.columns == names
    left, first = {r.doc_id for r in out.collect()}, run(spark, "op1_")
    assert all(first[i].kept for i in left)
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == left
