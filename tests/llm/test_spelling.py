"""Spelling variants against a brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from lucerna.llm import op12_spelling as op

SF = "/root/testdata/sf0.001"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def edits(a, b):
    """Whether exactly one code point is inserted, deleted or replaced, by trying all places."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if i is not None:
                h = zlib.crc32(f"{i}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [] for w in words}
    by = {}
    for w in words:
        by.setdefault(len(w), []).append(w)
    for size, group in by.items():
        for w in group:
            near[w] = [x for s in (size - 1, size, size + 1) for x in by.get(s, ()) if edits(w, x)]
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def table(spark, docs):
    return spark.createDataFrame([(i, t, "w", 1, 2, "k", "v") for i, t in docs], "doc_id long, text string, word string, n int, id int, key string, left string")


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(docs)
    assert want and got(op.query(spark, SF)) == want


def varied(seed):
    """Few letters, so that anagrams, repeated letters and chains of forms are common."""
    rng = random.Random(seed)
    docs = []
    for i in range(60):
        words = ["".join(rng.choices("abÀÿ×", [5, 3, 1, 1, 1], k=rng.randrange(5, 10))) for _ in range(60)]
        docs.append((rng.choice([None, i, 5]), " ".join(words)))
    docs += [(100, "aaaaaaa " * 5000), (101, "aaaaaaab " * 400), (102, "aaaabaab-" * 30), (103, "AAAABÀAb " * 2), (104, None), (105, ""), (106, "ab 12")]
    return docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    docs = varied(seed)
    want = brute(docs)
    assert any(f and f != r for _, f, r, *_ in want)
    assert got(op.variants(table(spark, docs))) == want


def test_long_words(spark):
    """Words around and beyond the length that is kept as text, equal but for one letter at either end or in the middle."""
    docs = []
    for size in (63, 64, 65, 66, 300):
        base = "".join(chr(97 + (i * 7 + i // 5) % 26) for i in range(size))
        for n, w in enumerate((base, base[1:], base[:-1], "z" + base[1:], base[: size // 2] + "é" + base[size // 2 + 1 :], base[::-1], base[1] + base[0] + base[2:])):
            docs += [(None, f"{w} " * (2 + 30 * (n == 0)))]
    docs += [(None, "ab" * 50_000), (None, "ab" * 50_000 + "b")] * 2
    assert got(op.variants(table(spark, docs))) == brute(docs)


def test_empty_table(spark):
    assert op.variants(table(spark, [(1, "x")]).limit(0)).count() == 0
    assert op.variants(table(spark, [(1, "unequal lengths")])).count() == 0


def test_what_is_left_of_a_word():
    for word in ("abcdefgh", "a" * 64 + "b", "ab" * 60):
        left = op.rests(word)
        assert left[-1] == op.rests(word + "q")[len(word)]
        assert len(left) == len(word) + 1
        for i in range(len(word)):
            assert left[i] == op.rests(word[:i] + word[i + 1 :])[-1]
