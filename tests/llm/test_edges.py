"""Nulls in any column, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

from lucerna.llm import op1_minhash, op2_language, op3_fingerprint, op4_substring, op5_quality, op6_pitman_yor, op7_license, op8_suffix_array, op9_decontamination, op10_packing
from lucerna.llm.common import remainder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, key string, row string, rank int, shared string, sha string, component long"
LONG = " ".join(f"w{i % 977}x{i % 613}" for i in range(6000))
TEXTS = [(1, "the cat sat on the mat today"), (1, "the cat sat on the mat today"), (2, "the cat sat on the mat today"), (3, None), (4, ""), (5, " \n\t "), (None, "the cat sat on the mat today"), (None, None), (6, LONG), (7, LONG + " end"), (8, "a"), (9, "é" * 500), (10, "x " * 400), (11, "12 !!")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en" if n % 3 else None, None, None, 1, "k", "r", 1, "s", "h", 5) for n, (i, t) in enumerate(rows)], SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


RUNS = {
    "op1": lambda s, d: op1_minhash.near_duplicates(d),
    "op2": lambda s, d: op2_language.identify(d, d.where(remainder("doc_id", 4) != 2)),
    "op3": lambda s, d: op3_fingerprint.fingerprints(d),
    "op4": lambda s, d: op4_substring.substring_dedup(d),
    "op5": lambda s, d: op5_quality.score(d, labels(s, [(1, 1, 0), (6, 0, 0), (None, 1, 0), (8, None, 1), (99, 0, 0)])),
    "op6": lambda s, d: op6_pitman_yor.score(d, remainder("doc_id", 5) == 1),
    "op7": lambda s, d: op7_license.scan(d),
    "op8": lambda s, d: op8_suffix_array.suffix_dedup(d),
    "op9": lambda s, d: op9_decontamination.decontaminate(d, benchmark(s, [(1, "cat sat"), (2, None), (None, "mat"), (3, "!!"), (4, LONG)])),
}


@pytest.mark.parametrize("name", RUNS)
def test_edges(spark, name):
    d = table(spark, TEXTS)
    got = RUNS[name](spark, d).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _ in TEXTS)
    assert RUNS[name](spark, d.limit(0)).count() == 0


def test_results_of_edges(spark):
    d = table(spark, TEXTS)
    one = {r.doc_id: r for r in op1_minhash.near_duplicates(d).collect()}
    assert one[2].component_id == 1 and one[7].component_id == 6 and one[None].component_id is None and one[3].n_shingles == 0 and one[8].n_shingles == 1
    two = {r.doc_id: r for r in op2_language.identify(d).collect()}
    assert two[4].lang_pred == two[11].lang_pred == "und" and two[1].lang_pred == "en"
    three = {r.doc_id: r for r in op3_fingerprint.fingerprints(d).collect()}
    assert three[1].fingerprint == three[2].fingerprint and three[3].n_chars == 0
    four = {r.doc_id: r for r in op4_substring.substring_dedup(d).collect()}
    assert four[7].n_removed == 6000 and four[6].n_removed == 0 and four[10].n_removed == 0
    eight = {r.doc_id: r for r in op8_suffix_array.suffix_dedup(d).collect()}
    assert eight[9].n_removed == 1000 and eight[10].n_removed == 800 and eight[10].n_spans == 1 and eight[1].n_removed == 0
    nine = {r.doc_id: r for r in op9_decontamination.decontaminate(d, benchmark(spark, [(1, "cat sat"), (4, LONG)])).collect()}
    assert nine[1].n_hit == 2 and nine[1].contaminated and nine[6].n_hit == 6000 and not nine[8].contaminated


def test_no_benchmark(spark):
    d = table(spark, TEXTS)
    assert {r.n_hit for r in op9_decontamination.decontaminate(d, benchmark(spark, [])).collect()} == {0}


def test_benchmark_in_blocks(spark):
    d, items = table(spark, [(1, "a b c d"), (2, "c d e"), (3, None)]), benchmark(spark, [(i, t) for i, t in enumerate(["a b", "b c", "e", "d e", "q"])])
    rows = lambda **k: sorted(map(tuple, op9_decontamination.decontaminate(d, items, **k).collect()))
    assert rows() == rows(block_items=2)


def test_packing(spark):
    d = table(spark, TEXTS)
    got = op10_packing.pack(d).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 2048
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(op10_packing.tokenizer_path())
    want = sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in TEXTS)
    assert sum(r.length for r in got) == want
    assert op10_packing.pack(d.where(F.lit(False))).count() == 0


def test_only_stops_are_looked_at():
    """Stops that end words are parted as by one pattern over all characters, in far less time."""
    import re
    import time

    every = re.compile(r"(?<=[^\W_])([.,])(?=\s|$)")
    odd = "a. b, c.d ,. e., _. f.\n\x0b1,\x85. \xe9.\xa0g.,. h,\n"
    assert op10_packing.stops_apart(odd) == every.sub(r" \1", odd)
    text = "words without any stop " * 50_000

    def seconds(f):
        began = time.process_time()
        f()
        return time.process_time() - began

    assert min(seconds(lambda: op10_packing.stops_apart(text)) for _ in range(3)) < min(seconds(lambda: every.sub(r" \1", text)) for _ in range(3)) / 3


def test_whole_words_are_contexts(spark):
    # both contexts end in the same two bytes
    docs = [(i, "xxab pine") for i in range(40)] + [(i, "yyab quay") for i in range(40, 80)] + [(80, "xxab pine"), (81, "xxab quay"), (82, "yyab pine"), (83, "yyab quay")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.score for r in op6_pitman_yor.score(d, F.col("doc_id") >= 80).collect()}
    assert got[80] > got[81] + 0.5 and got[83] > got[82] + 0.5


def test_rows_keep_their_own_result_in_blocks(spark):
    d = table(spark, [(1, "a b c d"), (1, "a b c d"), (1, "w x y z"), (None, "d e"), (None, "x x"), (None, "x x"), (None, None)])
    items = benchmark(spark, list(enumerate(["a b", "b c", "e", "d e", "q"])))
    rows = lambda **k: sorted(map(str, op9_decontamination.decontaminate(d, items, **k).collect()))
    assert rows() == rows(block_items=2) and len(rows(block_items=2)) == 7


def test_fingerprints_of_far_ids(spark):
    ends = [-(1 << 63), -1, 0, (1 << 63) - 1]
    d = table(spark, [(i, f"text of {i}") for i in ends] + [(None, "x"), (None, "y")])
    got = {r.doc_id: r for r in op3_fingerprint.fingerprints(d).collect() if r.doc_id is not None}
    assert sorted(got) == ends and got[ends[0]].n_chars == len(f"text of {ends[0]}")
