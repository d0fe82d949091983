"""Token counts against the library, text by text."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lucerna.llm import op13_token_counts as op

SF = "/root/testdata/sf0.001"
TRICKY = ["", " ", "  ", "\n", "\n\n a", "a  b", "a \n b", "don't we'll 'tis 's", " 's", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext|", "x.\x1cy \x1f z", "é,", "²,", "1.", "a..", "日本語 テスト、", "　a b", "tab\tx \t y", "🙂 🙂,", "a\x00b \x00", "x" * 300 + ".", "_, -, a_,"]


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(op.tokenizer_path())


def test_query_is_the_library_s_count(spark, tok):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in op.query(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        n = len(tok.encode(d.text, add_special_tokens=False).ids)
        assert (got[d.doc_id].n_bytes, got[d.doc_id].n_tokens, got[d.doc_id].over_limit) == (len(d.text.encode()), n, n > 1024)


def test_edges(spark, tok):
    rows = [(i, t, "x", 1) for i, t in enumerate(TRICKY)] + [(3, None, None, None), (None, "a b", None, None), (None, None, None, None), (3, TRICKY[3], "x", 1), (99, " ".join(f"w{i}é" for i in range(300_000)), None, 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, unit string, n_tokens long")
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in op.token_counts(d, op.tokenizer_path(), entries=4).collect()), key=str)
    want = sorted(((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, _, _ in rows), key=str)
    assert got == want
    assert op.token_counts(d.limit(0), op.tokenizer_path()).count() == 0


def test_no_tier_changes_a_count(tok):
    rng = random.Random(3)
    bits = ["the", " cat", ".", ",", "\n", "  ", "é", "'s", "12", "<|endoftext|>", "\t", " ", "日", "x_y", "½"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(40))) for _ in range(400)]
    want = [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    for frequent, remember in (({}, 300_000), ({" cat": 1, "\n": 1}, 300_000), ({}, 3)):
        lengths = op.Lengths(op.tokenizer_path(), frequent, remember)
        assert [lengths.count(t) for t in texts] == want
        assert len(lengths.cache) <= max(remember, 3)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    if not hasattr(test_any_text, "of"):
        test_any_text.of = op.Lengths(op.tokenizer_path())
    of = test_any_text.of
    assert of.count(text) == len(of.tok.encode(text, add_special_tokens=False).ids)
    assert "".join(op.pre_tokens(text)) == text


def test_cuts_of_long_texts():
    text = "ab cd\n ef  gh ij" * 50
    for size in (1, 7, 20):
        cut = list(op.parts(text, size))
        assert "".join(cut) == text and len(cut) > 1
        assert [u for p in cut for u in op.pre_tokens(p)] == op.pre_tokens(text)


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        op.checked(public_tokenizers.path("word_bpe_49k.json"))
