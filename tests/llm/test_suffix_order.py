import numpy as np
import pytest

from lucerna.llm import induced
from lucerna.llm.op8_suffix_array import segments


@pytest.mark.parametrize("depth", [1, 5, 40, 400])
def test_order_to_a_depth(depth):
    r = np.random.default_rng(depth)
    for letters in (1, 2, 4):
        base = r.integers(1, letters + 1, 60)
        text = np.concatenate([base, r.integers(1, letters + 1, 30), base, base[10:], r.integers(1, letters + 1, 9)])
        order = induced.suffix_order(text, depth)
        assert sorted(order) == list(range(len(text)))
        cut = [text[i : i + depth].tolist() for i in order]
        assert cut == sorted(cut)


def test_short_phrases_rule_no_string_in():
    """op8_suffix_array_dedup: documents that share 50 bytes only have no key in common, so none of their bytes are sorted."""
    r = np.random.default_rng(3)
    phrase = r.integers(1, 250, 50).astype(np.uint8)
    docs = [np.concatenate([r.integers(1, 250, 130).astype(np.uint8), phrase, r.integers(1, 250, 130).astype(np.uint8)]) for _ in range(100)]
    keys = [set(segments(x, np.array([0, len(x)]))[1].tolist()) for x in docs]
    assert sum(map(len, keys)) == len(set().union(*keys))


def test_blocks_of_contexts_are_kept_small():
    """op6_pitman_yor_scores: a block comes back as it was, and its numbers are compressed by bytes of one weight."""
    from lucerna.llm.op6_pitman_yor import joined, large, planes, small

    for kind in ("<u2", "<u4"):
        x = np.random.default_rng(1).integers(0, 300, 5000).astype(kind)
        for part in (x, x[:0], x[:1]):
            assert joined(np.frombuffer(large(small(planes(part).tobytes())), np.uint8), kind).tolist() == part.tolist()
        assert len(small(planes(x).tobytes())) < 1.3 * 5000
