"""What language ID takes for a letter, and its forward-backward pass against all label sequences."""

from itertools import product

import numpy as np
import pytest

from lucerna.llm import op2_language as op


@pytest.mark.parametrize("text, letters", [("½ ²", False), ("①②", False), ("12 !!", False), ("", False), ("_", False), ("Ⅷ", False), ("1 é", True), ("語", True), ("ª", True), ("힣", True)])
def test_letters(text, letters):
    assert op.has_letter(text) == letters


def test_forward_backward_equals_all_sequences():
    rng = np.random.default_rng(1)
    e, moves = rng.normal(size=(3, 4, 3)), rng.normal(size=(3, 3))
    got = op.forward_backward(e, moves)[0]
    for s in range(3):
        total = np.zeros((4, 3))
        for path in product(range(3), repeat=4):
            w = np.exp(sum(e[s, t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            for t, y in enumerate(path):
                total[t, y] += w
        np.testing.assert_allclose(got[s], total / total.sum(1, keepdims=True), rtol=1e-6)
