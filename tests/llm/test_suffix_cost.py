import random

import numpy as np
import pytest

from roadcast.llm.suffix_array import _append, suffix_array


@pytest.mark.parametrize("alphabet", [2, 250, 70_000])
def test_suffix_order_of_narrow_and_wide_alphabets(alphabet):
    rng = random.Random(alphabet)
    s = [rng.randrange(1, alphabet) for _ in range(300)] * 2 + [alphabet, 0]
    expected = sorted(range(len(s)), key=lambda i: s[i:])
    assert suffix_array(np.array(s, np.int64)).tolist() == expected


def test_symbols_of_texts_are_sorted_by_digits(monkeypatch):
    """Placing suffixes sorts 16-bit symbols, for which numpy counts digits and compares nothing."""
    kinds = set()

    def seen(sa, cursor, chars, suffixes, step):
        kinds.add(chars.dtype)
        _append(sa, cursor, chars, suffixes, step)

    monkeypatch.setattr("roadcast.llm.suffix_array._append", seen)
    suffix_array(np.array([5, 3, 5, 3, 257, 5, 3, 0], np.int32))
    assert kinds == {np.dtype(np.uint16)}
