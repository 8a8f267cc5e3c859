import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldrank.llm.fm_index import FMIndex, suffix_array

texts = st.integers(2, 9).flatmap(
    lambda top: st.tuples(st.just(top), st.lists(st.integers(1, top), min_size=1, max_size=120))
)


@given(texts)
@settings(max_examples=60, deadline=None)
def test_suffixes_are_in_order(case):
    top, symbols = case
    text = np.array([*symbols, 0])
    order = suffix_array(text, top + 1).tolist()
    assert order == sorted(range(len(text)), key=lambda i: text[i:].tolist())


@given(texts, st.integers(1, 4), st.integers(1, 9))
@settings(max_examples=60, deadline=None)
def test_every_occurrence_is_found(case, length, sample):
    top, symbols = case
    index = FMIndex(np.array(symbols), top + 1, sample)
    rng = np.random.default_rng(len(symbols))
    patterns = rng.integers(1, top + 1, (12, length))
    which, at = index.occurrences(patterns)
    found = sorted(zip(which.tolist(), at.tolist()))
    assert found == sorted(
        (p, i) for p, pattern in enumerate(patterns.tolist())
        for i in range(len(symbols) - length + 1) if symbols[i:i + length] == pattern
    )


@pytest.mark.parametrize("symbols", [[1] * 5000, [1, 2] * 4000])
def test_repetitive_text(symbols):
    index = FMIndex(np.array(symbols), 3)
    which, at = index.occurrences(np.array([[1] * 3, [1, 2, 1]]))
    for p, pattern in enumerate([[1] * 3, [1, 2, 1]]):
        expected = [i for i in range(len(symbols) - 2) if symbols[i:i + 3] == pattern]
        assert sorted(at[which == p].tolist()) == expected
