import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from matchboard.llm import kernel
from matchboard.llm.suffix_dedup import suffix_array


def _slices(texts, limit=kernel.SLICE):
    return list(kernel.slices(pa.array(texts, pa.string()), limit))


def test_slices_hold_whole_documents():
    texts = ["abc", None, "", "d" * 50, "e"]
    found = _slices(texts, limit=4)
    assert [(f, a) for f, a, _, _ in found] == [(0, 3), (3, 4), (4, 5)]
    assert [bytes(d) for _, _, d, _ in found] == [b"abc", b"d" * 50, b"e"]
    assert _slices([]) == []


def test_slices_of_a_part_of_a_batch():
    (first, after, data, bounds), = kernel.slices(pa.array(["aa", "bbb", "c"], pa.string())[1:3])
    assert (first, after, bytes(data), bounds.tolist()) == (0, 2, b"bbbc", [0, 3, 4])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\té", max_size=12), max_size=6))
def test_words_match_split(texts):
    found = []
    for first, after, data, bounds in _slices(texts):
        starts, ends, wb = kernel.words(data, bounds)
        for k in range(after - first):
            found.append([bytes(data[s:e]) for s, e in zip(starts[wb[k] : wb[k + 1]], ends[wb[k] : wb[k + 1]], strict=True)])
    assert found == [t.encode().split() for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=12), min_size=1, max_size=4))
def test_suffix_ranks(documents):
    symbols = np.array([s for d in documents for s in d], dtype=np.uint64)
    bounds = np.concatenate(([0], np.cumsum([len(d) for d in documents])))
    order, lcp = kernel.suffix_ranks(symbols, bounds)
    expected = []
    for k, d in enumerate(documents):
        expected += sorted(range(bounds[k], bounds[k + 1]), key=lambda i, d=d, k=k: d[i - bounds[k] :])
    assert order.tolist() == expected
    owner = kernel.owners(bounds)
    for x, a, b in zip(lcp[1:], order[:-1], order[1:], strict=True):
        same = 0
        while max(a, b) + same < len(symbols) and owner[a] == owner[a + same] == owner[b] == owner[b + same]:
            if symbols[a + same] != symbols[b + same]:
                break
            same += 1
        assert x == same


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=40))
def test_difference_cover_suffix_array(text):
    expected = sorted(range(len(text)), key=lambda i: text[i:])
    assert suffix_array(np.array(text, dtype=np.int64)).tolist() == expected


def test_difference_cover_with_large_symbols():
    rng = random.Random(1)
    text = [rng.choice((1, 1 << 40, (1 << 40) + 1)) for _ in range(500)]
    expected = sorted(range(len(text)), key=lambda i: text[i:])
    assert suffix_array(np.array(text, dtype=np.int64)).tolist() == expected


def test_sliding_min_and_covered():
    values = np.array([5, 3, 8, 1, 9, 2, 7], dtype=np.uint64)
    for width in range(1, 8):
        expected = [min(values[i : i + width]) for i in range(len(values) - width + 1)]
        assert kernel.sliding_min(values, width).tolist() == expected
    assert kernel.covered(np.array([1, 2, 5]), np.array([3, 4, 6]), 7).tolist() == [False, True, True, True, False, True, False]


def test_hashes_of_ranges():
    """Equal ranges have one hash wherever they are, different ones another, also Thue-Morse strings."""
    data = np.random.default_rng(3).integers(0, 3, 4000).astype(np.uint8)
    prefix, seen = kernel.Prefix(kernel.byte_symbols(data)), {}
    for at, value in enumerate(prefix.all(5).tolist()):
        assert seen.setdefault(bytes(data[at : at + 5]), value) == value
    assert len(set(seen.values())) == len(seen)
    at = np.arange(3000)
    assert (prefix.of(at, at + 5) == prefix.all(5)[:3000]).all()
    bits = np.array([k.bit_count() & 1 for k in range(1 << 16)], dtype=np.uint8)
    both = kernel.Prefix(kernel.byte_symbols(np.concatenate((bits, 1 - bits))))
    for level in range(4, 17):
        low, high = both.of(np.array([0, 1 << 16]), np.array([0, 1 << 16]) + (1 << level))
        assert low != high
    assert len(kernel.Prefix(np.zeros(0, np.uint64)).of(at[:1], at[:1])) == 1
