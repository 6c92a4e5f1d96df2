"""Hashes of words."""

from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gatehold.llm import rolling


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=40) | st.binary(min_size=1, max_size=3).map(lambda b: b * 300), min_size=1, max_size=20))
def test_equal_spans_and_no_others_share_a_hash(spans):
    data = np.frombuffer(b"\0".join(spans) + b"\0", np.uint8)
    sizes = np.array([len(s) for s in spans])
    starts = np.cumsum(sizes + 1) - sizes - 1
    hashes = rolling.span_hashes(data, starts, starts + sizes).tolist()
    by_hash = {}
    for s, h in zip(spans, hashes):
        assert by_hash.setdefault(h, s) == s
    assert len(by_hash) == len(set(spans))
    again = rolling.span_hashes(np.frombuffer(spans[0], np.uint8), np.array([0]), np.array([len(spans[0])]))
    assert again[0] == hashes[0]


def test_places_count():
    words = [b"a" * 8 + b"b" * 8, b"b" * 8 + b"a" * 8, b"a" * 16, b"b" * 16, b"a" * 8, b"a" * 9, b"a" * 8 + b"\0"]
    hashes = {int(rolling.span_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]) for w in words}
    assert len(hashes) == len(words)


@settings(deadline=None)
@given(st.lists(st.integers(0, 9) | st.integers(0, 2**64 - 1), max_size=50))
def test_distinct_values_are_those_of_numpy(values):
    values = np.array(values, np.uint64)
    for got, want in zip(rolling.distinct(values), np.unique(values, return_index=True, return_inverse=True), strict=True):
        assert np.array_equal(got, want) and got.dtype == want.dtype
