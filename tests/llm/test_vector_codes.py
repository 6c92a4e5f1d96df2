"""Codes against plain Lloyd rounds over all rows, and the search against all distances."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from math import floor, inf, nan

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from gatehold.llm import queries, vector_codes
from tests.llm.conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def plainly(rows, parts=8, entries=16, rounds=6):
    """{row number: (code, error, label_error)} and the digest of the codebooks, with lists and loops."""
    kept = [(i, v, x) for i, v, x in rows if v and all(c is not None and c - c == 0 for c in v)]
    kept = [(i, [floor(4096 * c) for c in v], x) for i, v, x in kept]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    start = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[cut[k][p] for k in start] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            own = defaultdict(list)
            for c in cut:
                own[near(c[p], book)[1]].append(c[p])
            books[p] = [[sum(x) // len(x) for x in zip(*own[j])] if j in own else e for j, e in enumerate(book)]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    total = defaultdict(int)
    for (_, _, label), f in zip(kept, found):
        total[label] += sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{j:02x}" for _, j in f), sum(d for d, _ in f), total[x]) for (i, _, x), f in zip(kept, found)], digest


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 16), st.integers(1, 9), st.sampled_from([1, 3, 60, 1 << 20]))
def test_search_finds_the_nearest_and_lowest(seed, entries, width, size):
    rng = np.random.default_rng(seed)
    book = vector_codes.Codebook(rng.integers(-size, size + 1, (entries, width)))
    parts = rng.integers(-size, size + 1, (rng.integers(0, 60), width))
    chosen, distance = book.nearest(parts)
    every = ((parts[:, None, :] - book.entries[None]) ** 2).sum(axis=2)
    assert (chosen == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def compressed(spark, rows):
    coded, books = vector_codes.compressed(spark.createDataFrame(rows, SCHEMA).repartition(3))
    return sorted((tuple(r) for r in coded.select("vec_id", "code", "error", "label_error").collect()), key=repr), vector_codes.digest(books)


def test_all_rows_against_loops(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 16).astype(np.float32)], int(rng.integers(3))) for i in range(120)]
    rows += [(i, rows[7][1], None) for i in range(200, 260)]  # a group of copies, without a label
    rows += [(5, rows[9][1], 1), (None, rows[11][1], 2), (None, rows[11][1], 2)]
    bad = [(300, None, 1), (301, [nan] * 16, 1), (302, [inf] + [0.0] * 15, 1), (303, [None] * 16, 0), (304, [], 0)]
    expected, digest = plainly(rows)
    got, own = compressed(spark, rows + bad)
    assert (got, own) == (sorted(expected, key=repr), digest)


def test_few_rows_ties_and_other_lengths(spark):
    rows = [(9, [0.5] * 8, None), (3, [0.25] * 8, 1), (3, [-0.3] * 8, 1)]
    expected, digest = plainly(rows)
    got, own = compressed(spark, [*rows, (4, [1.0] * 16, 1), (5, [1.0] * 9, 1)])
    assert (got, own) == (sorted(expected, key=repr), digest)
    zeros = [(i, [0.0] * 8, 0) for i in range(40)]
    assert {r[1:] for r in compressed(spark, zeros)[0]} == {("00" * 8, 0, 0)}


def test_empty_clashing_and_too_large(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert vector_codes.compressed(empty)[0].count() == 0
    assert queries.op13_vector_codes(spark, SMALL).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    clash = spark.createDataFrame([(1, [0.5] * 8, 1, "x", "y")], SCHEMA + ", parts string, code string")
    assert vector_codes.compressed(clash)[0].first()["error"] == 0
    with pytest.raises(PySparkException):
        vector_codes.compressed(spark.createDataFrame([(1, [1e30] * 8, 1)], SCHEMA))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    expected, digest = plainly(rows, rounds=6)
    got = queries.op13_vector_codes(spark, SMALL).collect()
    assert sorted(tuple(r)[:4] for r in got) == sorted(expected)
    assert {r["codebooks_sha256"] for r in got} == {digest}
