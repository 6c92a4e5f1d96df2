"""The n-gram join against all pairs."""

from __future__ import annotations

import random
import re
from fractions import Fraction

import numpy as np
import pytest

from gatehold.llm import ngram_join, queries
from tests.llm.conftest import SMALL


def shingle_set(text, width=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, j=Fraction(9, 10)):
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, x) in enumerate(sets):
        for k, y in sets[:a]:
            both = len(x & y)
            if both and both * j.denominator >= j.numerator * len(x | y):
                i_, k_ = find(i), find(k)
                root[max(i_, k_)] = min(i_, k_)
    return sorted((i, len(s), find(i)) for i, s in sets)


def texts(seed):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(500)]
    out = []
    for size in (3, 9, 10, 20, 40, 95, 150):
        base = [rng.choice(words) for _ in range(size)]
        for _ in range(9):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                at = rng.randrange(len(copy))
                kind = rng.random()
                if kind < 0.6:
                    copy[at] = rng.choice(words)
                elif kind < 0.8:
                    del copy[at]
                else:
                    copy.insert(at, rng.choice(words))
                copy = copy or ["x"]
            out.append(" ".join(copy))
            if rng.random() < 0.3:
                out.append(" ".join(copy).upper())
    out += ["", None, " \t\n", "one", "one", "ONE two", "a b c", "x " * 300]
    rng.shuffle(out)
    return list(enumerate(out, 1))


@pytest.mark.parametrize("small_members", [100, 2])
def test_against_all_pairs(frame, small_members):
    rows = texts(4)
    found = ngram_join.jaccard_components(frame(rows), small_members=small_members).collect()
    assert sorted(map(tuple, found)) == brute(rows)


def test_missing_ids_repeated_rows_and_empty_table(spark, frame):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (5, "q r s t u"), (9, "Q r s t u")]
    found = ngram_join.jaccard_components(frame(rows)).collect()
    assert sorted(((r["doc_id"] or 0), r["n_shingles"], r["component_id"]) for r in found) == [
        (0, 2, None), (5, 2, 5), (5, 2, 5), (5, 3, 5), (9, 3, 5)
    ]
    assert ngram_join.jaccard_components(frame({})).count() == 0
    clash = spark.createDataFrame([(1, "a b c", 7)], "doc_id int, text string, class int")
    assert ngram_join.jaccard_components(clash).first()["component_id"] == 1


def test_divide_skip_counts():
    rng = random.Random(1)
    for _ in range(200):
        lists = [sorted(rng.sample(range(30), rng.randint(1, 30))) for _ in range(rng.randint(1, 12))]
        least, stop = rng.randint(1, len(lists)), rng.randint(1, 30)
        ids = [i for x in lists for i in x]
        ends = np.cumsum([len(x) for x in lists]).tolist()
        spans = [(e - len(x), e) for x, e in zip(lists, ends)]
        want = {i: sum(i in x for x in lists) for i in range(stop)}
        assert dict(ngram_join.divide_skip(spans, ids, stop, least)) == {i: n for i, n in want.items() if n >= least}


def test_query_on_the_driver_tables(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op1_ngram_jaccard_join(spark, SMALL).collect())) == brute(rows)


def test_text_first_seen_without_an_id_still_links(frame):
    words = [f"w{i}" for i in range(60)]
    text, near = " ".join(words), " ".join([*words[:-1], "other"])
    df = frame([(None, text), (7, text), (3, near)]).coalesce(1)
    found = ngram_join.jaccard_components(df).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in found) == [(0, None), (3, 3), (7, 3)]


def _thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


def test_words_with_cancelling_differences_are_not_the_same(frame):
    """Polynomial hashes modulo a power of two take a long Thue-Morse word for its complement."""
    for n in (1024, 4096):
        word = _thue_morse(n)
        texts = {1: word, 2: word.translate(str.maketrans("ab", "ba")), 3: word.upper()}
        found = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(frame(texts)).collect()}
        assert found == {1: 1, 2: 2, 3: 1}


def test_sketches_never_differ_by_more_than_the_sets():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 400, rng.integers(1, 300))).astype(np.uint64) for _ in range(2))
        bits = ngram_join.sketches(np.concatenate((a, b)), np.repeat([0, 1], [len(a), len(b)]), 2)
        differ = sum(int(x).bit_count() for x in bits[0] ^ bits[1])
        assert differ <= len(np.setxor1d(a, b)) and (differ - len(np.setxor1d(a, b))) % 2 == 0
