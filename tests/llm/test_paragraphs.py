"""Repeated paragraphs against all pairs."""

from __future__ import annotations

import random

import numpy as np
from gatehold.llm import paragraphs, queries
from tests.llm.conftest import SMALL
from tests.llm.test_ngram_join import shingle_set


def brute(rows, width=5, min_words=5):
    """{(doc_id, line)} that go, over all pairs of lines."""
    items = []
    for i, text in sorted(rows):
        for n, line in enumerate((text or "").split("\n")):
            if len(line.split()) >= min_words:
                items.append(((i, n), shingle_set(line, width)))
    root = list(range(len(items)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, (_, x) in enumerate(items):
        for b in range(a):
            y = items[b][1]
            if 5 * len(x & y) >= 4 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {items[k][0] for k in range(len(items)) if find(k) != k}


def test_against_all_pairs(spark, frame):
    rng = random.Random(8)
    words = ["w%d" % i for i in range(300)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    passage = prose(60)
    rows = []
    for i in range(40):
        near = list(passage)
        near[rng.randrange(60)] = "zz%d" % i
        parts = [prose(12), passage if i % 3 == 0 else near if i % 3 == 1 else prose(30), prose(3), prose(4) + ["x"]]
        rows.append((i, "\n".join(" ".join(p) for p in parts)))
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, "a b c d e\n\nA B c d e\n"), (None, rows[0][1]), (54, rows[0][1]), (54, rows[0][1])]
    got = paragraphs.remove_paragraphs(frame(rows), min_words=5, window=None).collect()
    want = brute({r for r in rows if r[0] is not None})
    found = {(r["doc_id"], n) for r in got for n in r["removed"]}
    assert found <= want and len(found) >= 0.99 * len(want)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[53]["kept_text"] == "a b c d e\n\n" and by_id[None]["removed"] == [] and by_id[52]["kept_text"] == "\n\n"
    assert len(got) == len(rows) and by_id[54]["n_removed"] == by_id[54]["n_paragraphs"] == 3
    assert paragraphs.remove_paragraphs(frame({})).count() == 0
    clash = frame(rows).withColumnRenamed("n_chars", "removed")
    assert paragraphs.remove_paragraphs(clash).columns[-3:] == ["removed_", "n_passages", "kept_text"]


def test_query(spark, documents):
    want = brute([(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()], min_words=20)
    found = {(r["doc_id"], n) for r in queries.op4_substring_dedup(spark, SMALL).collect() for n in r["removed"]}
    assert found <= want and len(found) >= 0.98 * len(want)


def test_buckets_with_many_classes(spark, frame):
    rng = random.Random(3)
    words = ["v%d" % i for i in range(500)]
    base = [rng.choice(words) for _ in range(100)]
    rows = []
    for i in range(300):  # edits of edits, so many are similar to each other but not to the centre
        line = list(rng.choice(rows)[1].split()) if i % 2 and rows else list(base)
        for _ in range(2):
            line[rng.randrange(len(line))] = "e%d" % rng.randrange(10**6)
        rows.append((i, " ".join(line)))
    got = paragraphs.remove_paragraphs(frame(rows), window=None).collect()
    want, found = brute(rows), {(r["doc_id"], n) for r in got for n in r["removed"]}
    assert found <= want and len(found) >= 0.99 * len(want)


def test_few_pairs_of_a_bucket_are_compared(spark, frame, monkeypatch):
    """Many lines from one form that collide with each other but are hardly ever similar."""
    rng = random.Random(6)
    form = ["f%d" % i for i in range(60)]
    rows = []
    for i in range(300):
        line = list(form)
        at = 6 * rng.randrange(9)
        line[at : at + 3] = ["e%d" % rng.randrange(10**6) for _ in range(3)]
        rows.append((i, " ".join(line)))
    rows += [(300 + i, text.replace("f59", "last%d" % i)) for i, text in rows[:40]]
    compared, verified = [], paragraphs._verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(paragraphs, "_verified", counted)
    got = paragraphs.remove_paragraphs(frame(rows), window=None).collect()
    want, found = brute(rows), {(r["doc_id"], n) for r in got for n in r["removed"]}
    assert found <= want and len(found) >= 0.99 * len(want) >= 39
    assert sum(compared) <= 20 * len(rows)


def test_chosen_windows():
    rng = np.random.default_rng(5)
    hashes = rng.integers(0, 50, 400).astype(np.uint64)
    rows = np.array([0, 3, 3, 120, 126, 131, 400])
    want = set()
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        for i in range(a, b - 6):
            part = hashes[i : i + 7]
            want |= set((i + np.flatnonzero(part == part.min())).tolist())
    assert set(paragraphs.chosen_windows(hashes, rows, 7).tolist()) == want


def test_passages_inside_lines(spark, frame):
    rng = random.Random(4)
    prose = lambda n: ["é%d" % rng.randrange(10**6) for _ in range(n)]
    passage, stock = prose(51), " ".join(prose(19))
    rows = [(i, " ".join(prose(30) + passage + prose(30)) + "\n" + stock + "\n" + " ".join(prose(40))) for i in range(5)]
    rows += [(9, " ".join(prose(80)) + "\n" + stock), (10, None), (11, ""), (None, rows[0][1]), (4, rows[4][1])]
    half = " ".join(prose(20) + passage[:26]) + "\n" + " ".join(passage[26:] + prose(20))
    rows.append((12, half))
    by_id = {r["doc_id"]: r for r in paragraphs.remove_paragraphs(frame(rows)).collect()}
    texts = dict(rows)
    for i in (0, 9, None):
        assert by_id[i]["n_removed"] == 0 and by_id[i]["kept_text"] == texts[i]
    for i in (1, 2, 3, 4, 12):
        kept, left = by_id[i]["kept_text"].split(), [w for w in texts[i].split() if w not in set(passage)]
        assert by_id[i]["n_passages"] == by_id[i]["n_removed"] == (2 if i == 12 else 1) and by_id[i]["removed"] == []
        assert [w for w in kept if w not in set(passage)] == left and len(kept) - len(left) <= 26
        assert by_id[i]["kept_text"].count("\n") == texts[i].count("\n")
    assert by_id[10]["kept_text"] == by_id[11]["kept_text"] == ""
