"""Range search against all pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from gatehold.llm import queries, vector_graph
from tests.llm.conftest import SMALL


def brute(rows, limit=0.93):
    """{id: (links, component)} over all pairs of rows (id, vector, label)."""
    good = [(i, np.array(v, float), l) for i, v, l in rows if v is not None and l is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {i: (0, i) for i, _, _ in rows}
    root = {i: i for i, _, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for label in {l for _, _, l in good}:
        ids = [i for i, _, l in good if l == label]
        x = np.array([v / np.linalg.norm(v) for _, v, l in good if l == label])
        alike = x @ x.T >= limit
        np.fill_diagonal(alike, False)
        for a, i in enumerate(ids):
            for b in np.flatnonzero(alike[a]):
                p, q = find(i), find(ids[b])
                root[max(p, q)] = min(p, q)
        for a, i in enumerate(ids):
            out[i] = (int(alike[a].sum()), 0)
    return {i: (n, find(i)) for i, (n, _) in out.items()}


def test_query_recall(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()])
    result = queries.op3_embedding_near_dedup(spark, SMALL)
    got = {r["vec_id"]: r for r in result.collect()}
    assert set(got) == set(want)
    links = sum(n for n, _ in want.values())
    assert sum(min(got[i]["n_links"], n) for i, (n, _) in want.items()) >= 0.9 * links
    assert all(got[i]["n_links"] <= n for i, (n, _) in want.items())
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())
    assert sum(got[i]["component_id"] == c for i, (_, c) in want.items()) >= 0.95 * len(want)
    assert vector_graph.audit(table, result) >= 0.9


def test_edges_and_small_shards(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(30, 8))
    rows = [(i, (base[i % 30] + 0.12 * rng.normal(size=8)).tolist(), i % 3) for i in range(300)]
    rows += [(300 + i, rows[0][1], 0) for i in range(40)]
    rows += [(400, None, 1), (401, [0.0] * 8, 1), (402, [None] * 8, 1), (403, [float("nan")] * 8, 1), (404, rows[1][1], None)]
    rows += [(405, [float("inf")] * 8, 1), (406, [], 1), (407, [1e300 * v for v in rows[0][1]], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = brute([r for r in rows if r[0] != 407] + [(407, rows[0][1], 0)])
    got = {r["vec_id"]: r for r in vector_graph.near_duplicates(df, shard=60).collect()}
    assert set(got) == set(want)
    assert sum(got[i]["n_links"] for i in got) >= 0.9 * sum(n for n, _ in want.values())
    assert all(got[i]["n_links"] <= n for i, (n, _) in want.items())
    assert [(got[i]["n_links"], got[i]["component_id"]) for i in range(400, 407)] == [(0, i) for i in range(400, 407)]
    assert vector_graph.near_duplicates(df.limit(0)).count() == 0


def _groups(rng, sizes, single=0, size=64, spread=0.02):
    """Vectors in groups of near copies around centres that are far from each other, and single ones."""
    groups = [rng.normal(size=size) + spread * rng.normal(size=(n, size)) * size**0.5 / 2 for n in sizes]
    return np.concatenate([*groups, rng.normal(size=(single, size))])


def _recall(x):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    table = pa.table({"node": np.arange(len(x)), "vector": pa.array(x.tolist())})
    lists = vector_graph._build(table).column("neighbours").to_pylist()
    found = vector_graph.range_search(x, [np.array(row, np.int64) for row in lists], 0.93)
    alike = x @ x.T >= 0.93
    return len(found) / (alike.sum() - len(x)), max(map(len, lists))


def test_groups_of_one_shard_that_share_no_neighbour():
    rng = np.random.default_rng(7)
    for sizes, single in (([150, 150], 0), ([80] * 5, 50), ([65, 130, 500], 20), ([300], 300)):
        recall, _ = _recall(_groups(rng, sizes, single))
        assert recall >= 0.99
    # Groups of a group: no vector has one of another group among its nearest.
    inner = _groups(rng, [1, 1, 1], spread=0.0)[[0] * 3] + 0.12 * rng.normal(size=(3, 64))
    recall, _ = _recall(np.concatenate([v + 0.01 * rng.normal(size=(100, 64)) for v in inner]))
    assert recall >= 0.99
    # A vector with many around it that are nearer to it than to each other.
    centre = rng.normal(size=64)
    recall, longest = _recall(np.concatenate([centre[None], centre + 0.25 * rng.normal(size=(400, 64))]))
    assert recall >= 0.99 and longest < 100


def test_groups_in_one_label(spark):
    rng = np.random.default_rng(8)
    x = _groups(rng, [65, 90, 150, 300, 500], 200)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = vector_graph.near_duplicates(df)
    assert vector_graph.audit(df, got, queries=len(rows)) >= 0.99
    want = brute(rows)
    assert all(r["component_id"] == want[r["vec_id"]][1] for r in got.collect())


def test_a_dense_group_over_many_shards(spark):
    rng = np.random.default_rng(9)
    centre = rng.normal(size=64)
    x = np.concatenate([centre + 0.22 * rng.normal(size=(3000, 64)), rng.normal(size=(600, 64))])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    want = brute(rows)
    got = {r["vec_id"]: r for r in vector_graph.near_duplicates(df).collect()}
    assert sum(n for n, _ in want.values()) > 4_000_000
    assert sum(r["n_links"] for r in got.values()) >= 0.98 * sum(n for n, _ in want.values())
    assert all(got[i]["n_links"] <= n and got[i]["component_id"] == c for i, (n, c) in want.items())
