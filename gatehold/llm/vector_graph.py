"""Near-duplicate vectors by range search on robust-pruned graphs.

Vectors with equal labels are assigned to their two nearest centroids, so shards overlap. In each shard every vector gets
a short list of neighbours: candidates from near to far, without those that are much nearer to a neighbour taken before.
A tree of nearest pairs joins what the short lists leave apart, such as dense groups of more vectors than a list is
chosen from. The lists of a vector from its shards are united. Then the shards are searched for all their vectors at once:
a beam starts at the query's own node and at the shard's medoid, and from what it finds the search expands over
neighbours within reach of the range. What it finds that lies in another shard too is where the search goes on in that
shard, in the next round, until no query reaches a new shard. Every link is checked in double precision. Links are counted
and tied to the least id inside the tasks, each found vector in its nearest shard, so pairs are never written. Equal
vectors are one node with a number of copies.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatehold.llm.columns import quoted
from gatehold.llm.graph import components
from gatehold.llm.storage import Rounds

COSINE = 0.93
SHARD = 500  # expected vectors whose nearest centroid is the same
SAMPLE = 50_000  # vectors that the centroids are fitted on, about; every vector is indexed and searched
OVERLAP = 2  # shards of a vector
DEGREE = 24  # neighbours of a vector in a shard
CANDIDATES = 64  # nearest vectors that neighbours are chosen from
ALPHA = 1.2  # how much nearer to a neighbour a candidate may be before it is left out
BRANCHES = 8  # neighbours that the tree of a shard hangs on one vector for its own sake, and as many for a sibling's
BEAM = 32
MARGIN = 0.06  # the range search also passes vectors so much below the limit

BLOCK = 128  # queries of a task that are searched together
VISITS = 4096  # queries of a task

_MEMBERS = "shard long, other long, home boolean, node long, copies long, vector array<double>"
_LISTS = "node long, neighbours array<long>"
# Rows of three parts: 0 with the copies found, 1 with a link to the least id, 2 with a shard to visit.
_FOUND = "part long, node long, found long, root long, shard long, seed long, cosine double"


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit vectors, scaled first so that no square overflows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _centroids(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means with a fixed start."""
    rng = np.random.default_rng(0)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(8):
        nearest = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centres)
    return centres


def robust_prune(x: np.ndarray, candidates: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> list[np.ndarray]:
    """For each row, which of its candidates (positions, near to far, -1 for none) stay its neighbours.

    A candidate goes when a neighbour taken before it is nearer to it than the row is, by the factor `alpha` in distance.
    """
    kept = []
    for i, row in enumerate(candidates):
        row = row[(row >= 0) & (row != i)]
        gap = 2 - 2 * (x[row] @ x[i])
        between = 2 - 2 * (x[row] @ x[row].T)
        open_, taken = np.ones(len(row), bool), []
        for c in range(len(row)):
            if open_[c]:
                taken.append(row[c])
                if len(taken) == degree:
                    break
                open_ &= alpha * alpha * between[c] > gap
        kept.append(np.array(taken, np.int64))
    return kept


def spanning_tree(x: np.ndarray, branches: int = BRANCHES) -> np.ndarray:
    """The parent of each vector but the first, which has -1, in a tree of nearest pairs (Prim's).

    Vectors that pairs of some cosine or more join are joined by the tree's pairs of that cosine too. Where many have the
    same nearest one, those behind the first `branches` hang on their siblings, so that no list grows with the shard.
    """
    parent, nearest = np.full(len(x), -1, np.int64), np.zeros(len(x), np.int64)
    best, children = np.full(len(x), -np.inf), [[] for _ in range(len(x))]
    open_, at = np.ones(len(x), bool), 0
    for _ in range(len(x) - 1):
        open_[at] = False
        cosine = x @ x[at]
        closer = open_ & (cosine > best)
        best[closer], nearest[closer] = cosine[closer], at
        at = int(np.where(open_, best, -np.inf).argmax())
        siblings = children[nearest[at]]
        n = len(siblings)
        parent[at] = nearest[at] if n < branches else siblings[n // branches - 1]
        siblings.append(at)
    return parent


def _build(table: pa.Table) -> pa.Table:
    """Neighbours of the members of one shard."""
    nodes, x = table.column("node").to_numpy(), _matrix(table.column("vector"))
    n, width = len(nodes), min(CANDIDATES, len(nodes))
    near = np.empty((n, width), np.int64)
    for a in range(0, n, 512):
        cosine = x[a : a + 512] @ x.T
        part = np.argpartition(-cosine, width - 1, axis=1)[:, :width]
        order = np.argsort(-np.take_along_axis(cosine, part, 1), axis=1, kind="stable")
        near[a : a + 512] = np.take_along_axis(part, order, 1)
    lists = robust_prune(x, near)
    back: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(lists):
        for c in row.tolist():
            back[c].append(i)
    both = [np.unique(np.concatenate((a, np.array(b, np.int64)))) for a, b in zip(lists, back)]
    merged = np.full((n, max(map(len, both))), -1, np.int64)
    for i, row in enumerate(both):
        merged[i, : len(row)] = row[np.argsort(-(x[row] @ x[i]), kind="stable")]
    # With the links back, a vector in the middle of many may have too many again.
    full = [robust_prune_one(x, i, row) for i, row in enumerate(merged)]
    tree: list[list[int]] = [[] for _ in range(n)]
    for i, p in enumerate(spanning_tree(x).tolist()):
        if p >= 0:
            tree[i].append(p)
            tree[p].append(i)
    full = [np.union1d(row, np.array(t, np.int64)) for row, t in zip(full, tree)]
    return pa.table({"node": nodes, "neighbours": pa.array([nodes[row].tolist() for row in full], pa.list_(pa.int64()))})


def robust_prune_one(x: np.ndarray, i: int, row: np.ndarray) -> np.ndarray:
    row = row[row >= 0]
    if len(row) <= 2 * DEGREE:
        return row
    padded = np.full((i + 1, len(row)), -1, np.int64)
    padded[i] = row
    return robust_prune(x, padded, 2 * DEGREE)[i]


def _greedy(x: np.ndarray, graph: np.ndarray, query: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of `query`, position) of what greedy searches for the vectors at positions `query` find near the limit.

    Each keeps a beam of the best, which starts at the medoid and at the query's own place.
    """
    n = len(query)
    medoid = int((x @ x.mean(axis=0)).argmax())
    beam = np.full((n, BEAM), -1, np.int64)
    score = np.full((n, BEAM), -np.inf)
    done = np.zeros((n, BEAM), bool)
    beam[:, 0], score[:, 0] = medoid, x[query] @ x[medoid]
    beam[:, 1], score[:, 1] = np.where(query == medoid, -1, query), np.where(query == medoid, -np.inf, 1.0)
    for _ in range(4 * BEAM):
        waiting = np.where(done | (beam < 0), -np.inf, score)
        pick = waiting.argmax(axis=1)
        active = np.flatnonzero(waiting[np.arange(n), pick] > -np.inf)
        if not len(active):
            break
        done[active, pick[active]] = True
        new = graph[beam[active, pick[active]]]
        value = np.where(new >= 0, np.einsum("nrd,nd->nr", x[new], x[query[active]]), -np.inf)
        value[(new[:, :, None] == beam[active][:, None, :]).any(axis=2)] = -np.inf
        new = np.where(value > -np.inf, new, -1)
        ids, scores = np.concatenate((beam[active], new), 1), np.concatenate((score[active], value), 1)
        flags = np.concatenate((done[active], np.zeros(new.shape, bool)), 1)
        best = np.argsort(-scores, axis=1, kind="stable")[:, :BEAM]
        beam[active], score[active] = np.take_along_axis(ids, best, 1), np.take_along_axis(scores, best, 1)
        done[active] = np.take_along_axis(flags, best, 1)
    within = (beam >= 0) & (score >= limit - MARGIN)
    return np.arange(n).repeat(within.sum(axis=1)), beam[within]


def _expanded(x: np.ndarray, graph: np.ndarray, asked: np.ndarray, rows: np.ndarray, at: np.ndarray, limit: float) -> np.ndarray:
    """Cosines of the vectors `asked` (rows) with those of `x` (columns) that a range search meets, -inf for the others.

    It starts from the given pairs and goes on over the neighbours of what is near the limit.
    """
    n = len(x)
    value = np.full(len(asked) * n, -np.inf)
    frontier = np.unique(rows * n + at)
    value[frontier] = np.einsum("nd,nd->n", asked[frontier // n], x[frontier % n])
    frontier = frontier[value[frontier] >= limit - MARGIN]
    while len(frontier):
        found = []
        for part in np.array_split(frontier, max(1, len(frontier) // 50_000)):
            to = graph[part % n]
            keys = ((part // n * n)[:, None] + to)[to >= 0]
            keys = keys[value[keys] == -np.inf]
            new = np.zeros(len(value), bool)
            new[keys] = True
            keys = np.flatnonzero(new)
            value[keys] = np.einsum("nd,nd->n", asked[keys // n], x[keys % n])
            found.append(keys[value[keys] >= limit - MARGIN])
        frontier = np.concatenate(found)
    return value.reshape(len(asked), n)


def _padded(lists: list[np.ndarray]) -> np.ndarray:
    graph = np.full((len(lists), max(1, max(map(len, lists)))), -1, np.int64)
    for i, row in enumerate(lists):
        graph[i, : len(row)] = row
    return graph


def range_search(x: np.ndarray, lists: list[np.ndarray], limit: float) -> np.ndarray:
    """Pairs (query, found) with a cosine of `limit` or more that the graph over the unit vectors `x` leads to."""
    graph, pairs = _padded(lists), []
    for a in range(0, len(x), BLOCK):
        query = np.arange(a, min(a + BLOCK, len(x)))
        value = _expanded(x, graph, x[query], *_greedy(x, graph, query, limit), limit)
        value[query - a, query] = -np.inf
        rows, at = np.nonzero(value >= limit)
        pairs.append(np.stack((rows + a, at), 1))
    return np.concatenate(pairs)


def _search(limit: float):
    """One round in one shard: the range search of its visitors among its members.

    Gives for each visitor the copies of linked vectors that are at home here, for visitors and linked members the least
    id of the links' component in this task, and for each visitor the other shards of what it found near the limit, with
    the nearest such vector to start from there.
    """

    def run(members: pa.Table, visits: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in _FOUND.split(", ")]
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in names]
        if len(members) and len(visits):
            nodes, x = members.column("node").to_numpy(), _matrix(members.column("vector"))
            place = {v: i for i, v in enumerate(nodes.tolist())}
            graph = _padded(
                [np.array([place[v] for v in row if v in place], np.int64) for row in members.column("neighbours").to_pylist()]
            )
            here = np.where(members.column("home").to_numpy(zero_copy_only=False), members.column("copies").to_numpy(), 0)
            other = members.column("other").to_numpy()
            beyond = [(o, np.flatnonzero(other == o)) for o in np.unique(other[other >= 0]).tolist()]
            ids, asked = visits.column("node").to_numpy(), _matrix(visits.column("vector"))
            start = np.array([place[v] for v in visits.column("seed").to_pylist()], np.int64)
            root, tied = nodes.copy(), np.full(len(ids), -1, np.int64)
            linked_member = np.zeros(len(nodes), bool)
            for a in range(0, len(ids), BLOCK):
                block, own = ids[a : a + BLOCK], start[a : a + BLOCK]
                member = nodes[own] == block
                rows, at = np.flatnonzero(~member), own[~member]
                if member.any():
                    more, to = _greedy(x, graph, own[member], limit)
                    rows, at = np.concatenate((rows, np.flatnonzero(member)[more])), np.concatenate((at, to))
                value = _expanded(x, graph, asked[a : a + BLOCK], rows, at, limit)
                value[np.flatnonzero(member), own[member]] = 1.0
                linked = value >= limit
                count = linked @ here - np.where(member, here[own], 0)
                for i in np.flatnonzero(linked.any(axis=1)).tolist():
                    to = np.flatnonzero(linked[i])
                    groups = np.unique(root[to])
                    least = min(int(groups[0]), int(block[i]))
                    if len(groups) > 1 or least < groups[0]:
                        root[np.isin(root, groups)] = least
                    tied[a + i] = to[0]
                    linked_member[to] = True
                _add(out, node=block, found=count, part=np.zeros(len(block), np.int64))
                for o, columns in beyond:
                    near = value[:, columns]
                    best = near.argmax(axis=1)
                    rows = np.flatnonzero(near.max(axis=1) >= limit - MARGIN)
                    _add(out, node=block[rows], part=np.full(len(rows), 2), shard=np.full(len(rows), o),
                         seed=nodes[columns[best[rows]]], cosine=near[rows, best[rows]])
            tie = np.flatnonzero(tied >= 0)
            _add(out, node=ids[tie], part=np.ones(len(tie), np.int64), root=root[tied[tie]])
            _add(out, node=nodes[linked_member], part=np.ones(int(linked_member.sum()), np.int64), root=root[linked_member])
        kinds = [pa.float64() if n == "cosine" else pa.int64() for n in names]
        return pa.table({n: pa.array(np.concatenate(c), k) for n, c, k in zip(names, out, kinds)})

    return run


def _add(out: list[list[np.ndarray]], **columns: np.ndarray) -> None:
    """Rows of the given columns; the others are zero."""
    for name, column in zip((c.split()[0] for c in _FOUND.split(", ")), out):
        column.append(columns.get(name, np.zeros(len(columns["node"]), np.int64)))


def nodes_of(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the key of their node, nodes with the number of their copies) of a table of vectors."""
    x = quoted(vector_col).cast("array<double>")
    rows = vectors.select(quoted(id_col).cast("long").alias("vec_id"), quoted(label_col).cast("string").alias("label"), x.alias("vector"))
    inf = F.lit(float("inf"))
    finite = F.forall("vector", lambda v: F.coalesce((F.abs(v) < inf) & ~F.isnan(v), F.lit(False)))
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vector", lambda v: v != 0), F.lit(False)
    )
    rows = rows.withColumn("key", F.when(usable, F.xxhash64("label", "vector")))
    nodes = rows.filter("key is not null").groupBy("key", "label", "vector").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")
    )
    return rows.select("vec_id", "key"), nodes


def near_duplicates(
    vectors: DataFrame,
    limit: float = COSINE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    shard: int = SHARD,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept.

    Vectors link when their labels are equal and their cosine is at least `limit`. One whose label, id or vector is
    null, or that is zero or holds a null or non-finite component, links with nothing and is its own component, null
    for a null id. Only vectors of the same length are compared. Ids are expected to be unique; a row that repeats an id
    and its vector counts as a copy. Acts at once; centroids reach the driver, one for each `shard` vectors.
    """
    rounds = Rounds(vectors.sparkSession)
    rows, nodes = nodes_of(vectors, id_col, vector_col, label_col)
    nodes = rounds.store(nodes, "nodes")
    space = F.concat_ws(":", F.size("vector").cast("string"), "label")
    sizes = {r["space"]: r["n"] for r in nodes.groupBy(space.alias("space")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = min(1.0, SAMPLE / max(1, sum(sizes.values())))
    sample: dict[str, list] = {}
    for r in nodes.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select(space.alias("space"), "vector").toLocalIterator():
        sample.setdefault(r["space"], []).append(r["vector"])
    centres, first = {}, 0
    for name in sorted(sizes):
        found = np.zeros((0, 0))
        if name in sample:
            found = _centroids(_matrix(pa.array(sample[name], pa.list_(pa.float64()))), -(-sizes[name] // shard))
        centres[name] = first, found
        first += max(1, len(found))
    shared = vectors.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for name in sorted(set(names)):
                own = pa.array(np.flatnonzero(names == name))
                node, copies, vector = (batch.column(i).take(own) for i in (1, 2, 3))
                start, found = shared.value[name]
                nearest = np.zeros((len(node), 1), np.int64)
                if len(found) > 1:
                    width = min(OVERLAP, len(found))
                    nearest = np.argsort(-(_matrix(vector) @ found.T), axis=1, kind="stable")[:, :width]
                for at, column in enumerate(nearest.T):
                    other = start + nearest[:, 1 - at] if nearest.shape[1] > 1 else np.full(len(node), -1)
                    home = pa.array(np.full(len(node), at == 0))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(start + column), pa.array(other), home, node, copies, vector],
                        [c.split()[0] for c in _MEMBERS.split(", ")],
                    )

    members = rounds.store(nodes.select(space, "node", "copies", "vector").mapInArrow(assign, _MEMBERS), "members")
    lists = members.groupBy("shard").applyInArrow(_build, _LISTS)
    united = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))
    indexed = rounds.store(members.join(united, "node"), "graph")
    visits = visited = rounds.store(indexed.select("shard", "node", F.col("node").alias("seed")), "visits-0")
    found = None
    for n in itertools.count():
        parts = visits.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / VISITS).alias("parts"))
        parts = rounds.store(parts, f"parts-{n}")
        asked = visits.join(parts, "shard").withColumn("at", F.pmod(F.xxhash64("node"), "parts")).drop("parts")
        asked = asked.join(nodes.select("node", "vector"), "node").groupBy("shard", "at")
        among = indexed.join(parts, "shard").withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        met = among.groupBy("shard", "at").cogroup(asked).applyInArrow(_search(limit), _FOUND)
        met = rounds.store(met, f"found-{n}")
        found = met if found is None else found.union(met)
        onward = met.filter("part = 2").groupBy("shard", "node").agg(F.max_by("seed", F.struct("cosine", "seed")).alias("seed"))
        visits = rounds.store(onward.join(visited.select("shard", "node"), ["shard", "node"], "left_anti"), f"visits-{n + 1}")
        visited = visited.union(visits)
        if visits.isEmpty():
            break
    linked = found.filter("part = 0").groupBy("node").agg(F.sum("found").alias("linked"))
    links = found.filter("part = 1 and node != root").select(F.col("node").alias("u"), F.col("root").alias("v"))
    by_key = (
        nodes.select("key", "node", "copies")
        .join(linked, "node", "left")
        .join(components(links, rounds, "components"), "node", "left")
        .select("key", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    )
    by_key = rounds.store(by_key, "by-key")
    del members, lists, united, indexed, visits, visited, found, met, onward, asked, among, parts, links, linked
    steps = [f"{label}-{i}" for label in ("parts", "found", "visits") for i in range(n + 1)]
    rounds.drop("members", "graph", "components", *steps, f"visits-{n + 1}", "nodes")
    component = F.coalesce("component_id", "vec_id")
    return rows.join(by_key, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def audit(vectors: DataFrame, found: DataFrame, queries: int = 200, limit: float = COSINE) -> float:
    """Share of the links of about so many vectors that `found` has, by comparing them with all rows."""
    rows, nodes = nodes_of(vectors, "vec_id", "embedding", "label")
    chosen = nodes.orderBy(F.xxhash64("key")).limit(queries).select("label", "node", "vector").collect()
    by_label: dict[str, list] = {}
    for r in chosen:
        by_label.setdefault(r["label"], []).append(r)
    asked = {k: ([r["node"] for r in v], _matrix(pa.array([r["vector"] for r in v], pa.list_(pa.float64())))) for k, v in by_label.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_u, out_n = [], []
            x, copies = _matrix(batch.column(1)) if len(batch) else None, batch.column(2).to_numpy()
            names = np.array(batch.column(0).to_pylist(), object)
            for label, (ids, q) in asked.items():
                own = names == label
                if own.any():
                    hits = (q @ x[own].T >= limit) @ copies[own]
                    out_u += ids
                    out_n += hits.astype(int).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(out_u, pa.int64()), pa.array(out_n, pa.int64())], ["vec_id", "n"])

    true = nodes.select("label", "vector", "copies").mapInArrow(run, "vec_id long, n long")
    true = true.groupBy("vec_id").agg((F.sum("n") - 1).alias("n"))
    total = true.join(found, "vec_id").agg(F.sum("n").alias("all"), F.sum(F.least("n", "n_links")).alias("found")).first()
    return (total["found"] / total["all"]) if total["all"] else 1.0
