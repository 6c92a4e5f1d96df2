"""Packing tokenised documents into as few sequences as possible, by bin completion.

What reaches the driver is the number of pieces of each length, at most `capacity` numbers whatever the size of the
corpus. A branch-and-bound search over that histogram yields filling patterns with their number of uses; the pieces
then find their place by their rank among the pieces of the same length, which is made of ranks inside the input tasks
and the tasks' counts. No task ever holds all pieces of a length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatehold.llm.bpe import encoder
from gatehold.llm.columns import documents
from gatehold.session import staged

CAPACITY = 2048
END_ID = 0
# Effort of the search; none of these grows with the corpus.
FILLINGS = 24  # alternatives kept for a branch
WIDTH = 12  # pieces tried at each place of a filling
STEPS = 1_000  # places tried for a branch
MIXES = 4  # mixed orders of the pieces
NODES = 400  # cut branches after which the best packing found is taken

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"
_OUT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of each document: its ids plus `end_id`, cut into pieces of `capacity` if there are more.

    Columns doc_id, piece, start, length, ids_crc32 (over little-endian unsigned 32-bit ids), task, rank (among the
    pieces of that length in that task) and, `with_ids`, the ids themselves. The first piece of a cut document is the
    short one. A null or empty text is the end id alone; a null id stays null; repeated rows each give their pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        codec = encoder(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(codec.ids(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or min(len(ids), capacity)
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    row = (doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()), task, int(seen[b - a]))
                    rows.append((*row, ids[a:b].astype(np.int64)) if with_ids else row)
                    seen[b - a] += 1
            columns = list(zip(*rows)) or [()] * (8 if with_ids else 7)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            kinds += [pa.list_(pa.int64())] if with_ids else []
            names = [c.split()[0] for c in _PIECES.split(", ")] + (["ids"] if with_ids else [])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return documents(docs, id_col, text_col).mapInArrow(run, _PIECES + (", ids array<long>" if with_ids else ""))


@dataclass
class Pattern:
    lengths: tuple[int, ...]
    uses: int


def _fillings(largest: int, counts: np.ndarray, room: int, order: np.ndarray) -> list[tuple[int, ...]]:
    """Undominated ways to fill `room` beside the largest piece, least waste first.

    Pieces are tried in the order given. A filling is left out when a piece that is still there fits into its waste, or
    can take the place of a smaller one in it: exchanging the two can only help the rest. The search ends at the first
    filling without waste, or after a bounded number of steps with the best so far.
    """
    sizes = order[(order <= room) & (counts[order] > 0)]
    left = counts.copy()
    found: list[tuple[int, tuple[int, ...]]] = []
    steps = STEPS

    def undominated(items: tuple[int, ...], waste: int) -> bool:
        return not waste or not any(left[x + 1 : x + waste + 1].any() for x in {0, *items})

    def search(at: int, space: int, items: tuple[int, ...]) -> bool:
        nonlocal steps
        steps -= 1
        if space and left[space] > 0:
            found.append((0, (*items, space)))
            return True
        fitting = np.flatnonzero(sizes[at:] <= space)[:WIDTH] + at
        deeper = False
        for i in fitting:
            size = int(sizes[i])
            if left[size] > 0:
                deeper = True
                # Pieces that are small for the room are taken together, so that a filling of many is a short search.
                taken = 1 if space < 8 * size else min(int(left[size]), space // size)
                left[size] -= taken
                exact = search(int(i), space - taken * size, (*items, *[size] * taken))
                left[size] += taken
                if exact or steps < 0:
                    return exact
        if not deeper and undominated(items, space):
            found.append((space, items))
        return False

    search(0, room, ())
    found.sort(key=lambda f: f[0])
    return [items for _, items in found[:FILLINGS]] or [()]


def fewest(counts: np.ndarray, capacity: int) -> int:
    """A number of sequences that no packing can go below: pieces of over half the capacity need one each, and what
    pieces of `small` or more do not find beside them needs more; the best over all values of `small`."""
    sizes = np.arange(capacity + 1)
    number, volume = np.cumsum(counts), np.cumsum(counts * sizes)
    small = np.arange(1, capacity // 2 + 1)
    large = number[-1] - number[capacity // 2]
    mid_volume = volume[capacity - small] - volume[capacity // 2]
    mid_number = number[capacity - small] - number[capacity // 2]
    rest = volume[capacity // 2] - volume[small - 1] - (mid_number * capacity - mid_volume)
    return int(max(-(-volume[-1] // capacity), (large + np.maximum(0, -(-rest // capacity))).max()))


def _search(counts: np.ndarray, capacity: int, least: int, most: int, nodes: int, order: np.ndarray) -> list[Pattern]:
    """The best packing into fewer than `most` sequences that is found, or an empty list."""
    total = int((np.arange(len(counts)) * counts).sum())
    left, path, wasted, used, tried = counts.copy(), [], 0, 0, 0
    best: list[Pattern] = []

    def branches() -> Iterator[tuple[int, ...]]:
        largest = int(np.flatnonzero(left)[-1])
        left[largest] -= 1
        options = _fillings(largest, left, capacity - largest, order)
        left[largest] += 1
        return iter([(largest, *items) for items in options])

    stack = [branches()]
    while stack and most > least and tried <= nodes:
        items = next(stack[-1], None)
        waste = capacity - sum(items) if items else 0
        # All later sequences are full at best, so a packing with fewer than `most` cannot waste more than this.
        if items is None or wasted + waste > (most - 1) * capacity - total:
            tried += items is not None
            stack.pop()
            if path:
                undone = path.pop()
                for x in undone.lengths:
                    left[x] += undone.uses
                used -= undone.uses
                wasted -= undone.uses * (capacity - sum(undone.lengths))
            continue
        need = np.bincount(items, minlength=len(left))
        uses = int((left[need > 0] // need[need > 0]).min())
        if waste:
            uses = max(1, min(uses, ((most - 1) * capacity - total - wasted) // waste))
        left -= uses * need
        path.append(Pattern(items, uses))
        used, wasted = used + uses, wasted + uses * waste
        if left.any():
            stack.append(branches())
            continue
        if used < most:
            best, most = list(path), used
        stack.append(iter(()))
    return best


def bin_completion(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES) -> list[Pattern]:
    """Filling patterns that hold `counts[length]` pieces of each length in as few sequences as were found.

    Each branch fills the sequence around the largest piece left in one of the undominated ways, as often as the
    pieces allow. A descent that always takes the least waste is a best-fit packing; descents that try the other
    pieces from large to small, and in some fixed mixed orders, give the first incumbent. Then branches are cut as soon
    as their waste excludes a packing with fewer sequences. The search ends when the incumbent meets the bound of
    `fewest`, or after `nodes` cut branches: the effort depends on the number of lengths, not on that of the pieces.
    """
    counts = np.asarray(counts, np.int64).copy()
    counts[0] = 0
    if not counts.any():
        return []
    least = fewest(counts, capacity)
    falling = np.arange(capacity, 0, -1)
    orders = [falling, *(np.random.default_rng(i).permutation(falling) for i in range(MIXES))]
    best: list[Pattern] = []
    most = int(counts.sum()) + 1
    for limit in (0, nodes // len(orders)):
        for order in orders:
            if most > least:
                found = _search(counts, capacity, least, most, limit, order)
                if found:
                    best, most = found, sum(p.uses for p in found)
    return best


def _slots(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length (first ranks, first sequences, offsets) of the runs of pieces that patterns take."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for p in patterns:
        offset = 0
        for length in p.lengths:
            rank = taken.get(length, 0)
            slots.setdefault(length, []).append((rank, sequence, offset))
            taken[length] = rank + p.uses
            offset += length
        sequence += p.uses
    return {k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in slots.items()}


def pack(cut: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """The rows of `pieces` with sequence_id and offset. Acts at once: `cut` is read twice, so it should be stored.

    Equal lengths are interchangeable; which of them goes where follows from their ranks. No row, or one piece, is a
    plan like any other.
    """
    per_task = cut.groupBy("length", "task").agg(F.max("rank").alias("n")).withColumn("n", F.col("n") + 1)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[row["length"]] = row["n"]
    full = Pattern((capacity,), int(counts[capacity]))
    counts[capacity] = 0
    slots = _slots(bin_completion(counts, capacity, nodes) + ([full] if full.uses else []))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length):
                own = np.flatnonzero(length == x)
                ranks, sequences, offsets = slots[int(x)]
                run = np.searchsorted(ranks, rank[own], side="right") - 1
                sequence[own] = sequences[run] + rank[own] - ranks[run]
                offset[own] = offsets[run]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            names = [c.split()[0] for c in _OUT.split(", ")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names)

    ranked = cut.join(first, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("first")).alias("rank")
    )
    return ranked.mapInArrow(place, _OUT)


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, **columns: str) -> DataFrame:
    """Documents to packed pieces; the pieces, without their ids, are stored in between."""
    return pack(staged(pieces(docs, tokenizer, capacity, **columns), "pieces"), capacity)
