"""Compression of vectors to one code a part, with codebooks learned on all rows.

Vectors are cut into equal parts; each part position has a codebook of a few entries, which Lloyd rounds improve. In a
round every task assigns the parts of its rows and adds them up by position and entry, so that a row for each of these,
summed over the tasks, is all that is shuffled; the new codebooks, of fixed size, go back to the tasks. All numbers are
integers, so results are the same however rows are dealt.

The nearest entry is found by equal-average search: entries are sorted by the sum of their components, and the search goes
outward from the part's own sum. The squared gap of two sums over the dimension is never above the squared distance, so a
direction ends where it strictly exceeds the best distance so far.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatehold.llm.columns import quoted
from gatehold.llm.storage import Rounds
from gatehold.operators.joins import lookup_join

PARTS = 8
ENTRIES = 16  # of a codebook; two hex digits hold up to 256
ROUNDS = 6
SCALE = 4096
LARGEST = 1 << 30  # of a scaled component times the dimension: squares of sums and of distances then fit into 64 bits
BLOCK = 4096  # vectors that a task assigns together

_CUT = "vec_id long, label string, parts array<long>"
_SUMS = "part int, entry int, n long, position int, total long"
_CODED = "vec_id long, label string, code string, error long"


@dataclass
class Codebook:
    """The entries of one part position, and their order by sum."""

    entries: np.ndarray

    def __post_init__(self):
        sums = self.entries.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.sums = sums[self.order]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each part by equal-average search; of equally near entries the lowest."""
        n, width = parts.shape
        last = len(self.sums)
        own = parts.sum(axis=1)
        up = np.searchsorted(self.sums, own)  # next entry to try above, and below
        down = up - 1
        best, chosen = np.full(n, np.iinfo(np.int64).max), np.full(n, last)
        rows, far = np.arange(n), np.iinfo(np.int64).max
        for step in range(last):
            # Behind the last entry of a side the gap is out of reach, so the other side is taken.
            above = np.where(up[rows] < last, self.sums[np.minimum(up[rows], last - 1)] - own[rows], far)
            below = np.where(down[rows] >= 0, own[rows] - self.sums[np.maximum(down[rows], 0)], far)
            gap = np.minimum(above, below)
            if step:
                going = gap**2 <= best[rows] * width
                rows, above, below = rows[going], above[going], below[going]
            upward = above <= below
            entry = self.order[np.where(upward, up[rows], down[rows])]
            up[rows[upward]] += 1
            down[rows[~upward]] -= 1
            distance = ((parts[rows] - self.entries[entry]) ** 2).sum(axis=1)
            better = (distance < best[rows]) | ((distance == best[rows]) & (entry < chosen[rows]))
            best[rows[better]], chosen[rows[better]] = distance[better], entry[better]
        return chosen, best


def _cut(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int, scale: int) -> DataFrame:
    """Rows whose vector is kept, its components as integers and its label as text."""
    vector = quoted(vector_col).cast("array<double>")
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # From here on floor gives exact integers; what is too large for the sums of squares stops the job.
    small = F.forall(vector, lambda x: F.abs(x * scale) * F.size(vector) <= LARGEST)
    exact = F.when(small, F.transform(vector, lambda x: F.floor(x * scale).cast("long"))).otherwise(
        F.raise_error(F.lit("a component is too large for exact sums of squares"))
    )
    label = quoted(label_col)
    return vectors.filter(vector.isNotNull() & whole & (F.size(vector) > 0) & (F.size(vector) % parts == 0)).select(
        quoted(id_col).cast("long").alias("vec_id"), label.cast("string").alias("label"), exact.alias("parts")
    )


def _blocks(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows and their integers as (row, part, position)."""
    for batch in batches:
        for start in range(0, len(batch), BLOCK):
            rows = batch.slice(start, BLOCK)
            values = rows.column("parts").flatten().to_numpy(zero_copy_only=False)
            yield rows, values.reshape(len(rows), parts, -1)


def _assigned(values: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) as (row, part)."""
    found = [book.nearest(values[:, i, :]) for i, book in enumerate(books)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _improved(cut: DataFrame, books: list[Codebook]) -> list[Codebook]:
    """Each entry replaced by the mean, rounded down, of the parts that are nearest to it; unused ones stay."""
    parts, (entries, width) = len(books), books[0].entries.shape
    sent = cut.sparkSession.sparkContext.broadcast(books)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), np.int64)
        for _, values in _blocks(batches, parts):
            chosen, _ = _assigned(values, sent.value)
            for i in range(parts):
                n[i] += np.bincount(chosen[:, i], minlength=entries)
                np.add.at(total[i], chosen[:, i], values[:, i, :])
        part, entry, position = (x.ravel() for x in np.indices(total.shape))
        used = n[part, entry] > 0
        columns = [part.astype(np.int32), entry.astype(np.int32), n[part, entry], position.astype(np.int32), total.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c[used]) for c in columns], [c.split()[0] for c in _SUMS.split(", ")])

    sums = cut.mapInArrow(summed, _SUMS).groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    new = [book.entries.copy() for book in books]
    for r in sums.collect():  # one row for each component of the codebooks
        new[r["part"]][r["entry"], r["position"]] = r["total"] // r["n"]
    sent.unpersist()
    return [Codebook(e) for e in new]


def digest(books: list[Codebook]) -> str:
    """sha256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.entries.ravel().tolist()).encode()).hexdigest()


def compressed(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, list[Codebook]]:
    """(vec_id, label, code, error, label_error) of every kept row, and the codebooks. Acts at once; the result is stored.

    Rows are dropped whose vector is null, holds a null or non-finite component, or cannot be cut into `parts` equal parts
    of at least one component; also those of another length than the vector with the smallest id. A null id is kept and
    ranks behind all others, a null label is a label of its own. Repeated rows are compressed one by one; of rows with one
    id the least vectors start the codebooks. With fewer rows than `entries` the codebooks are as small; without rows they
    are empty, as is the result. A component too large for exact sums of squares (LARGEST) is an error.
    Other columns of `vectors` are not read.
    """
    spark = vectors.sparkSession
    tables = Rounds(spark)
    cut = tables.store(_cut(vectors, id_col, vector_col, label_col, parts, scale), "vectors")
    # As many rows as a codebook has entries.
    first = cut.orderBy(F.col("vec_id").asc_nulls_last(), "parts").limit(entries).select("vec_id", "parts").collect()
    if not first:
        return spark.createDataFrame([], _CODED + ", label_error long"), []
    size = len(first[0]["parts"])
    if cut.filter(F.size("parts") != size).limit(1).collect():
        cut = cut.filter(F.size("parts") == size)
        first = cut.orderBy(F.col("vec_id").asc_nulls_last(), "parts").limit(entries).select("parts").collect()
    start = np.array([r["parts"] for r in first], np.int64).reshape(len(first), parts, -1)
    books = [Codebook(start[:, i, :].copy()) for i in range(parts)]
    for _ in range(rounds):
        books = _improved(cut, books)
    sent = spark.sparkContext.broadcast(books)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, values in _blocks(batches, parts):
            chosen, distance = _assigned(values, sent.value)
            codes = [bytes(c).hex() for c in chosen.astype(np.uint8)]
            columns = [rows.column("vec_id"), rows.column("label"), pa.array(codes, pa.string()), pa.array(distance.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _CODED.split(", ")])

    coded = tables.store(cut.mapInArrow(code, _CODED), "coded")
    tables.drop("vectors")
    labelled = coded.withColumns({"known": F.col("label").isNotNull(), "name": F.coalesce("label", F.lit(""))})
    sums = tables.store(labelled.groupBy("known", "name").agg(F.sum("error").alias("label_error")), "label-errors")
    joined = lookup_join(labelled, sums, ["known", "name"])
    return joined.select("vec_id", "label", "code", "error", "label_error"), books
