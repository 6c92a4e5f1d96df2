"""Exact Jaccard join of documents on word shingles, and its connected components.

Documents with equal shingle sets form a class. Classes whose sets may be similar enough are brought together by
segments: sets of x and y shingles with Jaccard j differ in at most (x + y)(1 - j)/(1 + j) shingles, so of somewhat more
segments of the shingle space a few hold the same shingles in both. Classes that share a segment, directly or through
others, are a family; no link leaves its family.

* A small family is searched in one task: T-occurrence search over inverted lists with DivideSkip. The short lists are
  merged with a heap that skips ahead, ids found often enough are looked up in the long lists by binary search.
* A large family is never gathered. Its members are described by their differences from the shingles that most of them
  have. If the differences of two members are few enough together, they are linked whatever the differences are, so
  linking all such members to the one with the fewest leaves their component as it is. Any other linked pair shares a
  shingle among the few rarest of both: short inverted lists, joined as tables, in which long lists only appear where
  the sizes still allow the overlap. Candidates are then checked on the whole sets.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Callable, Iterator
from fractions import Fraction
from math import log, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatehold.llm.columns import documents
from gatehold.llm.graph import components
from gatehold.llm.rolling import blocks, mix, row_of, shingles, word_hashes
from gatehold.llm.storage import Rounds

WIDTH = 3
SIMILARITY = Fraction(9, 10)
SMALL_MEMBERS = 250  # a family with more members, or more shingles, is not searched in one task
SMALL_SHINGLES = 1 << 21
_STEP = 1.5  # growth of the sizes that share a number of segments
_SPARE = 3  # segments that are equal at least
_SAMPLE = 64  # expected number of members from which the usual shingles of a large family are taken

_PARTNERS = 256  # members of a large family for each copy of its usual shingles
_BUCKET = log(1.03)  # sizes in one bucket of an inverted list differ by 3 %

_SETS = "doc_id long, n_shingles long, class long, segments array<long>"
_WORDS = 16  # of 64 bits in a sketch of a set

_MEMBERS = "family long, members long, class long, size long, shingles array<long>, sketch array<long>"
_DESCRIBED = "family long, class long, size long, differences long, rarest array<long>"


def sets_of(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct shingles, ascending in each row; their rows; first of each row and their number)."""
    values, rows = shingles(*word_hashes(data, offsets), width)
    row = row_of(rows)
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[new], row[new]
    return values, row, np.searchsorted(row, np.arange(len(offsets)))


def classes_of(values: np.ndarray, row: np.ndarray, size: np.ndarray) -> np.ndarray:
    total = np.zeros(len(size), np.uint64)
    np.add.at(total, row, mix(values))
    return mix(total + size.astype(np.uint64)).view(np.int64)


def _schemes(largest: int, j: Fraction) -> np.ndarray:
    """Ascending upper sizes of the schemes; sizes below the first can only be linked when equal."""
    d = (1 - j) / (1 + j)
    first = 1
    while (first + 1 + first) * d < 1:
        first += 1
    tops = [first]
    while tops[-1] < largest:
        tops.append(int(tops[-1] * _STEP) + 1)
    return np.array(tops, np.int64)


def _emit_segments(values: np.ndarray, rows: np.ndarray, chosen: np.ndarray, j: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """(segment, row) of the chosen rows in each scheme they belong to.

    The scheme of a pair is that of its larger set, so a set also takes part in the next one if it is large enough to
    be the smaller set there. Segments without shingles say nothing and are left out; a set that lacks as many as are
    equal at least has one more, to meet others like it.
    """
    size = np.diff(rows)
    tops = _schemes(int(size[chosen].max(initial=1)) * 2, j)
    own = np.searchsorted(tops, size)
    out_segment, out_row = [], []
    for scheme in (own, own + 1):
        part = chosen & (size > 0) & (scheme > 0)
        if scheme is not own:
            part &= size >= np.ceil(float(j) * (tops[np.minimum(own, len(tops) - 1)] + 1) - 1e-9)
        picked = np.flatnonzero(part)
        if not len(picked):
            continue
        top = tops[scheme[picked]]
        d = (1 - j) / (1 + j)
        number = 2 * top * d.numerator // d.denominator + _SPARE
        base = np.concatenate(([0], np.cumsum(number)))
        item = np.repeat(np.arange(len(picked)), size[picked])
        at = np.repeat(rows[picked] - np.concatenate(([0], np.cumsum(size[picked])))[:-1], size[picked]) + np.arange(len(item))
        value = values[at]
        place = ((mix(value ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)) * number[item].astype(np.uint64)) >> np.uint64(32)
        slot = base[item] + place.astype(np.int64)
        total, count = np.zeros(base[-1], np.uint64), np.bincount(slot, minlength=base[-1])
        np.add.at(total, slot, mix(value))
        slot_item = np.repeat(np.arange(len(picked)), number)
        tag = (np.arange(base[-1]) - base[slot_item]).astype(np.uint64) * np.uint64(1 << 32) + top[slot_item].astype(np.uint64)
        segment = mix(mix(total) + mix(tag))
        full = count > 0
        out_segment.append(segment[full])
        out_row.append(picked[slot_item[full]])
        lacking = np.bincount(slot_item[~full], minlength=len(picked)) >= _SPARE
        out_segment.append(mix(top[lacking].astype(np.uint64) + np.uint64(1 << 63)))
        out_row.append(picked[lacking])
    if not out_segment:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_segment).view(np.int64), np.concatenate(out_row)


def divide_skip(
    lists: list[tuple[int, int]], ids: list[int], stop: int, least: int, known: Callable[[int], bool] = lambda i: False
) -> Iterator[tuple[int, int]]:
    """(id, number of lists with it) of the ids below `stop` in at least `least` of the inverted lists.

    A list is ids[first:end], ascending. The longest lists, fewer than `least`, are set aside; an id must be in enough
    of the others, which a heap merges. When the ids at the top are too few, the heap skips to the next id that can
    still be in enough lists. Found ids are looked up in the long lists by binary search, unless they are `known`.
    """
    lists = sorted(lists, key=lambda x: x[1] - x[0])
    longest = lists[-1][1] - lists[-1][0] if lists else 0
    aside = min(least - 1, int(least / (0.01 * log2(longest + 1) + 1))) if lists else 0
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :][::-1]
    need = least - aside
    heap = [(ids[a], a, b) for a, b in short]
    heapq.heapify(heap)
    while len(heap) >= need and heap[0][0] < stop:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap))
        if len(popped) >= need and not known(top):
            found, left = len(popped), len(long)
            for a, b in long:
                if found + left < least:
                    break
                at = bisect_left(ids, top, a, b)
                found += at < b and ids[at] == top
                left -= 1
            if found >= least:
                yield top, found
            target = top + 1
        elif len(popped) >= need:
            target = top + 1
        else:
            while heap and len(popped) < need - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                return
            target = heap[0][0]
        for _, a, b in popped:
            at = bisect_left(ids, target, a, b)
            if at < b:
                heapq.heappush(heap, (ids[at], at, b))


class Groups:
    """Disjoint groups of positions; the least position stands for a group."""

    def __init__(self, n: int):
        self._above = list(range(n))

    def of(self, i: int) -> int:
        while self._above[i] != i:
            self._above[i] = self._above[self._above[i]]
            i = self._above[i]
        return i

    def join(self, i: int, k: int) -> None:
        i, k = self.of(i), self.of(k)
        self._above[max(i, k)] = min(i, k)


def linked_groups(sets: list[np.ndarray], j: Fraction) -> Groups:
    """Groups of the sets, ascending arrays without repeats, that links of Jaccard `j` or more make."""
    groups = Groups(len(sets))
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = [len(sets[i]) for i in order]
    values = np.concatenate([sets[i] for i in order]) if order else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(order)), sizes)
    by_value = np.argsort(values, kind="stable")
    _, inverse, count = np.unique(values, return_inverse=True, return_counts=True)
    first = np.cumsum(count) - count
    ids = owner[by_value].tolist()
    start = 0
    for x, size in enumerate(sizes):
        own = inverse[start : start + size]
        start += size
        # Smaller sets come first, so the ids below x are the partners; lists that hold x alone say nothing.
        lists = [(a, a + c) for a, c in zip(first[own].tolist(), count[own].tolist()) if c > 1 and ids[a] < x]
        least = max(1, -(-size * j.numerator // j.denominator))
        for y, both in divide_skip(lists, ids, x, least, lambda y: groups.of(order[y]) == groups.of(order[x])):
            if both * j.denominator >= j.numerator * (size + sizes[y] - both):
                groups.join(order[y], order[x])
    return groups


def _list_column(values: np.ndarray, rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(values.view(np.int64)))


def _emit_sets(width: int, j: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for first, stop, data, offsets in blocks(batch.column(1)):
                ids = batch.column(0).slice(first, stop - first)
                values, row, rows = sets_of(data, offsets, width)
                size = np.diff(rows)
                classes = classes_of(values, row, size)
                # A text that was there before in this task has no segments to add; one without an id is in no link.
                named = ids.is_valid().to_pylist()
                known = np.where(size > 0, classes, 0).tolist()
                new = np.array([has and not (c in seen or seen.add(c)) for has, c in zip(named, known)], bool)
                segment, owner = _emit_segments(values, rows, new, j)
                order = np.argsort(owner, kind="stable")
                ends = np.searchsorted(owner[order], np.arange(stop - first + 1))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(size), pa.array(classes), _list_column(segment[order], ends)],
                    ["doc_id", "n_shingles", "class", "segments"],
                )

    return run


def _search_family(width: int, j: Fraction):
    """(class, component) of the members of one small family."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        wanted = table.column("class").to_numpy()
        sets, names = [], []
        for first, _, data, offsets in blocks(table.column("text")):
            values, row, rows = sets_of(data, offsets, width)
            classes = classes_of(values, row, np.diff(rows))
            for i, c in enumerate(classes.tolist()):
                if c == wanted[first + i] and c not in names:  # rows that only share an id, or repeat
                    sets.append(values[rows[i] : rows[i + 1]])
                    names.append(c)
        groups = linked_groups(sets, j)
        found = [names[groups.of(i)] for i in range(len(names))]
        return pa.table({"class": pa.array(names, pa.int64()), "component": pa.array(found, pa.int64())})

    return run


def sketches(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """For each of `n` sets a row of bits: whether an odd number of its shingles falls there.

    Two sketches differ in no more bits than the sets have different shingles, as shingles in both cancel out.
    """
    place = mix(values ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(64 * _WORDS)
    bits = np.zeros(n * _WORDS, np.uint64)
    slot = row * _WORDS + (place >> np.uint64(6)).astype(np.int64)
    np.bitwise_xor.at(bits, slot, np.uint64(1) << (place & np.uint64(63)))
    return bits.reshape(n, _WORDS)


def _emit_members(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, offsets in blocks(batch.column(3)):
                values, row, rows = sets_of(data, offsets, width)
                family, members, wanted = (batch.column(i).slice(first, stop - first) for i in range(3))
                same = pa.array(classes_of(values, row, np.diff(rows)) == wanted.to_numpy(zero_copy_only=False))
                bits = sketches(values, row, stop - first).ravel()
                columns = [family, members, wanted, pa.array(np.diff(rows)), _list_column(values, rows)]
                columns += [_list_column(bits, np.arange(stop - first + 1) * _WORDS)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _MEMBERS.split(", ")]).filter(same)

    return run


def _usual(table: pa.Table) -> pa.Table:
    """The shingles that more than half of a family's sample have."""
    own = table.column("shingles").combine_chunks().flatten().to_numpy()
    values, count = np.unique(own, return_counts=True)
    usual = values[2 * count > len(table)]
    first = table.select(["family", "members"]).slice(0, 1)
    return first.append_column("usual", pa.array([usual.tolist()], pa.list_(pa.int64())))


def _describe(j: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differences, rarest = [], []
            for own, usual in zip(batch.column(3), batch.column(4)):
                own = own.values.to_numpy(zero_copy_only=False)
                usual = usual.values.to_numpy(zero_copy_only=False) if usual.is_valid else np.zeros(0, np.int64)
                has = np.isin(own, usual)
                differences.append(len(own) + len(usual) - 2 * int(has.sum()))
                size = len(own)
                prefix = size - -(-size * j.numerator // j.denominator) + 1
                rarest.append(np.concatenate((own[~has], own[has]))[:prefix].tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(differences, pa.int64()), pa.array(rarest, pa.list_(pa.int64()))],
                ["family", "class", "size", "differences", "rarest"],
            )

    return run


def _large_links(rounds: Rounds, members: DataFrame, j: Fraction) -> DataFrame:
    """(u, v) links of the members of large families that have the same components as all their links.

    A member that is there twice, as a repeated row is, changes nothing.
    """
    d = (1 - j) / (1 + j)
    sampled = F.pmod(F.xxhash64("class"), F.ceil(F.col("members") / _SAMPLE)) == 0
    usual = (
        members.filter(sampled)
        .select("family", "members", "shingles")
        .groupBy("family")
        .applyInArrow(_usual, "family long, members long, usual array<long>")
    )
    usual = rounds.store(usual, "usual")
    parts = F.ceil(F.col("members") / _PARTNERS)
    copies = usual.select(
        "family", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), "usual"
    )
    copies = rounds.store(copies, "usual-copies")
    described = (
        members.withColumn("part", F.pmod(F.xxhash64("class", F.lit(1)), parts).cast("long"))
        .join(copies, ["family", "part"], "left")
        .select("family", "class", "size", "shingles", "usual")
        .mapInArrow(_describe(j), _DESCRIBED)
    )
    # Two members are linked for certain when their slacks add up to 0 or less.
    slack = F.col("differences") * d.denominator - F.col("size") * d.numerator
    described = rounds.store(described.withColumn("slack", slack), "described")
    del usual, copies
    rounds.drop("usual", "usual-copies")
    centres = described.groupBy("family").agg(
        F.min(F.struct("slack", "class")).alias("centre"), F.max("slack").alias("greatest")
    )
    centres = rounds.store(centres.select("family", "centre.*", "greatest").toDF("family", "least", "centre", "greatest"), "centres")
    described = described.join(centres, "family").withColumn("outside", F.col("slack") + F.col("least") > 0)
    star = described.filter(~F.col("outside") & (F.col("class") != F.col("centre"))).select("class", "centre").toDF("u", "v")

    def bucket(size):
        return F.floor(F.log(size.cast("double")) / _BUCKET).cast("long")

    top, low = d.denominator + d.numerator, d.denominator - d.numerator  # 2 * (1 + j), 2 * j in the same unit
    # A family whose members are all tied to the centre needs no more links.
    items = described.filter("greatest + least > 0").select(
        "family", "class", "size", "outside", F.posexplode("rarest").alias("at", "shingle")
    )
    left = F.col("size") - F.col("at")  # shingles from this one on
    smallest = F.ceil(F.col("size") * j.numerator / j.denominator)
    most = F.floor(left * (d.denominator * 2) / low) - F.col("size")
    probes = items.withColumn("most", F.least("size", most).cast("long")).filter(F.col("most") >= smallest)
    need = F.ceil(F.col("size") * 2 * low / (d.denominator * 2))
    index = items.filter(left >= need).select(
        "family", "shingle", bucket(F.col("size")).alias("bucket"), F.col("class").alias("v"),
        F.col("outside").alias("v_outside"), F.col("size").alias("v_size"), left.alias("v_left"),
    )
    outer = index.filter("v_outside")
    # Members at the centre only look for those outside, so only in lists that have such.
    tied = probes.filter("not outside").join(outer.select("family", "shingle").distinct(), ["family", "shingle"], "left_semi")

    def found(searching: DataFrame, among: DataFrame) -> DataFrame:
        searching = searching.select(
            "family", "shingle", F.explode(F.sequence(bucket(smallest), bucket(F.col("most")))).alias("bucket"), "most",
            F.col("class").alias("u"), F.col("size").alias("u_size"),
        )
        return searching.join(among, ["family", "shingle", "bucket"]).filter(fits).select("u", "v")

    fits = (
        (F.col("u") != F.col("v"))
        & (F.col("v_size") <= F.col("most"))
        & (F.col("v_left") * (d.denominator * 2) >= (F.col("u_size") + F.col("v_size")) * low)
    )
    pairs = found(probes.filter("outside"), index).union(found(tied, outer))
    pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = rounds.store(pairs, "candidates")
    # Most candidates are apart by more shingles than a link allows, which their sketches show: whole sets follow few pairs.
    short = members.select("class", "size", "sketch")
    compared = pairs.join(short.toDF("u", "u_size", "u_bits"), "u").join(short.toDF("v", "v_size", "v_bits"), "v")
    different = F.zip_with("u_bits", "v_bits", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    apart = F.aggregate(different, F.lit(0), lambda a, n: a + n)
    possible = apart * d.denominator <= (F.col("u_size") + F.col("v_size")) * d.numerator
    pairs = rounds.store(compared.filter(possible).select("u", "v").distinct(), "possible")
    own = members.select("class", "size", "shingles")
    checked = pairs.join(own.toDF("u", "u_size", "u_set"), "u").join(own.toDF("v", "v_size", "v_set"), "v")
    both = F.size(F.array_intersect("u_set", "v_set")).cast("long")
    alike = both * j.denominator >= (F.col("u_size") + F.col("v_size") - both) * j.numerator
    links = rounds.store(star.union(checked.filter(alike).select("u", "v")), "large-links")
    del described, centres, star, items, probes, index, outer, tied, pairs, compared, checked
    rounds.drop("described", "centres", "candidates", "possible")
    return links


def class_components(
    rounds: Rounds,
    classes: DataFrame,
    links: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    width: int,
    similarity: Fraction,
    small_members: int = SMALL_MEMBERS,
) -> DataFrame:
    """(class, component) of the classes in `links` (u, v), which name pairs that may be similar enough.

    Classes come with first_id, which stands for a text, and size. `fetch` replaces first_id by text in rows with it; a
    text that is of another class is passed over.
    """
    family = components(links, rounds, "nodes").select(F.col("component").alias("family"), F.col("node").alias("class"))
    family = rounds.store(family.join(classes, "class"), "families")
    rounds.drop("nodes")
    measured = family.groupBy("family").agg(F.count(F.lit(1)).alias("members"), F.sum("size").alias("shingles"))
    measured = measured.withColumn(
        "large", (F.col("members") > small_members) | (F.col("shingles") > SMALL_SHINGLES)
    ).drop("shingles")
    measured = rounds.store(measured, "family-sizes")
    wanted = family.join(measured, "family").select(
        "family", "members", "class", "large", "first_id"
    )
    wanted = rounds.store(fetch(wanted), "family-texts")
    del family, measured
    rounds.drop("families", "family-sizes")
    small = (
        wanted.filter("not large")
        .select("family", "class", "text")
        .groupBy("family")
        .applyInArrow(_search_family(width, similarity), "class long, component long")
    )
    small = rounds.store(small, "small-components")
    large = wanted.filter("large").select("family", "members", "class", "text")
    large = rounds.store(large.mapInArrow(_emit_members(width), _MEMBERS), "large-members")
    del wanted
    rounds.drop("family-texts")
    links = _large_links(rounds, large, similarity)
    del large
    rounds.drop("large-members")
    found = components(links, rounds, "large-components")
    del links
    rounds.drop("large-links")
    return small.union(found.select("node", "component"))


def jaccard_components(
    docs: DataFrame,
    width: int = WIDTH,
    similarity: Fraction = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    small_members: int = SMALL_MEMBERS,
    rounds: Rounds | None = None,
) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id, the least id that links lead to, its own included.

    A document's set: the distinct runs of `width` words, A-Z as a-z; with fewer words, the whole sequence. Documents
    link when the Jaccard similarity of their sets is at least `similarity`. A null or empty text, or one without
    words, has no shingles and is linked with nothing. A row without an id is in no component: component_id is null.
    Repeated rows each give a row; rows that share an id but not the text are judged one by one. Acts at once.
    What the result reads is stored in `rounds`, which the caller may clear after the result has been read.
    """
    rounds = rounds or Rounds(docs.sparkSession)
    texts = documents(docs, id_col, text_col)
    rows = rounds.store(texts.mapInArrow(_emit_sets(width, similarity), _SETS), "sets")
    segments = rows.select("class", F.explode("segments").alias("segment"))
    shared = segments.groupBy("segment").agg(F.min("class").alias("least"), F.max("class").alias("most"))
    shared = rounds.store(shared.filter("least < most").select("segment", "least"), "shared")
    # Both joins shuffle at every size, so that small inputs behave like large ones.
    links = segments.join(shared.hint("merge"), "segment").filter("class != least").select("class", "least").distinct()
    links = rounds.store(links.toDF("u", "v"), "same-segment")
    # From here on no one needs the segments, most of what is stored.
    rows = rounds.store(rows.select("doc_id", "n_shingles", "class"), "rows")
    del segments, shared
    rounds.drop("shared", "sets")
    classes = (
        rows.filter("n_shingles > 0 and doc_id is not null")
        .groupBy("class")
        .agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("size"))
    )
    classes = rounds.store(classes, "classes")

    def fetch(wanted: DataFrame) -> DataFrame:
        # Texts are shuffled at every size, so that small inputs behave like large ones.
        wanted = wanted.withColumnRenamed("first_id", "doc_id").hint("merge")
        return texts.join(wanted, "doc_id").select(
            "family", "members", "class", "large", F.coalesce("text", F.lit("")).alias("text")
        )

    found = class_components(rounds, classes, links, fetch, width, similarity, small_members)
    joined = rounds.store(
        classes.join(found, "class", "left").select("class", "first_id", F.coalesce("component", "class").alias("component")),
        "joined",
    )
    least = rounds.store(joined.groupBy("component").agg(F.min("first_id").alias("component_id")), "least-ids")
    by_class = rounds.store(joined.join(least, "component").select("class", "component_id"), "by-class")
    del found, links, joined, least
    rounds.drop("same-segment", "classes", "small-components", "large-components", "joined", "least-ids")
    return rows.select("doc_id", "n_shingles", "class").join(by_class, "class", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id"))
        .when(F.col("doc_id").isNotNull(), F.col("component_id"))
        .alias("component_id"),
    )
