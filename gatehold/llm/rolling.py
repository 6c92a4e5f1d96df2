"""Words and hashes of many texts at once, as numpy arrays over the bytes of an Arrow column.

Words are hashed eight bytes at a time. For long stretches that overlap, a text's bytes are also hashed as a polynomial
modulo 2**64 kept as running totals, so the hash of any stretch is one subtraction and one product; that is a filter, since
strings exist whose hashes meet, and what it finds is to be compared. All functions take blocks of whole texts of about `BLOCK` bytes (a longer text is a block
by itself), which bounds the memory of a task by that size or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C55)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of the 64-bit values over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least `n` powers of the base and of its inverse."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, 2 * BLOCK)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            values = np.full(size, base, np.uint64)
            values[0] = 1
            _powers[name] = np.multiply.accumulate(values)
    up, down = _powers["up"], _powers["down"]
    if len(up) > 4 * BLOCK:  # do not hold on to what one very long text needed
        _powers.clear()
    return up, down


def blocks(column: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of the rows in the bytes and their end); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield start, stop, data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    return _LOWER[data]


def running(data: np.ndarray) -> np.ndarray:
    """Totals from which `stretch` takes the hash of any part of `data`."""
    up, _ = powers(len(data) + 1)
    totals = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=totals[1:])
    return totals


def stretch(totals: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each data[start:end]; equal bytes have equal hashes wherever they stand."""
    _, down = powers(len(totals))
    return mix((totals[ends] - totals[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row and their number): words are the runs of bytes that are not white space."""
    full = ~_SPACE[data]
    first = full.copy()
    first[1:] &= ~full[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = full[heads]
    last = full.copy()
    last[:-1] &= ~full[1:]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[tails] = full[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each non-empty data[start:end]; equal bytes have equal hashes wherever they stand.

    Eight bytes at a time are mixed with a number that belongs to their place, and the results are added up: unlike with
    a polynomial, there are no patterns of bytes whose differences cancel whatever the base is.
    """
    padded = np.concatenate((np.ascontiguousarray(data), np.zeros(8, np.uint8)))
    words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    sizes = ends - starts
    total = mix(words[starts] & _MASKS[np.minimum(sizes, 8)])
    longer = np.flatnonzero(sizes > 8)
    if len(longer):
        parts = (sizes[longer] - 1) // 8  # of eight bytes or fewer, behind the first
        heads = np.cumsum(parts) - parts
        place = np.arange(parts.sum()) - np.repeat(heads, parts) + 1
        at = np.repeat(starts[longer], parts) + 8 * place
        left = np.repeat(ends[longer], parts) - at
        values = words[at] & _MASKS[np.minimum(left, 8)]
        total[longer] += np.add.reduceat(mix(values ^ mix(place.astype(np.uint64) * _BASE)), heads)
    return mix(total + sizes.astype(np.uint64) * _BASE)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each row and their number), A-Z taken as a-z."""
    starts, ends, rows = word_spans(data, offsets)
    return span_hashes(lower(data), starts, ends), rows


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values, ascending, the first place of each, and the number of the value at each place).

    As np.unique has them, but by a hash table: only the distinct values are sorted.
    """
    coded = pa.array(values).dictionary_encode()
    code, found = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    first = np.flatnonzero(np.diff(np.maximum.accumulate(code), prepend=-1))
    order = np.argsort(found)
    number = np.empty_like(order)
    number[order] = np.arange(len(order))
    return found[order], first[order], number[code]


def row_of(rows: np.ndarray) -> np.ndarray:
    """The row of each item, from the first item of each row and their number."""
    return np.repeat(np.arange(len(rows) - 1), np.diff(rows))


def shingles(words: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of `width` words in a row, first run of each row and their number).

    A row with fewer words, but at least one, has all its words as its only run.
    """
    count = np.diff(rows)
    runs = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    out_rows = np.concatenate(([0], np.cumsum(runs)))
    begin = np.repeat(rows[:-1] - out_rows[:-1], runs) + np.arange(out_rows[-1])
    end = np.minimum(begin + width, np.repeat(rows[1:], runs))
    salt = np.uint64(0xD6E8FEB86659FD93)
    total = np.zeros(len(begin), np.uint64)
    for i in range(width):
        inside = begin + i < end
        total[inside] = total[inside] * salt + words[(begin + i)[inside]]
    return mix(total + (end - begin).astype(np.uint64)), out_rows
