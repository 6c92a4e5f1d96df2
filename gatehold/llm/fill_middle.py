"""Fill-in-the-middle: texts cut at two token boundaries and put together as prefix, suffix and middle.

The offsets of a text's token boundaries, by rank, are a rising sequence that straight lines follow closely. A block of
texts gets a learned index over all its boundaries: segments whose lines are at most a few code points off, and for each
boundary the difference between line and offset as one byte. A cut by rank is predicted by the line of its segment and
put right by the stored difference, so offsets are exact. Segments are found for all texts of a block at once. There is no
shuffle; a task holds one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehold.llm.columns import documents
from gatehold.llm.rolling import blocks

ERROR = 126  # code points that a line may be off, before rounding; the residuals then fit into a byte
SEED = 1
TRANSFORMED = 90  # per cent of the texts
SUFFIX_FIRST = 20  # per cent of those
# What stands before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)

_OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


@dataclass
class RankIndex:
    """Offsets of ranks as lines and residuals. Segment s holds the ranks from starts[s] up to the next segment's."""

    starts: np.ndarray
    slopes: np.ndarray
    bases: np.ndarray
    residuals: np.ndarray

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        segment = np.searchsorted(self.starts, ranks, side="right") - 1
        return _line(self.bases[segment], self.slopes[segment], ranks - self.starts[segment])

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offset of each rank."""
        return self.predicted(ranks) + self.residuals[ranks]


def _line(base: np.ndarray, slope: np.ndarray, steps: np.ndarray) -> np.ndarray:
    return np.floor(base + slope * steps + 0.5).astype(np.int64)


def fit(offsets: np.ndarray, first: np.ndarray, error: int = ERROR) -> RankIndex:
    """An index over the boundary offsets of texts; first: the first rank of each text and the number of all.

    Each text starts as one segment. A line goes through a segment's ends and is moved so that it is as far off below as
    above; where that is more than `error`, both halves are tried. A segment of up to two ranks always fits.
    """
    begin, end = first[:-1].copy(), first[1:].copy()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(begin):
        size = end - begin
        heads = np.cumsum(size) - size
        step = np.arange(size.sum()) - np.repeat(heads, size)
        values = offsets[np.repeat(begin, size) + step]
        slope = (offsets[end - 1] - offsets[begin]) / np.maximum(size - 1, 1)
        off = values - np.repeat(slope, size) * step
        low, high = np.minimum.reduceat(off, heads), np.maximum.reduceat(off, heads)
        fits = (high - low <= 2 * error) | (size <= 2)
        found.append((begin[fits], slope[fits], ((low + high) / 2)[fits]))
        begin, end = begin[~fits], end[~fits]
        middle = (begin + end) // 2
        begin, end = np.concatenate((begin, middle)), np.concatenate((middle, end))
    if not found:
        return RankIndex(*(np.zeros(0, kind) for kind in (np.int64, float, float, np.int8)))
    starts, slopes, bases = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(starts)
    index = RankIndex(starts[order], slopes[order], bases[order], np.zeros(len(offsets), np.int8))
    residuals = offsets - index.predicted(np.arange(len(offsets)))
    kind = np.int8 if len(residuals) == 0 or np.abs(residuals).max() < 128 else np.int64
    index.residuals = residuals.astype(kind)
    return index


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offset of each token boundary in its text in code points, first boundary of each text and their number).

    Tokens are runs of A-Z and a-z, and all other characters one by one; a text of n tokens has n + 1 boundaries.
    """
    letter, lead = _LETTER[data], (data & 0xC0) != 0x80
    start = lead & ~letter
    start[:1] |= letter[:1]
    start[1:] |= letter[1:] & ~letter[:-1]
    start[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    chars = np.concatenate(([0], np.cumsum(lead)))
    tokens = np.flatnonzero(start)
    rows = np.searchsorted(tokens, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(rows))
    out = np.empty(len(tokens) + len(offsets) - 1, np.int64)
    out[np.arange(len(tokens)) + row] = chars[tokens] - chars[offsets[row]]
    out[rows[1:] + np.arange(len(offsets) - 1)] = chars[offsets[1:]] - chars[offsets[:-1]]
    return out, rows + np.arange(len(offsets))


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers that follow from the seed and the id; a null id counts as an empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))


def fill_in_middle(
    docs: DataFrame,
    seed: int = SEED,
    transformed: int = TRANSFORMED,
    suffix_first: int = SUFFIX_FIRST,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars (code points) and output of every row.

    `psm`: prefix, suffix, middle, each behind its mark; `spm`: the suffix first; `plain`: the text as it is, for empty
    texts, those that contain a mark, and those not drawn, with null lengths. A null text counts as empty; repeated rows
    are transformed one by one, in the same way if their ids are the same; a text of any length is cut whole. Other
    columns of `docs` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, data, offsets in blocks(batch.column(1)):
                ends, first = boundaries(data, offsets)
                index = fit(ends, first)
                ids = batch.column(0).slice(row, stop - row)
                texts = [t or "" for t in batch.column(1).slice(row, stop - row).to_pylist()]
                n = np.diff(first) - 1
                drawn = np.array([draws(i, seed) for i in ids.to_pylist()], np.int64)
                cuts = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
                cuts = index.offsets((first[:-1, None] + cuts).ravel()).reshape(-1, 2)
                forms, outputs = [], []
                for t, (a, b), (h3, h4) in zip(texts, cuts.tolist(), drawn[:, 2:].tolist()):
                    if not t or h3 % 100 >= transformed or any(m in t for m in MARKS):
                        form, output = "plain", t
                    elif h4 % 100 < suffix_first:
                        form, output = "spm", "".join((SUFFIX, t[b:], PREFIX, t[:a], MIDDLE, t[a:b]))
                    else:
                        form, output = "psm", "".join((PREFIX, t[:a], SUFFIX, t[b:], MIDDLE, t[a:b]))
                    forms.append(form)
                    outputs.append(output)
                plain = np.array([f == "plain" for f in forms], bool)
                columns = [ids, pa.array(n), pa.array(forms, pa.string())]
                columns += [pa.array(x, pa.int64(), mask=plain) for x in (cuts[:, 0], cuts[:, 1] - cuts[:, 0])]
                columns += [pa.array(outputs, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _OUT.split(", ")])

    return documents(docs, id_col, text_col).mapInArrow(run, _OUT)


def _between(text: Column, left: str, right: str | None) -> Column:
    """What stands between the first places of two marks, or behind one."""
    start = F.locate(left, text) + len(left)
    size = F.locate(right, text) - start if right else F.length(text)
    return F.substr(text, start, size)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made of.

    Its parts hold no mark, and none can arise where a part meets a mark, as `<` only begins and `>` only ends one.
    """
    psm = F.concat(_between(output, PREFIX, SUFFIX), _between(output, MIDDLE, None), _between(output, SUFFIX, MIDDLE))
    spm = F.concat(_between(output, PREFIX, MIDDLE), _between(output, MIDDLE, None), _between(output, SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
