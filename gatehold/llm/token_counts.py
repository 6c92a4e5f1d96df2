"""Token counts of whole texts under a word BPE vocabulary, by a two-tier lookup inside the tasks.

The ids of a text are those of its pre-tokens one after another, so its count is the sum of theirs. A first pass lets
every task count the pre-tokens of all its texts in a bounded summary; the summaries, not the pre-tokens, are merged. The
most frequent pre-tokens and their lengths in tokens become a compact hash table of fixed size, which is broadcast: the
first tier. In the second pass blocks of texts are cut into pre-tokens and looked up as arrays; what the table misses is
encoded by the library once per worker and remembered there: the second tier. No pre-token is shuffled, and the table
decides the speed only: counts are those of the library whatever it holds.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from heapq import nlargest

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from gatehold.llm.columns import documents, quoted

LIMIT = 2048
FREQUENT = 32_768  # entries of the broadcast table
SUMMARY = 65_536  # pre-tokens that a task counts before it lets go of the rarer half
BLOCK = 1 << 20  # bytes of text cut into pre-tokens together; a longer text is a block by itself
CACHED = 200_000  # pre-tokens that a worker remembers before it starts anew
LONG = 23  # bytes of the longest pre-token in the table: three words of eight, one byte of which is the length
LONG_CACHED = 256  # bytes of the longest pre-token that is remembered
# The normaliser and the splitting rule of the vocabularies whose pre-tokens are known here.
_NORMALISER = ["NFC", ("Replace", r"\s+", " "), "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Kinds of code points; those of which this Python and the library may think differently are FOREIGN.
UNSEEN, SPACE, LETTER, NUMBER, OTHER, FOREIGN = range(6)

_OUT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
_SUMMARY = "pre_tokens array<binary>, counts array<long>"
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def normal(text: str) -> str:
    """The text as the normaliser leaves it, but for runs of white space, which stay: they end pre-tokens either way."""
    if text.isascii():
        return text.lower()
    # The library lowers one character at a time, so a sigma is never a final one.
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Vocabulary:
    """The library's tokenizer of a file and what is known of it in this process."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [n["type"] if n["type"] != "Replace" else ("Replace", n["pattern"]["Regex"], n["content"]) for n in spec["normalizer"]["normalizers"]]
        split, levels = spec["pre_tokenizer"]["pretokenizers"]
        known = steps == _NORMALISER and split["pattern"]["Regex"] == _SPLIT and split["invert"] and levels["type"] == "ByteLevel"
        added = spec.get("added_tokens", [])
        if not known or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path} does not normalise and split texts the way that this operator does")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        # Encodes one pre-token, which is not to be normalised or split again.
        self.words = Tokenizer(self.library.model)
        self.words.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in added) or r"\Z.")
        self.kinds = np.zeros(0x110000, np.uint8)
        self.learn(np.arange(128))
        self.cache: dict[bytes, int] = {}

    def learn(self, points: np.ndarray) -> None:
        """The kinds of code points, as the library's own splitter takes them."""
        splitter, normaliser = self.library.pre_tokenizer, self.library.normalizer
        for point in points.tolist():
            c = chr(point)
            if point >= 128 and (unicodedata.category(c) == "Cn" or normaliser.normalize_str(c) != re.sub(r"\s", " ", normal(c))):
                self.kinds[point] = FOREIGN
                continue
            pieces = len(splitter.pre_tokenize_str(f"a{c}a"))
            others = pieces == 3 and len(splitter.pre_tokenize_str(f"!{c}!")) == 1
            self.kinds[point] = {1: LETTER, 2: SPACE}.get(pieces, OTHER if others else NUMBER)

    def kinds_of(self, points: np.ndarray) -> np.ndarray:
        kinds = self.kinds[points]
        if not kinds.all():
            self.learn(np.unique(points[kinds == UNSEEN]))
            kinds = self.kinds[points]
        return kinds

    def lengths(self, pre_tokens: list[bytes]) -> list[int]:
        """Tokens of each pre-token; of which no two may share a cut character."""
        return [len(e.ids) for e in self.words.encode_batch_fast([p.decode() for p in pre_tokens], add_special_tokens=False)]

    def remembered(self, pre_tokens: list[bytes]) -> list[int]:
        """The same from what this worker remembers; each new one is encoded once."""
        cache = self.cache
        if len(cache) > CACHED:
            cache.clear()
        new = list({p for p in pre_tokens if p not in cache})
        found = dict(zip(new, self.lengths(new)))
        cache.update((p, n) for p, n in found.items() if len(p) <= LONG_CACHED)
        return [cache[p] if p in cache else found[p] for p in pre_tokens]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per worker process and file; `path` must exist on every executor, as installed packages do."""
    return Vocabulary(path)


@dataclass
class Cut:
    """Texts cut into pre-tokens: raw[starts:ends] in the normalised bytes; those of text i are first[i] to first[i + 1].

    `extra` counts special tokens, and all tokens of texts left whole to the library.
    """

    raw: bytes
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    extra: np.ndarray


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def cut(texts: list[str], known: Vocabulary) -> Cut:
    """The pre-tokens of all texts at once, by the kinds of their characters."""
    extra = np.zeros(len(texts), np.int64)
    parts: list[bytes] = []
    for i, text in enumerate(texts):
        if "<" in text:
            pieces = known.special.split(text)
            extra[i] = len(pieces) - 1
            # White space between the pieces keeps them apart.
            text, whole = "\n".join(pieces), text
        else:
            whole = text
        if not text.isascii() and (known.kinds_of(_points(text)) == FOREIGN).any():
            extra[i], text = len(known.library.encode(whole, add_special_tokens=False).ids), ""
        parts.append(normal(text).encode())
    raw = b"\n".join(parts) + b"\n"
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))
    data = np.frombuffer(raw, np.uint8)
    if raw.isascii():
        kinds, lead = known.kinds[data], None
    else:
        points = _points(raw.decode())
        wide = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        kinds, lead = np.repeat(known.kinds_of(points), wide), (data & 0xC0) != 0x80
    other = kinds[1:] != kinds[:-1]
    start = np.ones(len(data), bool)
    start[1:] = other | (kinds[1:] == NUMBER)
    if lead is not None:
        start &= lead
    start &= kinds != SPACE
    _split_contractions(data, kinds, start)
    last = np.ones(len(data), bool)
    last[:-1] = start[1:] | (kinds[1:] == SPACE)
    last &= kinds != SPACE
    starts, ends = np.flatnonzero(start), np.flatnonzero(last) + 1
    return Cut(raw, starts, ends, np.searchsorted(starts, begins), extra)


def _split_contractions(data: np.ndarray, kinds: np.ndarray, start: np.ndarray) -> None:
    """An apostrophe by itself takes one of s, t, m, d or re, ve, ll with it; letters behind them start anew."""
    at = np.flatnonzero(data[:-1] == ord("'"))
    at = at[start[at] & (kinds[at + 1] == LETTER)]
    if not len(at):
        return
    after = np.append(data, (0, 0)).astype(np.uint16)  # the text ends with white space, which these never match
    one, two = after[at + 1], after[at + 1] * 256 + after[at + 2]
    size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, np.where(np.isin(two, [ord(a) * 256 + ord(b) for a, b in ("re", "ve", "ll")]), 2, 0))
    at, size = at[size > 0], size[size > 0]
    start[at + 1] = False
    behind = at + 1 + size
    start[behind[kinds[behind] == LETTER]] = True


def keys_of(raw: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Three words for each pre-token of up to LONG bytes: its bytes and, in the last, its length. Equal only if all is."""
    data = np.frombuffer(raw + bytes(32), np.uint8)
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    keys = np.zeros((3, len(starts)), np.uint64)
    keys[0] = words[starts] & _MASKS[np.minimum(sizes, 8)]
    for i in (1, 2):
        more = np.flatnonzero(sizes > 8 * i)
        keys[i, more] = words[starts[more] + 8 * i] & _MASKS[np.minimum(sizes[more] - 8 * i, 8)]
    keys[2] |= sizes.astype(np.uint64) << np.uint64(56)
    return keys


def hashes(keys: np.ndarray) -> np.ndarray:
    h = keys[0] * np.uint64(_MIX[0]) + keys[1] * np.uint64(_MIX[1]) + keys[2] * np.uint64(_MIX[2])
    h ^= h >> np.uint64(32)
    return h * np.uint64(_MIX[3])


class Table:
    """Lengths of pre-tokens in tokens, under their bytes, by open addressing in flat arrays; a quarter is in use."""

    def __init__(self, lengths: dict[bytes, int]):
        lengths = {p: n for p, n in lengths.items() if len(p) <= LONG and n < 256}
        self.bits = max(4, (4 * len(lengths) - 1).bit_length() if lengths else 4)
        slots = 1 << self.bits
        self.keys = np.zeros((slots, 3), np.uint64)
        self.lengths = np.zeros(slots, np.uint8)  # 0: empty
        self.probes = 0
        pre_tokens = list(lengths)
        sizes = np.array([len(p) for p in pre_tokens], np.int64)
        keys = keys_of(b"".join(pre_tokens), np.cumsum(sizes) - sizes, sizes)
        for key, home, n in zip(keys.T, (hashes(keys) >> np.uint64(64 - self.bits)).tolist(), lengths.values()):
            step = 0
            while self.lengths[(home + step) % slots]:
                step += 1
            self.keys[(home + step) % slots], self.lengths[(home + step) % slots] = key, n
            self.probes = max(self.probes, step + 1)

    def lookup(self, raw: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of each pre-token, 0 where the table does not have it."""
        out = np.zeros(len(starts), np.uint8)
        short = np.flatnonzero(sizes <= LONG)
        keys = keys_of(raw, starts[short], sizes[short])
        slot = (hashes(keys) >> np.uint64(64 - self.bits)).astype(np.int64)
        keys = keys.T
        for _ in range(self.probes):
            there = self.lengths[slot]
            same = (self.keys[slot] == keys).all(axis=1) & (there > 0)
            out[short[same]] = there[same]
            left = np.flatnonzero(~same & (there > 0))
            if not len(left):
                break
            short, keys, slot = short[left], keys[left], (slot[left] + 1) % len(self.lengths)
        return out


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, whole texts) of blocks; a null counts as empty."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(ends, ends[start] - sizes[start] + BLOCK, side="right"))
        stop = min(max(stop, start + 1), len(column))
        yield start, [t or "" for t in column.slice(start, stop - start).to_pylist()]
        start = stop


def _trim(counts: dict[bytes, int], most: int) -> dict[bytes, int]:
    return counts if len(counts) <= most else dict(nlargest(most, counts.items(), key=lambda x: (x[1], x[0])))


def _row(counts: dict[bytes, int]) -> pa.RecordBatch:
    counts = _trim(counts, FREQUENT)
    columns = [pa.array([list(counts)], pa.list_(pa.binary())), pa.array([list(counts.values())], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["pre_tokens", "counts"])


def frequent(docs: DataFrame, path: str, text_col: str = "text") -> dict[bytes, int]:
    """The FREQUENT pre-tokens that are counted most often in all texts, with their counts.

    Every task counts all its texts and gives one row, a summary of bounded size. Summaries are gathered by the hundred
    (as many as make a partition of adaptive execution) and merged, twice, before one task merges what is left. Rare
    pre-tokens may be undercounted, frequent ones are not.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = vocabulary(path), {}
        for batch in batches:
            for _, texts in _texts(batch.column(0)):
                parts = cut(texts, known)
                sizes = parts.ends - parts.starts
                short = np.flatnonzero(sizes <= LONG)
                starts, sizes = parts.starts[short], sizes[short]
                # Which bytes stand for a hash is taken from its first place; two that share one would only be mixed up here.
                _, at, n = np.unique(hashes(keys_of(parts.raw, starts, sizes)), return_index=True, return_counts=True)
                for a, b, k in zip(starts[at].tolist(), (starts[at] + sizes[at]).tolist(), n.tolist()):
                    p = parts.raw[a:b]
                    counts[p] = counts.get(p, 0) + k
                if len(counts) > SUMMARY:
                    counts = _trim(counts, SUMMARY // 2)
        if counts:
            yield _row(counts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for pre_tokens, numbers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for p, n in zip(pre_tokens, numbers):
                    counts[p] = counts.get(p, 0) + n
                counts = _trim(counts, 2 * FREQUENT)
        if counts:
            yield _row(counts)

    rows = docs.select(quoted(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(summarise, _SUMMARY)
    for _ in range(2):
        found = found.hint("rebalance").mapInArrow(merge, _SUMMARY)
    row = found.repartition(1).mapInArrow(merge, _SUMMARY).first()
    return dict(zip(map(bytes, row["pre_tokens"]), row["counts"])) if row else {}


def table_of(pre_tokens: dict[bytes, int], path: str) -> Table:
    return Table(dict(zip(pre_tokens, vocabulary(path).lengths(list(pre_tokens)))))


def counted(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than `limit` tokens) of every row.

    Tokens are those that the library gives without begin and end; strings of special tokens inside a text are one token
    each, its default. A null text counts as empty and has none; a null id stays null; repeated rows each give a row. A
    text of any length is counted whole, in one block. Other columns of `docs` are not read. Acts at once: the table is
    made before the result, which is lazy.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(table_of(frequent(docs, path, text_col), path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in batches:
            tokens = np.zeros(len(batch), np.int64)
            for at, texts in _texts(batch.column(1)):
                parts = cut(texts, known)
                sizes = parts.ends - parts.starts
                lengths = table.value.lookup(parts.raw, parts.starts, sizes).astype(np.int64)
                missed = np.flatnonzero(lengths == 0)
                spans = zip(parts.starts[missed].tolist(), parts.ends[missed].tolist())
                lengths[missed] = known.remembered([parts.raw[a:b] for a, b in spans])
                total = np.concatenate(([0], np.cumsum(lengths)))[parts.first]
                tokens[at : at + len(texts)] = parts.extra + np.diff(total)
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            columns = [batch.column(0), size, pa.array(tokens), pa.array(tokens > limit)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _OUT.split(", ")])

    return documents(docs, id_col, text_col).mapInArrow(run, _OUT)
