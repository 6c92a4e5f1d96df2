"""SentencePiece models on the tokenizers library: encoding, decoding and a parity check.

The model file is read as a protocol buffer; pieces, scores and the normaliser's settings become a tokenizer of the other
library: its normaliser, the marker for spaces, unigram scores or the merges of a BPE model, and bytes for characters
that no piece has. Batches are encoded with as many threads as the library is given.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gatehold.llm.columns import documents
from gatehold.llm.rolling import blocks

MARK = "▁"
REMEMBERED = 300_000  # words of a generation; a worker keeps two, so words that come again stay
# Field numbers of the model file and its kinds of pieces.
_PIECES, _TRAINER, _NORMALISER = 1, 2, 3
_TEXT, _SCORE, _KIND = 1, 2, 3
_MODEL_TYPE, _UNIGRAM, _BPE = 3, 1, 2
_CHARSMAP, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE = 2, 3, 4, 5
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6

_OUT = "doc_id long, n_ids long, ids_crc32 long, round_trip boolean, parity boolean"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a message; 32- and 64-bit values stay bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value = data[at : at + size]
            at += size
        yield key >> 3, value


@dataclass
class Model:
    pieces: list[tuple[str, float, int]]
    bpe: bool
    charsmap: bytes
    dummy_prefix: bool
    merge_spaces: bool
    escape: bool


def read_model(path: str) -> Model:
    with open(path, "rb") as file:
        data = file.read()
    pieces, trainer, rules = [], {}, {}
    for number, value in _fields(data):
        if number == _PIECES:
            piece = dict(_fields(value))
            score = float(np.frombuffer(piece.get(_SCORE, b"\0" * 4), "<f4")[0])
            pieces.append((piece[_TEXT].decode(), score, piece.get(_KIND, _NORMAL)))
        elif number == _TRAINER:
            trainer = dict(_fields(value))
        elif number == _NORMALISER:
            rules = dict(_fields(value))
    return Model(
        pieces,
        trainer.get(_MODEL_TYPE, _UNIGRAM) == _BPE,
        rules.get(_CHARSMAP, b""),
        bool(rules.get(_DUMMY_PREFIX, 1)),
        bool(rules.get(_EXTRA_SPACES, 1)),
        bool(rules.get(_ESCAPE, 1)),
    )


def merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """The merges of a BPE model: each way to make a piece of two others, best scored pieces first."""
    ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (_NORMAL, _USER)}
    found = []
    for piece, score, kind in pieces:
        if kind == _NORMAL:
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    found.append((-score, left, right, piece[:cut], piece[cut:]))
    return [m[3:] for m in sorted(found)]


def build(model: Model):
    """A tokenizer with the ids of the model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    byte_fallback = any(kind == _BYTE for *_, kind in model.pieces)
    unknown = next((i for i, (*_, kind) in enumerate(model.pieces) if kind == _UNKNOWN), None)
    if model.bpe:
        core = models.BPE(
            vocab={p: i for i, (p, *_) in enumerate(model.pieces)},
            merges=merges(model.pieces),
            unk_token=None if unknown is None else model.pieces[unknown][0],
            fuse_unk=True,
            byte_fallback=byte_fallback,
        )
    else:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unknown, byte_fallback)
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.merge_spaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    space = MARK if model.escape else " "
    steps += [normalizers.Prepend(space)] if model.dummy_prefix else []
    steps += [normalizers.Replace(" ", MARK)] if model.escape else []
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    if not any(space in p.lstrip(space) for p, *_ in model.pieces):
        # No piece has a space behind another character, so words can be encoded, and remembered, one by one.
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{space}+[^{space}]*|[^{space}]+"), "isolated")
    own = [AddedToken(p, normalized=False, special=False) for p, _, kind in model.pieces if kind == _USER]
    if own:
        tokenizer.add_tokens(own)
    parts = [decoders.Replace(MARK, " ")] if model.escape else []
    parts += [decoders.ByteFallback()] if byte_fallback else []
    parts += [decoders.Fuse()] + ([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else [])
    tokenizer.decoder = decoders.Sequence(parts)
    return tokenizer


@lru_cache(maxsize=2)
def codec(path: str):
    """One per worker process and file; `path` must exist on every executor, as installed packages do."""
    return build(read_model(path))


@lru_cache(maxsize=2)
def reference(path: str):
    """The library whose ids the codec must give, for the parity check."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Words:
    """Ids of texts from those of their distinct words, each of which is encoded, decoded and compared once.

    That is enough when texts are not normalised and no piece has a space behind another character: a word is then a run
    of spaces, the first of which stands for the prefix, and what follows up to the next space. New words are encoded in
    one batch with as many threads as the library is given. Other models and texts are worked on whole.
    """

    def __init__(self, path: str):
        model = read_model(path)
        self.codec, self.library = codec(path), reference(path)
        self.normalised = model.merge_spaces or bool(model.charsmap)
        plain = model.dummy_prefix and model.escape and not self.normalised
        own = any(kind == _USER for *_, kind in model.pieces)
        self.by_word = plain and not own and not any(MARK in p.lstrip(MARK) or " " in p for p, *_ in model.pieces)
        self.words = re.compile(" +[^ ]*")
        # Those met since the last change of generations, and those of the one before.
        self.known: dict[str, tuple[bytes, bool, bool]] = {}
        self.older: dict[str, tuple[bytes, bool, bool]] = {}

    def _checked(self, texts: list[str]) -> list[tuple[bytes, bool, bool]]:
        """(ids as little-endian 32-bit numbers, decoding gives the text again, the library gives the same ids)."""
        ids = [e.ids for e in self.codec.encode_batch_fast(texts, add_special_tokens=False)]
        back = self.codec.decode_batch(ids, skip_special_tokens=False)
        wanted = self.library.encode(texts)
        if self.normalised:
            texts = [self.library.normalize(t).removeprefix(MARK).replace(MARK, " ") for t in texts]
        return [(array("I", i).tobytes(), a == b, i == w) for i, a, b, w in zip(ids, back, texts, wanted)]

    def checked(self, texts: list[str]) -> Iterator[tuple[bytes, bool, bool]]:
        """The same for each text, from its words where that is enough."""
        split: list[list[str] | None] = []
        for t in texts:
            # A space at the end is a word without a text of its own; a marker in the text is taken for a space.
            whole = not self.by_word or t.endswith(" ") or MARK in t or "\0" in t
            split.append(None if whole else self.words.findall(" " + t) if t else [])
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        new = []
        for word in set(chain.from_iterable(s for s in split if s)).difference(self.known):
            if word in self.older:
                self.known[word] = self.older[word]
            else:
                new.append(word)
        if new:
            self.known.update(zip(new, self._checked([w[1:] for w in new])))
        for t, s in zip(texts, split):
            if s is None:
                yield self._checked([t])[0]
            elif s:
                ids, back, same = zip(*map(self.known.__getitem__, s))
                yield b"".join(ids), all(back), all(same)
            else:
                yield b"", True, True


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    return Words(path)


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every text. A null or empty text has no ids; repeated rows each give a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, _, _ in blocks(batch.column(1)):
                texts = [t or "" for t in batch.column(1).slice(first, stop - first).to_pylist()]
                ids = [e.ids for e in codec(path).encode_batch_fast(texts, add_special_tokens=False)]
                column = pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, stop - first), column], ["doc_id", "ids"])

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).to_pylist()
            texts = iter(codec(path).decode_batch([r for r in rows if r is not None], skip_special_tokens=False))
            column = pa.array([None if r is None else next(texts) for r in rows], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), column], ["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def checked(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of encoding and decoding every text: doc_id, n_ids, ids_crc32 (little-endian unsigned 32-bit ids),
    round_trip (decoding the ids gives the text again, after the model's normaliser) and parity (the sentencepiece
    library gives the same ids). A null text counts as empty; repeated rows and rows without an id each give a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, _, _ in blocks(batch.column(1)):
                texts = [t or "" for t in batch.column(1).slice(first, stop - first).to_pylist()]
                ids, back, same = zip(*words_of(path).checked(texts))
                columns = [batch.column(0).slice(first, stop - first)]
                columns += [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(map(zlib.crc32, ids), pa.int64())]
                columns += [pa.array(back, pa.bool_()), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _OUT.split(", ")])

    return documents(docs, id_col, text_col).mapInArrow(run, _OUT)
