"""Scoring texts with a causal self-attention model over the subword ids of their words.

The probability of a word is a mixture: its share of the training words of each language, its probability under a
character model of each language, and a copy of an earlier word, chosen by attention. The attention and the weights of
the mixture, so also which language the text seems to be in, come from a small network, trained here in numpy: each block
of texts goes on from the same network over all windows of its training texts, and Spark averages what the blocks end
with. Counts and the character model are those of all training documents too. Texts are scored in windows that overlap by their context, each word in one of them, many windows at once.

Word counts can grow with the corpus, so no task holds them all: documents are dealt into blocks, the distinct words of a
block get their counts by a join, and each block meets its own words' counts.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehold.llm.bpe import encoder
from gatehold.llm.charlm import Model, Words, count_grams, estimate
from gatehold.llm.columns import quoted
from gatehold.llm.rolling import blocks, distinct, lower, span_hashes, word_spans
from gatehold.llm.storage import Rounds

BLOCK_BYTES = 8 << 20  # texts that are scored together; a longer text is a block by itself
PACKED = 1 << 16  # words that a task packs at once
BUCKETS = 100_000  # most that Spark writes as it is set by default
WARM = 8  # blocks whose fits are averaged first, for a start that the fits of all blocks then go on from
CONTEXT = 32  # words before the ones a window scores
TARGETS = 32  # words that a window scores
WIDTH = 8  # of the network
IDS = 1024  # subword ids are hashed to so many embeddings
STEPS = 400  # of a fit from the start, or more where the windows are more
BATCH = 64
RATE = 0.01
PARTS = 16  # languages with counts of their own, the most frequent; the others have theirs together
END = np.uint64(0xE4D0F7E87)  # stands for the end of a text among the words

_BLOCKS = "doc_id long, text string, part int, block long"
_VOCABULARY = "block long, word long, n array<long>"
_PACKED = "block long, word array<long>, n array<long>"
_FITS = "windows long, weights array<double>"
_TABLES = ("first", "last", "known", "part")  # embeddings; next to each other among the weights
_SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


@dataclass
class Network:
    weights: dict[str, np.ndarray]
    moments: list[np.ndarray] | None = None  # of Adam, while a fit goes on
    steps: int = 0

    @classmethod
    def start(cls, parts: int) -> Network:
        rng = np.random.default_rng(0)
        w = {n: rng.normal(0, 0.3, (WIDTH, WIDTH)) for n in ("query", "before", "own", "value")}
        w |= {"first": rng.normal(0, 0.5, (IDS, WIDTH)), "last": rng.normal(0, 0.5, (IDS, WIDTH))}
        w |= {"known": rng.normal(0, 0.5, (32, WIDTH)), "part": rng.normal(0, 0.5, (parts, WIDTH))}
        w |= {"gate": rng.normal(0, 0.1, (2 * WIDTH, 2 * parts + 1)), "bias": np.repeat([1.0, 0.0, -2.0], [parts, parts, 1])}
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.weights.values()]).astype(np.float64)

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """Parts of `flat` in the shapes of the weights."""
        edges = np.cumsum([v.size for v in self.weights.values()])[:-1]
        return {k: v.reshape(old.shape) for (k, old), v in zip(self.weights.items(), np.split(flat, edges))}

    def like(self, flat: np.ndarray) -> Network:
        """A network with the weights of `flat` in the shapes of this one."""
        return Network(self.views(flat.astype(np.float32)))

    def embed(self, rows: np.ndarray) -> np.ndarray:
        """Embeddings from the rows of `Sequence.features` in the four tables."""
        table = np.concatenate([self.weights[k] for k in _TABLES])
        return _embedded(table, rows)

    def forward(self, x: np.ndarray, before: np.ndarray, usable: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, ...]:
        """(weights of the mixture, probability of a copy, and what the gradient needs) for the last `TARGETS` places.

        x: embeddings of the places of each window; before: those of the places before them; usable: which places each
        target may look at; same: which of these hold the target's word, both as 0 and 1.
        """
        w = self.weights
        targets = np.ascontiguousarray(before[:, -TARGETS:])
        q = _times(targets, w["query"])
        k = _times(before, w["before"])
        k += _times(x, w["own"])
        scores = np.matmul(q, k.transpose(0, 2, 1))
        scores /= np.float32(WIDTH**0.5)
        np.clip(scores, -30, 30, out=scores)
        np.exp(scores, out=scores)
        scores *= usable
        total = _sums(scores)
        scores /= np.maximum(total, np.float32(1e-30))
        attention, copy = scores, np.einsum("ijk,ijk->ij", scores, same)
        values = _times(x, w["value"])
        inputs = np.concatenate((targets, np.matmul(attention, values)), axis=2)
        logits = _times(inputs, w["gate"])
        logits += w["bias"]
        logits[..., -1] = np.where(total[..., 0] > 0, logits[..., -1], -30)
        logits -= functools.reduce(np.maximum, np.moveaxis(logits, 2, 0))[..., None]
        gate = np.exp(logits, out=logits)
        gate /= _sums(gate)
        return gate, copy, attention, q, k, values, inputs


def _times(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """x @ w as one product of two matrices."""
    return (x.reshape(-1, x.shape[-1]) @ w).reshape(*x.shape[:-1], w.shape[1])


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums over the last axis, which stays; a product is faster than many short sums."""
    return _times(x, np.ones((x.shape[-1], 1), x.dtype))


def _embedded(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of the embeddings that the four `rows` of each entry name."""
    x = table.take(rows[0], axis=0)
    for row in rows[1:]:
        x += table.take(row, axis=0)
    return x


@dataclass
class Windows:
    """Places of a sequence of texts, in overlapping windows."""

    place: np.ndarray
    inside: np.ndarray

    @classmethod
    def over(cls, rows: np.ndarray) -> Windows:
        """Windows over texts whose first places, and the end, are `rows`."""
        count = -(-np.diff(rows) // TARGETS)
        start = np.repeat(rows[:-1], count) + TARGETS * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
        place = start[:, None] + np.arange(-CONTEXT, TARGETS)
        low, high = np.repeat(rows[:-1], count)[:, None], np.repeat(rows[1:], count)[:, None]
        return cls(place, (place >= low) & (place < high))


_CAUSAL = np.tril(np.ones((TARGETS, CONTEXT + TARGETS), np.float32), CONTEXT - 1)


def _inputs(word: np.ndarray, inside: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
    """What `forward` needs, from the words of the places and their embeddings."""
    x[~inside] = 0
    before = np.zeros_like(x)
    before[:, 1:] = x[:, :-1]
    usable = inside[:, None, :].astype(np.float32) * _CAUSAL
    same = (word[:, -TARGETS:, None] == word[:, None, :]).astype(np.float32)
    return x, before, usable, same


@dataclass
class Sequence:
    """The words of some texts, each followed by an end, and what the network and the mixture know of each entry.

    An entry is a distinct word, or a place where places with the same word differ in their counts.
    """

    word: np.ndarray  # equal at places with equal words
    rows: np.ndarray
    first: np.ndarray
    last: np.ndarray
    known: np.ndarray
    part: np.ndarray  # the most likely one of the word alone
    share: np.ndarray  # of the training words of each part
    spelt: np.ndarray  # log of the probability under each character model; that of an end is -inf
    entry: np.ndarray | None = None  # of each place; without it, each place is an entry
    form: np.ndarray | None = None  # of each entry in `first`, `last` and `spelt`; without it, the entry itself

    def __post_init__(self) -> None:
        if self.entry is None:
            self.entry = np.arange(len(self.word))

    @functools.cached_property
    def peak(self) -> np.ndarray:
        top = self.spelt.max(axis=1)
        return np.where(np.isfinite(top), top, 0.0)

    @functools.cached_property
    def spelling(self) -> np.ndarray:
        return np.exp(self.spelt - self.peak[:, None])  # so that mixtures need no logarithm for each part

    @functools.cached_property
    def spelt_as(self) -> np.ndarray:
        """The part whose character model finds a word most likely."""
        return self.spelt.argmax(axis=1)

    @functools.cached_property
    def probability(self) -> np.ndarray:
        return np.exp(self.spelt)

    @property
    def features(self) -> np.ndarray:
        """The rows of each entry in the four tables of embeddings, one behind the other."""
        first, last = (v if self.form is None else v[self.form] for v in (self.first, self.last))
        return np.stack((first, IDS + last, 2 * IDS + self.known, 2 * IDS + 32 + self.part))

    def place_counts(self, counts: np.ndarray, totals: np.ndarray) -> None:
        """Set what follows from the training counts of each entry, by part."""
        spelt_as = self.spelt_as if self.form is None else self.spelt_as[self.form]
        self.share = counts / np.maximum(totals, 1)
        self.known = np.minimum(np.log2(counts.sum(axis=1) + 1).astype(np.int64), 31)
        self.part = np.where(self.known > 0, self.share.argmax(axis=1), spelt_as)

    def by_place(self, first: int, stop: int) -> Sequence:
        """Texts `first` to `stop` with an entry for each place, without counts."""
        a, b = self.rows[first], self.rows[stop]
        word, nothing = self.word[a:b], np.zeros(0)
        out = Sequence(word, self.rows[first : stop + 1] - a, self.first, self.last, nothing, nothing, nothing, self.spelt, form=self.entry[a:b])
        out.spelt_as, out.probability = self.spelt_as, self.probability
        return out


def log_probabilities(network: Network, seq: Sequence, batch: int = 64) -> np.ndarray:
    """Natural log of the probability of each place; the entries of `seq` have forms of their own."""
    windows, out = Windows.over(seq.rows), np.zeros(len(seq.word))
    embedded, parts = network.embed(seq.features), seq.share.shape[1]
    for a in range(0, len(windows.place), batch):
        place, inside = windows.place[a : a + batch], windows.inside[a : a + batch]
        at = np.where(inside, place, 0)
        entry = seq.entry.take(at)
        gate, copy, *_ = network.forward(*_inputs(seq.word.take(at), inside, embedded.take(entry, axis=0)))
        scored = inside[:, -TARGETS:]
        target, gate = entry[:, -TARGETS:][scored], gate[scored].astype(np.float64)
        seen = (gate[:, :parts] * seq.share.take(target, axis=0)).sum(axis=1) + gate[:, -1] * copy[scored]
        spelt = (gate[:, parts:-1] * seq.spelling.take(target, axis=0)).sum(axis=1)
        with np.errstate(divide="ignore"):
            out[place[:, -TARGETS:][scored]] = np.logaddexp(np.log(seen), np.log(spelt) + seq.peak.take(target))
    return out


def train(seq: Sequence, steps: int = STEPS, network: Network | None = None) -> Network:
    """A network, or `network` itself, fitted to the words of `seq` by Adam, on windows in a fixed random order.

    Every window is taken as often as any other, give or take one, and once at least, whatever `steps` says.
    """
    network, windows = network or Network.start(seq.share.shape[1]), Windows.over(seq.rows)
    if not len(windows.place):
        return network
    rng = np.random.default_rng(1)
    steps = max(steps, -(-len(windows.place) // BATCH))
    turns = -(-steps * BATCH // len(windows.place))
    picks = np.concatenate([rng.permutation(len(windows.place)) for _ in range(turns)])[: steps * BATCH]
    # All weights are one array, so that Adam takes a few operations for all of them.
    weights = network.flat().astype(np.float32)
    w = network.weights = network.views(weights)
    if network.moments is None:
        network.moments = [np.zeros_like(weights), np.zeros_like(weights)]
    m, v = network.moments
    g = np.zeros_like(weights)
    grads = network.views(g)
    low = sum(w[k].size for k in ("query", "before", "own", "value"))
    tables = slice(low, low + sum(w[k].size for k in _TABLES))
    table, g_table, across = weights[tables].reshape(-1, WIDTH), g[tables], np.arange(WIDTH)
    features, form = seq.features, seq.entry if seq.form is None else seq.form[seq.entry]
    scale_of = np.float32(WIDTH**0.5)
    flat = lambda x: x.reshape(-1, x.shape[-1])
    for pick in np.array_split(picks, steps):
        network.steps += 1
        step = network.steps
        place, inside = windows.place[pick], windows.inside[pick]
        place = np.where(inside, place, 0)
        at = seq.entry.take(place)
        rows = features.take(at, axis=1)
        x, before, usable, same = _inputs(seq.word.take(place), inside, _embedded(table, rows))
        gate, copy, attention, q, k, values, inputs = network.forward(x, before, usable, same)
        scored = inside[:, -TARGETS:].astype(np.float32)
        share, spelt = seq.share.take(at[:, -TARGETS:], axis=0), seq.probability.take(form.take(place[:, -TARGETS:]), axis=0)
        parts = np.concatenate((share, spelt, copy[..., None]), axis=2)
        mixed = np.maximum(_sums(gate * parts)[..., 0], 1e-30)
        scale = (scored / scored.sum() / mixed).astype(np.float32)[..., None]
        # Backwards from the mean negative log of the mixture.
        d_logits = -(gate * (parts - mixed[..., None])).astype(np.float32) * scale
        d_copy = -gate[..., -1].astype(np.float32) * scale[..., 0]
        d_inputs = _times(d_logits, w["gate"].T)
        d_h = np.ascontiguousarray(d_inputs[..., WIDTH:])
        d_scores = np.matmul(d_h, values.transpose(0, 2, 1))
        same *= d_copy[..., None]
        d_scores += same
        d_scores -= _sums(d_h * inputs[..., WIDTH:]) + (d_copy * copy)[..., None]  # the mean under the attention
        d_scores *= attention
        d_scores /= scale_of
        d_values = np.matmul(attention.transpose(0, 2, 1), d_h)
        d_q, d_k = np.matmul(d_scores, k), np.matmul(d_scores.transpose(0, 2, 1), q)
        np.matmul(flat(inputs).T, flat(d_logits), out=grads["gate"])
        grads["bias"][:] = flat(d_logits).sum(axis=0)
        np.matmul(flat(x).T, flat(d_values), out=grads["value"])
        np.matmul(flat(inputs)[:, :WIDTH].T, flat(d_q), out=grads["query"])
        np.matmul(flat(before).T, flat(d_k), out=grads["before"])
        np.matmul(flat(x).T, flat(d_k), out=grads["own"])
        d_before = _times(d_k, w["before"].T)
        d_before[:, -TARGETS:] += _times(d_q, w["query"].T) + d_inputs[..., :WIDTH]
        d_x = _times(d_k, w["own"].T) + _times(d_values, w["value"].T)
        d_x[:, :-1] += d_before[:, 1:]
        d_x[~inside] = 0
        g_table[:] = 0
        slots, d_x = (rows.reshape(4, -1, 1) * WIDTH + across).reshape(4, -1), d_x.ravel()
        for slot in slots:
            np.add.at(g_table, slot, d_x)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        weights -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return network


def _word_hashes(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words with an end after each text, first of each text and their number)."""
    out_rows = rows + np.arange(len(rows))
    out = np.full(out_rows[-1], END, np.uint64)
    own = np.ones(len(out), bool)
    own[out_rows[1:] - 1] = False
    out[own] = words
    return out, out_rows


def _subwords(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, tokenizer: str) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last subword id of each word, from one encoding of all words with spaces before them."""
    size = ends - starts + 1
    edge = np.concatenate(([0], np.cumsum(size)))
    text = np.full(edge[-1], 0x20, np.uint8)
    place = np.arange(edge[-1]) - np.repeat(edge[:-1], size)
    body = place > 0
    text[body] = data[(np.repeat(starts, size) + place - 1)[body]]
    codec = encoder(tokenizer).fast
    ids = np.array(codec.encode_ordinary(text.tobytes().decode()), np.int64)
    distinct, inverse = np.unique(ids, return_inverse=True)
    length = np.array([len(codec.decode_single_token_bytes(i)) for i in distinct.tolist()], np.int64)[inverse]
    at = np.cumsum(length) - length
    owner = np.searchsorted(edge, at, side="right") - 1
    first = np.searchsorted(owner, np.arange(len(starts)))
    last = np.searchsorted(owner, np.arange(len(starts)), side="right") - 1
    # A token can begin inside a word only, so each word has one that begins at its space.
    return ids[np.minimum(first, len(ids) - 1)], ids[np.maximum(last, 0)]


@dataclass
class Scorer:
    spelling: list[Model | None]  # of each part
    network: Network | None
    totals: np.ndarray  # training tokens of each part
    distinct: int
    tokenizer: str

    def sequence(self, data: np.ndarray, offsets: np.ndarray, words: np.ndarray, counts: np.ndarray) -> tuple[Sequence, np.ndarray]:
        """(the texts' words, the training counts of each entry), from the ascending words of a block and their counts.

        Entries are the distinct words in the order of their hashes, and the end as the last.
        """
        found = Words(data, offsets, True)
        n, parts = len(found.hashes), len(self.totals)
        rows = found.rows + np.arange(len(found.rows))
        word = np.full(rows[-1], n, np.int32)
        own = np.ones(len(word), bool)
        own[rows[1:] - 1] = False
        word[own] = found.word
        first, last = np.zeros((2, n + 1), np.int64)
        spelt = np.full((n + 1, parts), -np.inf)
        if n:
            first[:n], last[:n] = _subwords(lower(data), found.starts, found.ends, self.tokenizer)
            plain = -6.0 * (found.ends - found.starts) - 6
            for k, model in enumerate(self.spelling):
                spelt[:n, k] = found.per_word(model.log10(found.grams)) * np.log(10) if model else plain
        c = np.zeros((n + 1, parts), np.int64)
        if len(words):
            wanted = np.append(found.hashes, END)
            at = np.minimum(np.searchsorted(words, wanted), len(words) - 1)
            c = counts[at] * (words[at] == wanted)[:, None]
        nothing = np.zeros(0)
        seq = Sequence(word, rows, first % IDS, last % IDS, nothing, nothing, nothing, spelt, word)
        seq.place_counts(c, self.totals)
        return seq, c

    def training_sequences(
        self, column: pa.ChunkedArray, part: np.ndarray, words: np.ndarray, counts: np.ndarray, size: int
    ) -> Iterator[tuple[int, Sequence]]:
        """(number of texts, the same) of pieces of so many bytes of training texts, all texts together looked up once.

        Words have the counts that the training texts other than their own give them. part: that of each text.
        """
        _, _, data, offsets = next(blocks(column, 1 << 62))
        seq, c = self.sequence(data, offsets, words, counts)
        end = len(c) - 1
        for first, stop, _, _ in blocks(column, size):
            own = seq.by_place(first, stop)
            n = c.take(own.form, axis=0)
            row = np.repeat(np.arange(stop - first), np.diff(own.rows))
            # A text outside the training does not have its own words among the counts.
            inverse = pa.array(row * (end + 1) + own.word).dictionary_encode().indices.to_numpy()
            n[np.arange(len(n)), part[first:stop][row]] -= np.where(own.word == end, 0, np.bincount(inverse)[inverse])
            own.place_counts(np.maximum(n, 0), self.totals)
            yield stop - first, own

    def scores(self, data: np.ndarray, offsets: np.ndarray, words: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
        """n_tokens, n_known, base_score and score of each text."""
        seq, c = self.sequence(data, offsets, words, counts)
        starts, c = seq.rows[:-1], c.sum(axis=1)
        base = np.log10((c + 0.5) / (self.totals.sum() + 0.5 * (self.distinct + 1)))[seq.entry]
        # An end that training has not seen, as without any training text, is left to the base.
        value = log_probabilities(self.network, seq) / np.log(10)
        value = np.where(np.isfinite(value), value, base)
        known = (c > 0).astype(np.int64)[seq.entry]
        return [np.diff(seq.rows), *(np.add.reduceat(v, starts) for v in (known, base, value))]


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the number of their block; blocks do not cross tasks."""
    number, size = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        for first, stop, data, _ in blocks(batch.column(1), BLOCK_BYTES // 8):
            if size and size + len(data) > BLOCK_BYTES:
                number, size = number + 1, 0
            size += len(data)
            columns = [batch.column(i).slice(first, stop - first) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(stop - first, number))], [c.split()[0] for c in _BLOCKS.split(", ")])


def _count_column(n: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * n.shape[1], pa.int32()), pa.array(n.ravel()))


def _counts_of(column: pa.ChunkedArray, parts: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, parts)


def _vocabulary(parts: int):
    """The distinct words, and the end, of each block in a task and how often training texts of each part have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = [], None

        def flush() -> pa.RecordBatch:
            word, _, inverse = distinct(np.concatenate([h[0] for h in held]))
            n = np.zeros((len(word), parts), np.int64)
            np.add.at(n, inverse, np.concatenate([h[1] for h in held]))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(word), of)), pa.array(word.view(np.int64)), _count_column(n)], ["block", "word", "n"]
            )

        for batch in batches:
            for first, stop, data, offsets in blocks(batch.column(1), BLOCK_BYTES // 8):
                numbers, part = (batch.column(i).slice(first, stop - first).to_numpy(zero_copy_only=False) for i in (3, 2))
                folded = lower(data)
                starts, ends, rows = word_spans(folded, offsets)
                word, rows = _word_hashes(span_hashes(folded, starts, ends), rows)
                row = np.repeat(np.arange(stop - first), np.diff(rows))
                for number in np.unique(numbers).tolist():
                    if of not in (None, number):
                        yield flush()
                        held = []
                    of, own = number, numbers[row] == number
                    found, _, inverse = distinct(word[own])
                    in_part = part[row][own]
                    slot = inverse[in_part >= 0] * parts + in_part[in_part >= 0]
                    held.append((found, np.bincount(slot, minlength=len(found) * parts).reshape(-1, parts)))
        if held:
            yield flush()

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, word, n) with the words of a block in a task, or in a part of it, as one row."""
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).sort_by("block").combine_chunks()
        block = table.column("block").to_numpy()
        first = np.flatnonzero(np.diff(block, prepend=block[0] - 1))
        edges = pa.array(np.append(first, len(block)), pa.int32())
        word, n = (table.column(c).combine_chunks() for c in ("word", "n"))
        counts = n.flatten()
        each = pa.array(np.append(first, len(block)) * (len(counts) // len(block)), pa.int32())
        columns = [pa.array(block[first]), pa.ListArray.from_arrays(edges, word), pa.ListArray.from_arrays(each, counts)]
        return pa.RecordBatch.from_arrays(columns, ["block", "word", "n"])

    for batch in batches:
        if len(batch):
            held, size = [*held, batch], size + len(batch)
        if size >= PACKED:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _by_word(counted: pa.Table, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of a block, ascending, and their counts, from rows of `_packed`."""
    words, n = counted.column("word").combine_chunks().flatten().to_numpy().view(np.uint64), _counts_of(counted.column("n"), parts)
    order = np.argsort(words)
    return words[order], n[order]


def fit_network(texts: DataFrame, with_counts: DataFrame, scorer: Scorer) -> tuple[Network, int]:
    """(the network fitted to all training texts of the blocks, the number of their windows).

    Each block fits to every window of its training texts; the mean of the fits weighs them by their windows.
    """
    context, parts = texts.sparkSession.sparkContext, len(scorer.totals)
    texts = texts.filter("part >= 0")
    shared = context.broadcast(scorer)

    def mean_of(texts: DataFrame, counts: DataFrame, start: Network, steps: int) -> tuple[Network, int]:
        def run(texts: pa.Table, counted: pa.Table) -> pa.Table:
            if not len(texts):
                return pa.table({"windows": pa.array([], pa.int64()), "weights": pa.array([], pa.list_(pa.float64()))})
            words, n = _by_word(counted, parts)
            part = texts.column("part").to_numpy()
            network, windows = start.like(start.flat()), 0
            for count, seq in shared.value.training_sequences(texts.column("text"), part, words, n, BLOCK_BYTES // 8):
                share = -(-steps * count // len(texts))
                network = train(seq, share, network)
                windows += len(Windows.over(seq.rows).place)
            return pa.table({"windows": [windows], "weights": pa.array([network.flat()], pa.list_(pa.float64()))})

        fits = texts.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(run, _FITS)
        # Added up by Spark: a second operator in Python would hold a second worker for each running task.
        each = fits.select("windows", F.posexplode("weights").alias("at", "weight"))
        sums = each.groupBy("at").agg(F.sum("windows").alias("windows"), F.sum(F.col("windows") * F.col("weight")).alias("total"))
        sums = sums.toArrow().sort_by("at")
        if not len(sums):
            return start, 0
        windows = sums.column("windows")[0].as_py()
        return start.like(sums.column("total").to_numpy() / windows), windows

    first = [r["block"] for r in texts.select("block").distinct().orderBy(F.xxhash64("block")).limit(WARM).collect()]
    own = F.col("block").isin(first)
    network, _ = mean_of(texts.filter(own), with_counts.filter(own), Network.start(parts), STEPS)
    network, windows = mean_of(texts, with_counts, network, 0)
    shared.unpersist()
    return network, windows


def score(
    docs: DataFrame,
    training: Column,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens (long), base_score and score (double).

    `training` is a condition on `docs`, null counts as false; `lang_col` tells the languages of the training texts
    apart, and is not looked at when a text is scored. Tokens are the words, A-Z as a-z, and one end. base_score
    sums the smoothed share of each token among the training tokens, score is the model's log10 probability of the
    text. A null or empty text is its end alone; repeated rows each give a row, ids may be null. Without training text
    every count is 0 and score uses a fixed spelling. Acts at once: blocks and counts are stored.
    """
    rounds = Rounds(docs.sparkSession)
    texts = docs.select(
        quoted(id_col).cast("long").alias("doc_id"),
        F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(training, F.lit(False)).alias("training"),
        F.coalesce(quoted(lang_col).cast("string") if lang_col else F.lit(""), F.lit("")).alias("lang"),
    )
    langs = texts.filter("training").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(PARTS - 1).collect()
    langs = [r["lang"] for r in langs]
    parts = len(langs) + 1  # the last one is that of all other languages
    number = F.lit(len(langs))
    for i, lang in enumerate(langs):
        number = F.when(F.col("lang") == lang, i).otherwise(number)
    texts = texts.select("doc_id", "text", F.when(F.col("training"), number).otherwise(-1).cast("int").alias("part"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # In buckets of blocks, texts and counts meet as often as needed without a shuffle.
    buckets = min(max(1, -(-size // BLOCK_BYTES)), BUCKETS)
    dealt = rounds.store_bucketed(texts.mapInArrow(_deal, _BLOCKS), "blocks", "block", buckets)
    vocabulary = rounds.store(dealt.mapInArrow(_vocabulary(parts), _VOCABULARY), "vocabulary")
    counts = vocabulary.groupBy("word").agg(F.array(*(F.sum(F.col("n")[k]) for k in range(parts))).alias("n"))
    counts = rounds.store(counts.filter(F.exists("n", lambda x: x > 0)), "counts")
    sums = counts.agg(F.count(F.lit(1)), *(F.coalesce(F.sum(F.col("n")[k]), F.lit(0)) for k in range(parts))).first()
    rounds.drop()
    with_counts = vocabulary.select("block", "word").join(counts.hint("merge"), "word").select("block", "word", "n")
    packed = with_counts.mapInArrow(_packed, _PACKED).repartition(buckets, "block")
    with_counts = rounds.store_bucketed(packed, "block-counts", "block", buckets)
    del vocabulary, counts, packed
    rounds.drop("vocabulary", "counts")
    spelling = estimate(rounds, count_grams(dealt.filter("part >= 0").select(F.col("part").cast("string").alias("part"), "text"), fold=True))
    scorer = Scorer([spelling.get(str(k)) for k in range(parts)], None, np.array(sums[1:], np.int64), sums[0], tokenizer)
    scorer.network, _ = fit_network(dealt, with_counts, scorer)
    rounds.drop()
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # bounded by the n-grams of the character model

    def run(texts: pa.Table, counted: pa.Table) -> pa.Table:
        words, n = _by_word(counted, parts)
        ids = texts.column("doc_id").combine_chunks()
        out = []
        for first, stop, data, offsets in blocks(texts.column("text"), BLOCK_BYTES):
            columns = [ids.slice(first, stop - first), *map(pa.array, shared.value.scores(data, offsets, words, n))]
            out.append(pa.table(columns, [c.split()[0] for c in _SCORES.split(", ")]))
        return pa.concat_tables(out) if out else pa.table({c.split()[0]: pa.array([], pa.float64() if "double" in c else pa.int64()) for c in _SCORES.split(", ")})

    scored = dealt.groupBy("block").cogroup(with_counts.groupBy("block")).applyInArrow(run, _SCORES)
    return scored.withColumn("train_tokens", F.lit(int(scorer.totals.sum())).cast("long"))
