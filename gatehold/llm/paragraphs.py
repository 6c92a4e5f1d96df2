"""Removing paragraphs that repeat, exactly or nearly, within and across documents, and long passages inside of them.

A paragraph is a line of `MIN_WORDS` words or more. Its 5-word shingles get MinHash values whose bands are hashed;
paragraphs that collide in a band are candidates, and the exact Jaccard similarity of their shingle sets decides. Of each
component of similar paragraphs the first one stays. Paragraphs with equal sets are one class, so copies are only counted.

Not all pairs of a bucket are written. Each bucket is compared with its centre, the class that collides most. Classes
that lead to the same class by links then need no more comparisons with each other. Pairs with one of the others are found
by their differences from the centre: sets whose differences are many, together, are only similar if they share about half
of them, so the two share one of the first few in an order that has the shingles the centre lacks first. Lists of classes
by these few are joined, parity sketches pass over most pairs, the others are compared. So in the end two similar classes
of a bucket have been compared or are in one component, whatever the bucket's size.

A passage inside a line is found by windows of words that its content chooses: of `WINDOW` windows in a row the one with the
least hash. Documents that share `2 * WINDOW - 1` words or more in a row share a chosen window, and in a shared passage
chosen windows leave no gaps; at its two ends fewer than `WINDOW` words each may stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatehold.llm.columns import documents, extended, fresh, quoted
from gatehold.llm.graph import components
from gatehold.llm.ngram_join import classes_of, sets_of, sketches
from gatehold.llm.rolling import blocks, mix, row_of, shingles, word_hashes, word_spans
from gatehold.llm.storage import Rounds

WIDTH = 5
SIMILARITY = Fraction(4, 5)
MIN_WORDS = 20  # shorter lines are headings or stock sentences, which good documents share
WINDOW = 25
# At a similarity of 0.8, 1 - (1 - 0.8 ** ROWS) ** BANDS = 99.6 % of the pairs collide.
BANDS = 14
ROWS = 5
_SKETCH = 4  # words of 64 bits

_SETS = "class long, size long, shingles array<long>, " + ", ".join(f"s{i} long" for i in range(_SKETCH))
_CHOSEN = "doc_id long, at int, window long"
_PARAGRAPHS = "doc_id long, paragraph int, class long, size long, bands array<long>"


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets of all lines and the end, the row of each line, its number in the row); a row without bytes has none."""
    breaks = np.flatnonzero(data == 0x0A) + 1
    starts = np.union1d(offsets[:-1][offsets[:-1] < offsets[1:]], breaks[breaks < len(data)])
    row = np.searchsorted(offsets, starts, side="right") - 1
    # An empty line that ends a row starts where the next row does; it has no words and is left out.
    first = np.searchsorted(starts, offsets[row])
    return np.append(starts, len(data)), row, np.arange(len(starts)) - first


def minhash_bands(values: np.ndarray, rows: np.ndarray, bands: int = BANDS, per_band: int = ROWS) -> np.ndarray:
    """Band hashes of each non-empty set, one row for a set."""
    starts = rows[:-1]
    out = np.zeros((len(starts), bands), np.uint64)
    seeds = mix(np.arange(1, bands * per_band + 1, dtype=np.uint64))
    for b in range(bands):
        total = np.full(len(starts), b + 1, np.uint64)
        for seed in seeds[b * per_band : (b + 1) * per_band]:
            # A product with an odd number, folded; equal minima mean equal shingles.
            hashed = (values ^ seed) * (seed | np.uint64(1))
            hashed ^= hashed >> np.uint64(32)
            total = mix(total + np.minimum.reduceat(hashed, starts))
        out[:, b] = total
    return out


def _emit_paragraphs(width: int, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for first, stop, data, offsets in blocks(batch.column(1)):
                at, row, number = lines(data, offsets)
                _, _, word_rows = word_spans(data, at)
                values, _, rows = sets_of(data, at, width)
                keep = np.diff(word_rows) >= min_words  # shorter lines are no paragraphs
                size = np.diff(rows)
                classes = classes_of(values, row_of(rows), size)
                new = keep & np.array([not (c in seen or seen.add(c)) for c in np.where(keep, classes, 0).tolist()], bool)
                bands: list = [None] * len(size)
                picked = np.flatnonzero(new)
                if len(picked):
                    flat = np.concatenate([values[rows[i] : rows[i + 1]] for i in picked])
                    ends = np.concatenate(([0], np.cumsum(size[picked])))
                    for i, hashes in zip(picked.tolist(), minhash_bands(flat, ends).view(np.int64).tolist()):
                        bands[i] = hashes
                ids = batch.column(0).take(pa.array(first + row))
                columns = [ids, pa.array(number.astype(np.int32)), pa.array(classes), pa.array(size), pa.array(bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    columns, [c.split()[0] for c in _PARAGRAPHS.split(", ")]
                ).filter(pa.array(keep))

    return run


def chosen_windows(hashes: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    """Indexes of the hashes that are the least of `width` in a row, all within one row; a shorter row has none."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    least, reach = hashes, 1
    while reach < width:  # least[i] is that of hashes[i : i + reach]
        step = min(reach, width - reach)
        least, reach = np.minimum(least[: len(least) - step], least[step:]), reach + step
    starts = np.arange(len(least))
    starts = starts[starts + width <= rows[1:][np.searchsorted(rows, starts, side="right") - 1]]
    picked = np.zeros(len(hashes), bool)
    for i in range(width):
        picked[starts[hashes[starts + i] == least[starts]] + i] = True
    return np.flatnonzero(picked)


def _emit_windows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, offsets in blocks(batch.column(1)):
                words, word_rows = word_hashes(data, offsets)
                hashes, rows = shingles(words, word_rows, width)
                at = chosen_windows(hashes, rows, width)
                row = np.searchsorted(rows, at, side="right") - 1
                ids = batch.column(0).take(pa.array(first + row))
                columns = [ids, pa.array((at - rows[row]).astype(np.int32)), pa.array(hashes[at].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "at", "window"])

    return run


def repeated_windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """(doc_id, at) of chosen windows that also stand in a document with a smaller id: `width` words from word `at` on.

    Documents without an id take no part. Acts at once.
    """
    rounds = Rounds(docs.sparkSession)
    rows = rounds.store(docs.filter("doc_id is not null").mapInArrow(_emit_windows(width), _CHOSEN), "windows")
    shared = rows.groupBy("window").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = shared.filter("least < most").select("window", "least")
    found = rounds.store(rows.join(shared, "window").filter("doc_id > least").select("doc_id", "at").distinct(), "passages")
    del rows, shared
    rounds.drop("windows")
    return found


def _pick_sets(width: int):
    """Rows (class, size, shingles) of the wanted lines of each text; a line that is of another class is passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, classes = [], []
            for text, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = (text or "").split("\n")
                for i in items:
                    if i["paragraph"] < len(parts):
                        texts.append(parts[i["paragraph"]])
                        classes.append(i["class"])
            for first, stop, data, offsets in blocks(pa.array(texts, pa.string())):
                values, _, rows = sets_of(data, offsets, width)
                size = np.diff(rows)
                wanted = np.array(classes[first:stop], np.int64)
                same = classes_of(values, row_of(rows), size) == wanted
                sets = pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(values.view(np.int64)))
                bits = sketches(values, row_of(rows), len(size))
                # Parities fold into fewer.
                bits = np.bitwise_xor.reduce(bits.reshape(len(size), -1, _SKETCH), axis=1).view(np.int64)
                columns = [pa.array(wanted), pa.array(size), sets, *(pa.array(np.ascontiguousarray(b)) for b in bits.T)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SETS.split(", ")]).filter(pa.array(same))

    return run


def _verified(pairs: DataFrame, sets: DataFrame, j: Fraction) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough."""
    own = sets.select("class", "size", "shingles")
    joined = pairs.join(own.toDF("u", "u_size", "u_set"), "u").join(own.toDF("v", "v_size", "v_set"), "v")
    both = F.size(F.array_intersect("u_set", "v_set")).cast("long")
    alike = both * j.denominator >= (F.col("u_size") + F.col("v_size") - both) * j.numerator
    return joined.filter(alike).select("u", "v")


def _leaders(rounds: Rounds, links: DataFrame, label: str) -> DataFrame:
    """(class, component) for links (u, v): the least class in two steps, the same for all that are linked with one centre."""
    both = links.union(links.select("v", "u")).toDF("u", "v")
    near = rounds.store(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "near")
    found = both.join(near.toDF("v", "m"), "v").groupBy(F.col("u").alias("class")).agg(F.min("m").alias("component"))
    found = rounds.store(found, label)
    del near
    rounds.drop("near")
    return found


def _compared(pairs: DataFrame, sets: DataFrame, d: Fraction) -> DataFrame:
    """Pairs (u, v) of a class and its centre with `away`, the number of shingles in one of both only, `alike`, and `first`
    and `all`: how many of them a similar class may have to share one of, if it is or is not among those linked with v.

    `differences` are the first `all` of these shingles, those that v lacks before those that u lacks, each in the order of sets.
    """
    own = sets.select("class", "size", "shingles")
    joined = pairs.join(sets.withColumnsRenamed({"class": "u", "shingles": "u_set"}), "u").join(own.toDF("v", "v_size", "v_set"), "v")
    joined = joined.withColumn("both", F.concat(F.array_except("u_set", "v_set"), F.array_except("v_set", "u_set")))
    away, num, den = F.size("both").cast("long"), d.numerator, d.denominator
    over = away * den - (F.col("size") + F.col("v_size")) * num
    # Similar sets share half of what their differences have over the limit; one of the two is not similar to v.
    first = away + 1 - F.ceil((away * den + (F.col("v_size") - F.col("size")) * num + 1) / (2 * den))
    most = F.when(over <= 0, first).otherwise(away + 1 - F.ceil(over / (2 * den)))
    joined = joined.select(
        "u", "v", "size", away.alias("away"), (over <= 0).alias("alike"), first.cast("int").alias("first"),
        most.cast("int").alias("all"), "both", *(f"s{i}" for i in range(_SKETCH)),
    )
    return joined.withColumn("differences", F.slice("both", 1, F.greatest("all", "first"))).drop("both")


def _candidates(rounds: Rounds, members: DataFrame, compared: DataFrame, d: Fraction) -> DataFrame:
    """(u, v), possibly similar classes of a bucket that do not lead to the same class, one at least not to the centre's.

    From members (band, class, v, component, weight of the component, outside: whether that is not the centre's).
    """
    num, den = d.numerator, d.denominator
    kept = F.when(F.col("outside"), F.col("all")).otherwise(F.col("first"))
    items = members.join(compared.withColumnRenamed("u", "class"), ["class", "v"]).withColumn("kept", kept)
    items = items.select(
        "band", "class", "component", "weight", "outside", "size", "away", "first", *(f"s{i}" for i in range(_SKETCH)),
        F.posexplode(F.slice("differences", F.lit(1), F.greatest(F.lit(0), "kept"))).alias("at", "shingle"),
    )
    items = rounds.store(items.withColumn("first", F.col("at") < F.col("first")), "differences")
    lists = items.groupBy("band", "shingle").agg(
        F.min("component").alias("least"), F.max("component").alias("most"),
        F.max(F.when(F.col("outside"), F.struct("weight", "component"))).alias("main"),
    )
    lists = lists.filter("least < most and main is not null").select("band", "shingle", F.col("main.component").alias("main"))
    lists = rounds.store(lists, "lists")
    items = rounds.store(items.join(lists, ["band", "shingle"]).drop("weight"), "listed")
    del lists
    rounds.drop("differences", "lists")
    other = items.withColumnsRenamed({c: f"v_{c}" for c in items.columns if c not in ("band", "shingle")})
    sizes = F.col("size") + F.col("v_size")
    apart = sum((F.bit_count(F.col(f"s{i}").bitwiseXOR(F.col(f"v_s{i}"))) for i in range(1, _SKETCH)), F.bit_count(F.col("s0").bitwiseXOR(F.col("v_s0"))))
    over = (F.col("away") + F.col("v_away")) * den - sizes * num
    fits = (
        (F.col("component") != F.col("v_component"))
        & ((F.col("away") - F.col("at")) * (2 * den) >= over)
        & ((F.col("v_away") - F.col("v_at")) * (2 * den) >= over)
        & (apart * den <= sizes * num)
    )
    outside = items.filter("outside")

    def found(searching: DataFrame, among: DataFrame) -> DataFrame:
        joined = searching.drop("main").join(among.drop("v_main"), ["band", "shingle"]).filter(fits)
        return joined.select(F.greatest("class", "v_class").alias("u"), F.least("class", "v_class").alias("v"))

    # Of a list's greatest component outside, members need not look for each other, only be found.
    among_others = found(outside.filter("first and component != main"), other.filter("v_outside and v_first"))
    pairs = among_others.union(found(outside, other.filter("not v_outside"))).distinct()
    pairs = rounds.store(pairs, "candidates")
    del items, other, outside
    rounds.drop("listed")
    return pairs


def _bucket_components(rounds: Rounds, buckets: DataFrame, sets: DataFrame, j: Fraction) -> DataFrame:
    """(node, component) over the similar pairs of classes among buckets (band, class, size, weight)."""
    d = (1 - j) / (1 + j)
    centres = buckets.groupBy("band").agg(F.max(F.struct("weight", "class")).alias("best")).select("band", F.col("best.class").alias("v"))
    centres = rounds.store(centres, "centres")
    pairs = buckets.join(centres, "band").filter("class != v").select(F.col("class").alias("u"), "v").distinct()
    compared = rounds.store(_compared(rounds.store(pairs, "pairs"), sets, d), "compared")
    links = compared.filter("alike").select("u", "v")
    known = _leaders(rounds, links, "leaders")
    weights = known.groupBy("component").agg(F.count(F.lit(1)).alias("weight"))
    known = rounds.store(known.join(weights, "component"), "weighted")
    state = buckets.select("band", "class").join(known, "class", "left")
    state = state.select("band", "class", F.coalesce("component", "class").alias("component"), F.coalesce("weight", F.lit(1)).alias("weight"))
    state = rounds.store(state, "state")
    del pairs, known, weights
    rounds.drop("pairs", "leaders", "weighted")
    own = state.join(centres, "band")
    main = F.max(F.when(F.col("class") == F.col("v"), F.col("component"))).alias("main")
    opened = own.groupBy("band", "v").agg(main, F.min("component").alias("least"), F.max("component").alias("most"))
    opened = rounds.store(opened.filter("least < most").select("band", "v", "main"), "open")
    members = state.join(opened, "band").withColumn("outside", F.col("component") != F.col("main")).drop("main")
    more = rounds.store(_verified(_candidates(rounds, members, compared, d), sets, j), "more-links")
    links = rounds.store(links.union(more), "links")
    del centres, state, own, opened, members, more, compared
    rounds.drop("centres", "state", "open", "candidates", "more-links", "compared")
    known = _leaders(rounds, links, "leaders")
    # Most links are within one leader's class by now; only those between leaders are left to follow.
    ends = known.select("class", "component")
    between = links.join(ends.toDF("u", "a"), "u").join(ends.toDF("v", "b"), "v").filter("a != b").select("a", "b")
    top = components(between.toDF("u", "v"), rounds, "components").toDF("component", "top")
    return known.join(top, "component", "left").select(F.col("class").alias("node"), F.coalesce("top", "component").alias("component"))


def repeated_paragraphs(
    docs: DataFrame, width: int = WIDTH, similarity: Fraction = SIMILARITY, min_words: int = MIN_WORDS
) -> DataFrame:
    """(doc_id, paragraph) of the lines that are not the first of their component, from documents (doc_id, text).

    Lines are numbered from 0 in their document; the first of a component is the one with the least document id, then
    number. Documents without an id take no part. Acts at once.
    """
    rounds = Rounds(docs.sparkSession)
    docs = docs.filter("doc_id is not null")
    rows = rounds.store(docs.mapInArrow(_emit_paragraphs(width, max(min_words, width)), _PARAGRAPHS), "paragraphs")
    bands = rows.select("class", "size", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("class").alias("least"), F.max("class").alias("most"), F.count(F.lit(1)).alias("n"))
    shared = rounds.store(shared.filter("least < most").select("band", "n"), "shared")
    # Tasks that meet a class each give its bands, so a class may be there more than once until here.
    buckets = rounds.store(bands.join(shared, "band").groupBy("band", "class", "size").agg(F.max("n").alias("n")), "colliding")
    weights = buckets.groupBy("class").agg(F.sum("n").alias("weight"))
    buckets = rounds.store(buckets.drop("n").join(weights, "class"), "buckets")
    del bands, shared, weights
    rounds.drop("shared", "colliding")
    kept = rounds.store(rows.select("doc_id", "paragraph", "class"), "lines")
    del rows
    rounds.drop("paragraphs")
    first = F.min(F.struct("doc_id", "paragraph")).alias("first_id")
    classes = rounds.store(kept.groupBy("class").agg(first), "classes")
    wanted = classes.join(buckets.select("class").distinct(), "class")
    item = F.struct(F.col("first_id.paragraph").alias("paragraph"), "class")
    by_doc = wanted.groupBy(F.col("first_id.doc_id").alias("doc_id")).agg(F.collect_list(item).alias("items"))
    texts = docs.join(by_doc.hint("merge"), "doc_id").select("text", "items")
    sets = rounds.store(texts.mapInArrow(_pick_sets(width), _SETS).dropDuplicates(["class"]), "sets")
    found = _bucket_components(rounds, buckets, sets, similarity).withColumnRenamed("node", "class")
    joined = classes.join(found, "class", "left").select("class", "first_id", F.coalesce("component", "class").alias("component"))
    joined = rounds.store(joined, "joined")
    least = joined.groupBy("component").agg(F.min("first_id").alias("stays"))
    least = rounds.store(joined.join(least, "component").select("class", "stays"), "stays")
    result = kept.join(least, "class").filter(F.struct("doc_id", "paragraph") != F.col("stays")).select("doc_id", "paragraph")
    result = rounds.store(result.distinct(), "repeated")
    del kept, classes, wanted, by_doc, texts, sets, buckets, found, joined, least
    rounds.clear("repeated")
    return result


def _without(text: bytes, at: np.ndarray, cut: set[int], width: int) -> tuple[str, int]:
    """(the text without the lines of `cut` and the windows that start at words `at`, number of runs of words cut from other lines)."""
    data = np.frombuffer(text, np.uint8)
    ends = np.append(np.flatnonzero(data == 0x0A), len(data))
    starts = np.append(0, ends[:-1] + 1)
    gone = np.zeros(len(data) + 1, bool)
    first, last, _ = word_spans(data, np.array([0, len(data)]))
    at = np.sort(at[at + width <= len(first)])  # rows that share an id may be shorter
    cover = np.zeros(len(first) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + width, -1)
    covered = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
    line = np.searchsorted(ends, first[covered])
    own = ~np.isin(line, np.fromiter(cut, np.int64, len(cut)))
    covered, line = covered[own], line[own]
    # A run ends where a word or the line does.
    head = np.ones(len(covered), bool)
    head[1:] = (np.diff(covered) > 1) | (np.diff(line) > 0)
    tail = np.append(head[1:], True)[: len(head)]
    for b, e in zip(first[covered[head]].tolist(), last[covered[tail]].tolist()):
        gone[b:e] = True
    kept = [data[b:e][~gone[b:e]].tobytes() for i, (b, e) in enumerate(zip(starts.tolist(), ends.tolist())) if i not in cut]
    return b"\n".join(kept).decode("utf-8"), int(head.sum())


def remove_paragraphs(
    docs: DataFrame,
    width: int = WIDTH,
    similarity: Fraction = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    window: int | None = WINDOW,
) -> DataFrame:
    """All rows and columns of `docs` with n_paragraphs, n_removed (long), removed (line numbers), n_passages (long) and kept_text.

    Lines with fewer than `min_words` words, or than `width`, are no paragraphs. Repeated paragraphs go as a whole. From lines
    that stay, windows of `window` words that a document with a smaller id has too are cut (none if None); n_passages is the
    number of such runs of words, n_removed that of removed lines and runs. A null text counts as empty; a document
    without an id stays as it is. Rows that share an id are taken for copies of one document, so the same lines of
    each go. Where `docs` has such a column, underscores are added to the new one.
    """
    names, own = fresh(docs, "n_paragraphs", "n_removed", "removed", "n_passages", "kept_text"), docs.columns
    key, text, gone, places = fresh(docs, "__id", "__text", "__gone", "__places")
    texts = documents(docs, id_col, text_col)
    at_least = max(min_words, width)
    gone_lines = repeated_paragraphs(texts, width, similarity, min_words).select("doc_id", "paragraph", F.lit(None).cast("int").alias("at"))
    both = gone_lines
    if window is not None:
        both = both.unionByName(repeated_windows(texts, window).select("doc_id", F.lit(None).cast("int").alias("paragraph"), "at"))
    by_doc = both.groupBy(F.col("doc_id").alias(key)).agg(F.collect_set("paragraph").alias(gone), F.collect_set("at").alias(places))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for first, stop, data, offsets in blocks(batch.column(len(own))):
                at, row, _ = lines(data, offsets)
                words = np.diff(word_spans(data, at)[2]) >= at_least
                count = np.bincount(row[words], minlength=stop - first)
                bodies, cuts, starts = (batch.column(len(own) + i).slice(first, stop - first).to_pylist() for i in range(3))
                for n, body, cut, windows in zip(count.tolist(), bodies, cuts, starts):
                    cut, kept, runs = set(cut or ()), body, 0
                    if cut or windows:
                        kept, runs = _without(body.encode(), np.array(windows, np.int64), cut, window or 1)
                    for column, v in zip(out, (n, len(cut) + runs, sorted(cut), runs, kept)):
                        column.append(v)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.string()]
            new = [pa.array(c, k) for c, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(own))), *new], [*own, *names])

    content = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    joined = docs.withColumns({key: quoted(id_col).cast("long"), text: content}).join(by_doc.hint("merge"), key, "left")
    schema = extended(docs.schema, *zip(names, ("long", "long", "array<int>", "long", "string")))
    return joined.select(*map(quoted, own), text, gone, places).mapInArrow(run, schema)
