"""Each stage of the pipeline on the driver's smallest tables against direct computations."""

from __future__ import annotations

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from tests.llm.conftest import SMALL
from tests.llm.test_ngram_join import brute as components
from tests.llm.test_suffix_dedup import brute as repeated
from tokenizers import Tokenizer

from gatehold.llm import packing, perplexity, quality_rules
from gatehold.llm.storage import Rounds


def texts_of(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_stages(spark, documents, tmp_path):
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == documents.columns
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = before, docs
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    ids = {n: ({i for i, _ in texts_of(a)}, {i for i, _ in texts_of(b)}) for n, (a, b) in kept.items()}
    clean = {i for i, r in labels.items() if r["quality"] == 1 and not r["toxic"]}
    before, after = ids["quality classifier"]
    assert len(clean & after) >= 0.97 * len(clean & before) and len(after) < len(before)
    before, after = kept["quality rules"]
    measured = {r["doc_id"]: r["kept"] for r in quality_rules.line_first(before).select("doc_id", "kept").collect()}
    assert texts_of(after) == [(i, t) for i, t in texts_of(before) if measured[i]]
    before, after = kept["n-gram Jaccard join"]
    first = {c for _, _, c in components(texts_of(before))}
    assert texts_of(after) == [(i, t) for i, t in texts_of(before) if i in first]
    before, after = kept["suffix-array dedup"]
    rows = texts_of(before)
    sizes = {i: n - gone for (i, _), (n, gone, _, _) in zip(rows, repeated([t for _, t in rows], 400))}
    assert {i for i, n in sizes.items() if n} == {i for i, _ in texts_of(after)}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, places = {}, {}
    for r in packed:
        pieces.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text in texts_of(docs):
        want = np.append(np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32), np.uint32(0))
        own = sorted(pieces[i], key=lambda r: r["piece"])
        assert [r["start"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
        assert sum(r["length"] for r in own) == len(want) and all(r["length"] == 2048 for r in own[1:])
        assert all(zlib.crc32(want[r["start"] : r["start"] + r["length"]].astype("<u4").tobytes()) == r["ids_crc32"] for r in own)
    for spans in places.values():
        spans.sort()
        assert [o for o, _ in spans] == np.cumsum([0] + [n for _, n in spans])[:-1].tolist() and sum(n for _, n in spans) <= 2048
    assert len(places) <= -(-sum(r["length"] for r in packed) // 2048) + 1


def test_packing_patterns_hold_all_pieces():
    rng = np.random.default_rng(3)
    for sizes in ([], [2048], [1025] * 7, rng.integers(1, 2048, 300), rng.integers(700, 800, 90), [1] * 5000):
        counts = np.bincount(np.array(sizes, int), minlength=2049)
        patterns = packing.bin_completion(counts)
        held = np.zeros(2049, int)
        for p in patterns:
            assert sum(p.lengths) <= 2048
            np.add.at(held, list(p.lengths), p.uses)
        assert (held == counts).all()
        used = sum(p.uses for p in patterns)
        assert packing.fewest(counts, 2048) <= used <= 1.35 * packing.fewest(counts, 2048) + 1


def test_edges_of_rules_classifier_and_packing(spark, frame):
    odd = frame([(1, None), (1, None), (2, ""), (3, "Good words stand here. " * 9), (None, "x | y | z\n" * 30), (4, "a " * 9000)])
    rows = {r["doc_id"]: r for r in quality_rules.line_first(odd).collect()}
    assert not rows[1]["kept"] and rows[1]["n_words"] == 0 and rows[4]["n_repeat_words"] == 9000
    assert quality_rules.line_first(frame({})).count() == 0
    clash = odd.withColumnRenamed("lang", "kept")
    assert quality_rules.line_first(clash).columns[-2] == "kept_"
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    judged = {r["doc_id"]: r for r in perplexity.judged(odd, perplexity.fit(odd, labels)).collect()}
    assert judged[1]["cross_entropy"] is None and not judged[1]["kept"] and judged[3]["kept"]
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.packed(frame({}), path).count() == 0
    packed = packing.packed(odd, path).collect()
    assert sum(r["doc_id"] == 1 for r in packed) == 2 and sum(r["length"] for r in packed if r["doc_id"] == 4) > 8000


def test_near_copies_keep_rows_without_an_id_and_one_of_repeated_rows(spark, frame):
    words = [f"w{i}" for i in range(60)]
    text, near = " ".join(words), " ".join([*words[:-1], "other"])
    rows = [(None, "no id"), (None, text), (5, text), (5, text), (8, near), (9, "alone"), (9, "alone"), (2, None)]
    kept = corpus_pipeline.near_copies(spark, frame(rows), SMALL)
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [
        (0, "no id"), (0, text), (2, ""), (5, text), (9, "alone")
    ]


def test_all_trusted_documents_count(spark):
    docs = spark.range(21_000).selectExpr("id AS doc_id", "concat('good words ', id) AS text", "'en' AS lang")
    labels = docs.selectExpr("doc_id", "1 AS quality", "if(doc_id < 500, 1, if(doc_id < 900, null, 0)) AS toxic")
    labels = labels.union(labels.limit(50)).union(labels.selectExpr("null", "1", "0"))
    for ids in (perplexity.IDS, 8_000):
        found = perplexity.trusted(Rounds(spark), docs, labels, ids)
        assert found.count() == found.distinct().count() == 20_500
