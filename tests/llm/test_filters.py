"""Toxicity, decontamination, quality and WARC."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from panelcast.llm import decontaminate, quality, toxicity, warc
from tests.llm.conftest import EDGE_SCHEMA


def auc(score, truth):
    score, truth = np.array(score), np.array(truth, bool)
    rank = np.argsort(np.argsort(score)) + 1
    p, n = truth.sum(), (~truth).sum()
    return (rank[truth].sum() - p * (p + 1) / 2) / (p * n)


def held_out(spark, module, folds, fold, column):
    base = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r[column] for r in labels.collect()}
    found = {r["doc_id"]: r["score"] for r in module.score(docs, module.train(docs, labels)).collect()}
    assert len(found) == docs.count() and all(0 <= s <= 1 for s in found.values())
    ids = [i for i in truth if zlib.crc32(str(i).encode()) % folds == fold]
    return [found[i] for i in ids], [truth[i] for i in ids]


def test_toxicity_on_the_held_out_fold(spark):
    score, truth = held_out(spark, toxicity, 3, 1, "toxic")
    assert auc(score, truth) > 0.75  # some 30 positives to learn from here
    clean = [s for s, t in zip(score, truth, strict=True) if not t]
    assert np.mean(np.array(clean) >= 0.7) < 0.05


def test_quality_on_the_held_out_fold(spark):
    score, truth = held_out(spark, quality, 5, 0, "quality")
    assert auc(score, truth) > 0.95


def test_nnpu_finds_positives_hidden_in_unlabelled_text():
    rng = np.random.default_rng(0)

    def text(bad):
        words = [f"w{int(x)}" for x in rng.zipf(1.3, 60) if x < 10_000]
        return " ".join([*words, *(["vile", "rotten"] if bad else [])])

    sets = toxicity.text_features
    positive = [sets(text(True)) for _ in range(200)]
    unlabelled = [sets(text(i % 10 == 0)) for i in range(1000)]
    model = toxicity.fit_nnpu(positive, unlabelled, 0.1)
    cache = toxicity._WordScores(model.features)
    bad = toxicity.score_texts(model, cache, [text(True) for _ in range(200)])
    good = toxicity.score_texts(model, cache, [text(False) for _ in range(200)])
    assert (bad >= 0.7).mean() > 0.97 and (good >= 0.7).mean() < 0.02


def test_classifiers_on_edge_rows(spark, edge, no_docs):
    labels = spark.createDataFrame(
        [(0, 1, 1), (1, 0, 0), (2, None, None), (None, 1, 1), (8, 0, 1), (8, 1, 0), (99, 1, 1)],
        "doc_id long, quality int, toxic int")
    for module in (toxicity, quality):
        for known in (labels, labels.where("false")):
            rows = module.score(edge, module.train(edge, known)).collect()
            assert len(rows) == 15 and all(0 <= r["score"] <= 1 for r in rows)
        assert module.score(no_docs, module.train(no_docs, labels)).count() == 0
    kept = toxicity.drop_toxic(edge, labels.where("false"))
    assert kept.columns == edge.columns and kept.count() == 15


def test_leaks_match_plain_search(docs, benchmark):
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]

    def runs(words):
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    want = set()
    for item, text in items:
        parts = [runs(x) for x in decontaminate.question_and_answer(text)]
        n = len(decontaminate.words_of(text))
        for d, t in rows:
            words = decontaminate.words_of(t)
            for i in range(0, max(1, len(words) - n + 1)):
                if all(len(p & runs(words[i : i + n])) == len(p) for p in parts):
                    want.add((d, item))
                    break
    found = decontaminate.contaminated(docs, benchmark).collect()
    assert want <= {(r["doc_id"], r["item_id"]) for r in found}
    assert all(r["question_overlap"] >= 0.8 and r["answer_overlap"] >= 0.8 and r["score"] >= 0.6 for r in found)
    exact = {(d, i) for d, t in rows for i, x in items if x in t}
    assert exact and exact <= {(r["doc_id"], r["item_id"]) for r in found}


def test_block_max_wand_retrieves_all_above_threshold():
    rng = np.random.default_rng(5)
    items = [(i, " ".join(f"t{x}" for x in rng.zipf(1.4, 30) if x < 500) + f" u{i}. ans{i} end{i}.") for i in range(90)]
    index = decontaminate.ItemIndex(items)
    assert index.bounds.shape[1] == 45
    for q in range(40):
        words = [f"t{x}" for x in rng.zipf(1.4, 30)] + items[q][1].split()[: int(rng.integers(1, 30))]
        terms = sorted({index.terms[w] for w in map(decontaminate.normalise, words) if w in index.terms})
        scores = Counter()
        for t in terms:
            for block in index.postings[t].values():
                for item, x in block:
                    scores[item] += x
        for threshold in (0.2, 0.5):
            found = {}
            for block in range(index.bounds.shape[1]):
                found.update(index.block_max_wand(terms, block, threshold))
            assert found == pytest.approx({i: s for i, s in scores.items() if s >= threshold})


def test_decontamination_edge_rows(spark, edge, no_docs):
    passage = edge.where("doc_id = 0").first()["text"]
    long_item = " ".join(f"long{i} x{i}" for i in range(600))
    items = spark.createDataFrame(
        [(1, passage + "."), (1, passage + "."), (2, None), (3, ""), (4, "..."), (None, passage), (5, "one"), (6, long_item)],
        "item_id long, text string")
    found = decontaminate.contaminated(edge, items)
    pairs = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert {(0, 1), (1, 1), (2, 1), (None, 1), (6, 5), (8, 6)} <= pairs
    assert not {2, 3, 4, None} & {i for _, i in pairs} and not {3, 4, 5, 10} & {d for d, _ in pairs}
    assert found.count() == len(pairs)
    kept = decontaminate.drop_contaminated(edge, items)
    assert kept.columns == edge.columns and {0, 1, 2}.isdisjoint(r["doc_id"] for r in kept.collect())
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(edge, none).count() == 0
    assert decontaminate.contaminated(no_docs, items).count() == 0


def test_edited_passages_are_verified(spark, benchmark):
    text = benchmark.orderBy("item_id").first()["text"]
    words = text.split()
    other = " ".join(f"z{i}" for i in range(300))
    cases = [(0, f"{other} {text.upper()} {other}"), (1, f"{other} {' '.join(words[: len(words) // 2])} {other}"),
             (2, f"{other} {' '.join(reversed(words))} {other}"), (3, other)]
    frame = spark.createDataFrame(cases, "doc_id long, text string")
    assert [r["doc_id"] for r in decontaminate.contaminated(frame, benchmark).collect()] == [0]


def test_long_items_are_verified_whole(spark):
    words = [f"q{i}" for i in range(256)] + ["the"]  # one word more than a part
    long = [f"r{i}" for i in range(700)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(long[:600]) + ". " + " ".join(long[600:]))],
                                  "item_id long, text string")
    other = " ".join(f"z{i}" for i in range(300))
    cases = [(0, f"{other} {' '.join(words)} {other}"), (1, f"the {other}"), (2, " ".join(words[100:])),
             (3, f"{other} {' '.join(long)} {other}"), (4, f"{other} {' '.join(long[:600])} {other}"),
             (5, f"{other} {' '.join(long[400:])} {other}")]
    frame = spark.createDataFrame(cases, "doc_id long, text string")
    found = decontaminate.contaminated(frame, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(0, 1), (3, 2)}


PAGE = "page_id long, url string, html string, digest string, first long"


def test_warc_round_trip_in_any_ranges(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    more = [(1000, "http://a.b/ c\r\nX: y", "x" * 120), (1001, None, "x" * 120), (1002, "u", "short"), (1003, "u", "short"),
            (1004, "u", None), (1005, "u", ""), (1006, "é", "é中" * 60 + "\r\n\r\nWARC/1.1\r\n"), (None, "u", "x" * 120),
            (1000, "http://a.b/ c", "x" * 120), (None, "n", "only without an id " * 9)]
    frame = pages.select("page_id", "url", "html").union(spark.createDataFrame(more, "page_id long, url string, html string"))
    folder, manifest = warc.write_archives(frame.repartition(3))
    html = sorted(((i, h or "") for i, _, h in (tuple(r) for r in frame.collect())), key=str)
    for size in (300, 5000, 1 << 24):
        rows = warc.read_archives(spark, folder, manifest, range_bytes=size).collect()
        assert len(rows) == len(html)
        if size == 5000:  # the ranges are read by more than one task
            tasks = warc.read_archives(spark, folder, manifest, range_bytes=size).select(
                F.spark_partition_id().alias("t")).distinct().count()
            assert tasks > 2
        digests = {r["payload_digest"]: bytes(r["payload"]).decode() for r in rows if r["payload"] is not None}
        assert sorted(((r["page_id"], digests[r["payload_digest"]]) for r in rows), key=str) == html
        by_id = {}
        for r in rows:
            by_id.setdefault(r["page_id"], []).append((r["record_type"], r["refers_to"], r["payload_bytes"]))
        assert by_id[1000] == [("response", None, 120)] * 2 and by_id[1001] == [("revisit", 1000, 120)]
        assert by_id[1002] == by_id[1003] == [("response", None, 5)] and by_id[1004] == [("response", None, 0)]
        assert ("revisit", 1000, 120) in by_id[None] and ("response", None, 171) in by_id[None]
    assert manifest.groupBy().sum("n_records").first()[0] == len(html)
    folder, manifest = warc.write_archives(frame.where("false"))
    assert warc.read_archives(spark, folder, manifest).count() == 0


def test_warc_clashing_columns_and_a_very_long_payload(spark):
    long = "".join(f"{i} " for i in range(900_000))
    rows = [(1, "u", "x" * 200, "d", 9), (2, "u", "x" * 200, "d", 9), (3, "u", long, None, None), (4, None, None, None, None)]
    folder, manifest = warc.write_archives(spark.createDataFrame(rows, PAGE))
    got = {r["page_id"]: r for r in warc.read_archives(spark, folder, manifest, range_bytes=100_000).collect()}
    assert [got[i]["record_type"] for i in (1, 2, 3, 4)] == ["response", "revisit", "response", "response"]
    assert got[2]["refers_to"] == 1 and bytes(got[3]["payload"]).decode() == long and got[4]["payload_bytes"] == 0


def test_warc_reader_passes_over_false_magic(tmp_path):
    good = [warc.page_record(i, None, b"p" * (50 + i), "d", None, False) for i in range(3)]
    noise = b"junk" + warc.MAGIC + b"not a member" + warc.MAGIC
    raw = noise + good[0] + noise + good[1] + good[2][:40] + good[2]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(raw)
    for cut in (len(raw), 9, 64, 200):
        found = []
        for start in range(0, len(raw), cut):
            found += [f["warc-record-id"] for _, f, _ in warc.records_in(str(path), start, min(len(raw), start + cut))]
        assert found == [warc.page_urn(i) for i in range(3)]


def test_edge_schema_clashes():
    assert {"fp", "n_words", "kept_sha256", "score", "ids"} <= {c.split()[0] for c in EDGE_SCHEMA.split(", ")}
