"""The corpus pipeline against plain versions of its stages."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from panelcast.llm import decontaminate, quality, simhash, toxicity
from tests.llm import brute
from tests.llm.test_tokens import check_pieces

SF = "/root/testdata/sf0.001"


def test_pipeline_matches_plain_stages(spark, docs, labels, benchmark):
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    rows = {i: t for i, t in rows.items() if scores[i] < 0.7}
    ids = sorted(rows)
    root = brute.groups(len(ids), brute.near([brute.simhash(rows[i]) for i in ids]))
    rows = {i: rows[i] for k, i in enumerate(ids) if root[k] == k}
    cut = brute.remove_repeats(list(rows.items()))
    rows = {i: cut[i][3] if cut[i][1] else t for i, t in rows.items()}
    items = [r["text"] for r in benchmark.collect()]
    kept = {i: t for i, t in rows.items() if not any(" ".join(x.split()) in " ".join(t.split()) for x in items)}

    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in pieces} == set(kept)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: np.array([*t.encode(x, add_special_tokens=False).ids, 0], "<u4") for i, x in kept.items()}
    assert check_pieces(pieces, want, 1024) < 0.05


def test_rows_are_judged_by_themselves(spark, docs, labels, benchmark):
    """Rows without an id, or with the id of a rejected row, go or stay by their own text."""
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    toxic, clean = max(scores, key=scores.get), min(scores, key=scores.get)
    assert scores[toxic] >= 0.7 > scores[clean]
    rows = [(None, text[toxic]), (None, text[clean]), (toxic, text[clean]), (clean, text[toxic])]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = [tuple(r) for r in toxicity.drop_toxic(more, labels).where(
        F.col("doc_id").isNull() | F.col("doc_id").isin(toxic, clean)).collect()]
    assert sorted(kept, key=str) == sorted([(clean, text[clean]), (None, text[clean]), (toxic, text[clean])], key=str)

    item = benchmark.first()["text"]
    rows = [(None, f"x {item} y"), (None, "plain"), (7, f"{item}"), (7, "plain words only here")]
    left = decontaminate.drop_contaminated(spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()
    assert sorted(map(tuple, left), key=str) == [(7, "plain words only here"), (None, "plain")]

    long = " ".join(f"w{i}" for i in range(60))
    rows = [(None, long), (None, long), (4, long), (4, long), (9, f"{long} "), (None, "alone " * 9), (None, "alone " * 9), (5, "other one here")]
    left = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, left), key=str) == sorted([(4, long), (None, "alone " * 9), (5, "other one here")], key=str)


def test_repeated_ids_are_learned_from_once(spark, docs, labels):
    again = docs.where(F.col("doc_id") < 40)
    for _ in range(4):
        again = again.unionAll(again)
    once = toxicity.train(docs, labels)
    often = toxicity.train(docs.unionByName(again), labels)
    assert (once.features == often.features).all() and (once.weights == often.weights).all()
    assert quality.train(docs, labels).slopes.tobytes() == quality.train(docs.unionByName(again), labels).slopes.tobytes()


def test_benchmark_statistics_do_not_depend_on_groups(spark, docs, benchmark, monkeypatch):
    twice = benchmark.unionAll(benchmark).unionAll(spark.createDataFrame([(None, "x"), (1, None), (2, "")], benchmark.schema))
    whole = sorted(map(tuple, decontaminate.contaminated(docs, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "GROUP_CHARS", 1500)
    assert sum(1 for _ in decontaminate._indexes(twice)) > 3
    found = sorted(map(tuple, decontaminate.contaminated(docs, twice).collect()))
    assert [f[:2] for f in found] == [w[:2] for w in whole] and len(whole) > 0
    assert np.allclose([f[2:] for f in found], [w[2:] for w in whole])


def test_stages_keep_the_columns_of_documents(spark, edge):
    frame = edge.withColumnRenamed("fp", "lang").withColumnRenamed("n_words", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SF)
        assert frame.columns == ["doc_id", "text", "lang", "n_chars", "kept_sha256", "score", "ids"], name
    assert corpus_pipeline.STAGES[-1][1](spark, frame, SF).count() > 0


def test_registered():
    found = __spark_entry__.queries()
    assert "pipeline" in found and len([n for n in found if n.startswith("op")]) == 13
    assert {"op2_substring", "op3_embeddings", "op8_warc", "op11_pii", "op12_runs", "op13_lexical"} <= set(__spark_entry__.oracle_sql())
