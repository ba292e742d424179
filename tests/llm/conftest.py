"""Fixtures of the pipeline operators' tests; the session is the one of ``tests/conftest.py``."""

from __future__ import annotations

import pytest

#: ids, texts and extra columns whose names clash with those the operators use
EDGE_SCHEMA = "doc_id long, text string, fp string, n_words long, kept_sha256 string, score double, ids string"
PASSAGE = " ".join(f"w{i}" for i in range(40))


def edge_rows():
    long_text = " ".join(f"long{i % 997} x{i}" for i in range(60_000))
    texts = [
        (0, PASSAGE), (1, PASSAGE), (2, f"before {PASSAGE} after"), (3, None), (4, ""), (5, " \t\n "), (6, "one"),
        (7, "two words"), (8, long_text), (9, "é ñ Ö 中文 . , !"), (9, "é ñ Ö 中文 . , !"), (None, PASSAGE),
        (None, None), (10, "same same same same same same same same same same same same same same same"),
        (11, "a  b c\r\nd\x0be"),
    ]
    return [(i, t, "f", 7, None, None, "z") for i, t in texts]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), EDGE_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
