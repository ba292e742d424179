"""A training corpus from raw documents, in five stages.

Toxic documents go; of each group of near duplicates one document stays;
passages that repeat from earlier documents are cut out; documents that hold a
benchmark item go; what is left is packed into training sequences. Each stage
takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept and
returns the columns of ``documents``, the last one the packed pieces.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import decontaminate, packing, simhash, substring, toxicity
from panelcast.llm.common import read_table
from panelcast.session import scratch_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.7 by the toxicity classifier, which learns from ``labels``."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"), threshold=0.7)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group (3-word shingles, 3 bits)."""
    return simhash.drop_near_duplicates(docs, shingle=3, k=3)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without words of 13-word runs that a smaller id also holds; ``n_chars`` follows the text."""
    cut = substring.remove_repeats(docs)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 ids, with the ids and their crc32."""
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", simhash_stage),
    ("substring_dedup", substring_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: trained scores, fingerprints, BM25 and token ids are not SQL; the tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    folder = scratch_path(spark, f"corpus-pipeline-{uuid.uuid4().hex}")
    for number, (name, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if number + 1 == len(STAGES):
            return done
        path = f"{folder}/{number}-{name}"
        done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
    return docs
