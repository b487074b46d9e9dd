"""Documents to training sequences: five stages, each over all that the one before it kept.

``run`` writes every stage's result to the shared folder and reads it again for the next, so a stage
starts from a table and a lost executor costs no more than a part of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import decontaminate, packing, secrets, shingles, toxicity
from lakeops.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. The model learns from the labels that are not held out."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id: five-word shingles, similarity 0.8 or more."""
    return shingles.keep_one(docs)


def drop_benchmark_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item, or with a whole shorter item, go."""
    return decontaminate.without_benchmarks(docs, _table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in it are replaced by a mark, and ``n_chars`` follows."""
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every document and their places in sequences of at most 1024 ids."""
    found = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, limit=1024)
    return packing.pack(found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), limit=1024)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_documents),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: Scores of a trained model decide what stays, which SQL can't express; a test runs it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
