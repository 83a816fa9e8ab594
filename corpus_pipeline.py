"""From documents to token ids: five stages, each a DataFrame written as Parquet and read by the next.

Every stage decides on the documents that the one before it kept. All but the last return the columns of
``documents``; rows without a ``doc_id`` pass the filters untouched and end at the encoder, which needs one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexiloom.llm import bpe, decontaminate, line_dedup, minhash, weak_labels
from lexiloom.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier does not reject."""
    return weak_labels.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the long lines that five or more of them share, but for the largest id's."""
    return line_dedup.cut_lines(docs, line_dedup.keep_bitmaps(docs, min_chars=40, min_docs=5))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near duplicates."""
    return minhash.keep_one(docs, words=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no close variant of a benchmark passage."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), percent=80)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what is left."""
    return bpe.digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: Neither the classifier nor BPE is expressible in SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
