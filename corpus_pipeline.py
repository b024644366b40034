"""From raw documents to packed training sequences.

Each stage takes what its predecessor kept, stored as Parquet, and all but the last return the columns of
documents. Labels and benchmark items come from the same folder as the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import decontaminate, packing, pii, quality, simhash
from barloom.llm.registry import surrogate_key, table
from barloom.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted to the labelled ones, does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    return simhash.keep_first(docs, shingle=4, max_bits=4, seed=42)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of the benchmark."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"), n=10)


def private_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data, and their new lengths."""
    replaced = pii.replace(docs, surrogate_key(spark))
    return replaced.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else replaced


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of the documents lies in sequences of at most 1,024 tokens."""
    packed = packing.pack_documents(docs, packing.public_vocabulary(), capacity=1024, end_id=2)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("decontamination", clean_documents),
    ("personal_data", private_documents),
    ("packing", packed_documents),
]

#: a fitted classifier and token ids are beyond SQL; the tests hold every stage against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
