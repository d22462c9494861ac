"""From raw documents to packed training sequences, one operator per stage.

Each stage works on what its predecessor kept, written as Parquet and read again, so a stage restarts from files.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.llm import decontaminate, exact_dedup, language, packing, simhash
from freightlens.llm.common import documents, materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language with a posterior of a half, go."""
    return language.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for the case of A-Z, the one with the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of three-word shingles, two or fewer bits apart, the smallest doc_id stays."""
    return simhash.keep_one(docs, words=3, distance=2)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids and their places in training sequences."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    # Executors that have run the stages before have little memory left besides their heap.
    packed = packing.pack_documents(docs, tokenizer, end_id=0, cache_words=200_000, chunk=1_500_000)
    crc = F.crc32("ids").alias("ids_crc32")
    return packed.select("sequence_id", "offset", "doc_id", "start", "length", "doc_tokens", crc, "ids")


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("pack", pack_sequences),
]

#: Language identification and packing cannot be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
