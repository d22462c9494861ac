"""Registered queries of the text operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.llm.common import documents, materialize
from freightlens.llm.conversation_trie import conversation_trie
from freightlens.llm.decontaminate import contaminated
from freightlens.llm.exact_dedup import exact_duplicates
from freightlens.llm.language import identify
from freightlens.llm.language_model import score
from freightlens.llm.minhash import near_duplicates as minhash_duplicates
from freightlens.llm.oracles import NEAR, TRIE
from freightlens.llm.packing import pack_documents
from freightlens.llm.simhash import near_duplicates
from freightlens.llm.substring_dedup import remove_repeats
from freightlens.llm.token_counts import Rollup, change, count_tokens, revision
from freightlens.llm.token_files import with_crc32, with_start, written
from freightlens.llm.url_queries import ORACLE as URL_ORACLE
from freightlens.llm.url_queries import op2_url_filter
from freightlens.llm.whitening import whiten
from freightlens.session import scratch_path, tidy


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    crc = F.crc32("ids").alias("ids_crc32")
    return packed.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir)).withColumnRenamed("digest", "text_sha256")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents join; then one in ten leaves, and one in ten loses its first line.  Each batch is sent twice."""
    versions = {name: public_tokenizers.path(f"{name}.json") for name in ("byte_bpe_50k", "word_bpe_49k")}
    docs = documents(spark, sf_dir).withColumn("rest", F.regexp_replace("text", r"\A[^\n]*\n?", ""))
    docs = docs.withColumn("rest", F.when(F.col("doc_id") % 10 == 1, F.col("rest")))
    counts = materialize(count_tokens(docs, versions, ("text", "rest")), "token-counts")
    rollup = Rollup(spark, scratch_path(spark, "rollup"))
    batches = {
        "0-load": change(counts, 1),
        "1-leave": change(counts.where("doc_id % 10 = 0"), -1),
        "2-revise": revision(counts.where("doc_id % 10 = 1"), "n_text", "n_rest"),
    }
    for name, rows in [*batches.items(), *batches.items()]:
        rollup.commit(name, rows)
    return rollup.totals()


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(tidy(spark), sf_dir))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = written(spark, documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return with_crc32(with_start(ids).select("doc_id", "start", "n_tokens", "ids"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir), words=3, distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_duplicates(documents(spark, sf_dir))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_url_filter": op2_url_filter,
    "op3_decontaminate": op3_decontaminate,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_language_model": op7_language_model,
    "op8_language": op8_language,
    "op10_simhash": op10_simhash,
    "op9_token_files": op9_token_files,
    "op11_whitening": op11_whitening,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_minhash": op13_minhash,
}

_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op2_url_filter": URL_ORACLE,
    "op5_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_NORM} AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm)""",
    "op12_conversation_trie": TRIE,
    "op13_minhash": NEAR,
}
