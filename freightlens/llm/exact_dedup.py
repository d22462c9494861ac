"""Exact deduplication with skew-safe combining.

A digest groups the candidates; the full normalised text is a grouping key at every stage, so texts that merely share
a digest never merge.

1. Map tasks combine equal (digest, salt, text) rows before the exchange.
2. The exchange merges each (digest, salt) group.  Only digests with more than ``hot_rows`` rows are salted, by enough
   salts for about ``hot_rows`` rows each; every other group is complete here, and its text moved once.
3. The salt winners of the hot digests, at most about two per ``hot_rows`` input rows, are combined globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from freightlens.llm.common import ascii_lower, id_and_text

#: A digest is hot above this many rows, and above one row in HOT_SHARE: no more than HOT_SHARE digests can be hot.
HOT_ROWS, HOT_SHARE = 10_000, 10_000


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_duplicates(docs: DataFrame, digest=sha256, hot_rows: int = HOT_ROWS, normalize=ascii_lower) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest.

    ``keep_id`` is the largest doc_id among the documents with the same normalised text.  A null text is an empty text;
    a null doc_id ranks below all others.  Rows that repeat a doc_id and its text count in ``group_size`` each, and
    exactly one row of a group is ``kept``.  An empty table gives an empty result.
    """
    rows = id_and_text(docs).select("doc_id", normalize(F.col("text")).alias("norm"))
    rows = rows.withColumn("digest", digest(F.col("norm")))
    sizes = rows.groupBy("digest").agg(F.count("*").alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    limit = max(hot_rows, total // HOT_SHARE)
    # At most HOT_SHARE rows, as each stands for more than one HOT_SHARE-th of all rows.
    hot = sizes.where(F.col("n") > limit).select(
        F.col("digest").alias("_hot"), F.ceil(F.col("n") / limit).cast("long").alias("_salts")
    )
    salted = rows.join(F.broadcast(hot), F.col("digest") == F.col("_hot"), "left").withColumn(
        "salt", F.when(F.col("_hot").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64("doc_id"), F.col("_salts")))
    )
    merged = salted.groupBy("digest", "salt", "norm").agg(
        F.max("doc_id").alias("winner"), F.count("*").alias("n"), F.collect_list(F.struct("doc_id")).alias("members")
    )
    # Salt 0 is complete.  Its rows keep a partition of their own in this window, so only hot groups meet their salts.
    cold = merged.where("salt = 0").drop("norm", "salt")
    meet = Window.partitionBy("digest", "norm")
    warm = merged.where("salt > 0").select(
        "digest",
        F.max("winner").over(meet).alias("winner"),
        F.sum("n").over(meet).alias("n"),
        "members",
        (F.row_number().over(meet.orderBy(F.desc_nulls_last("winner"), "salt")) == 1).alias("first"),
    )
    both = cold.withColumn("first", F.lit(True)).unionByName(warm)
    member = F.sort_array("members", asc=False)
    return both.select("winner", "n", "first", "digest", F.posexplode(member).alias("at", "member")).select(
        F.col("member.doc_id").alias("doc_id"),
        F.col("winner").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("first") & (F.col("at") == 0)).alias("kept"),
        "digest",
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, all columns.

    Of rows that repeat both doc_id and text, the first by all other columns stays.
    """
    kept = exact_duplicates(docs, **options).where("kept")
    kept = kept.select(F.col("digest").alias("_d"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_i"))
    digest, normalize = options.get("digest", sha256), options.get("normalize", ascii_lower)
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        digest(normalize(F.coalesce(docs["text"], F.lit("")))).alias("_digest"),
        F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("_id"),
    )
    stay = rows.join(kept, (F.col("_digest") == F.col("_d")) & (F.col("_id") == F.col("_i")), "left_semi")
    first = Window.partitionBy("_digest", "_id").orderBy(F.col("row").cast("string"))
    return stay.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").select("row.*")
