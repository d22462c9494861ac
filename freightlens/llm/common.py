"""Helpers that several text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freightlens.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text``; a null text counts as empty.  Other columns, whatever their names, are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` below the cluster's shared folder and read it again: cuts lineage, and survives lost executors.

    ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scatter_lookup(rows: DataFrame, table: DataFrame, key: str, value: str, hot: DataFrame) -> DataFrame:
    """Left join of ``rows`` with ``table`` (key -> value) on a long key where few keys may hold most rows.

    ``hot`` holds the (key, value) pairs of the keys with many rows; the caller proves its bound, as it is broadcast.
    Their rows are answered there, and go to the shuffled join under a key of their own row, which spreads them.
    ``rows`` must hold ``_spread``, a long that differs between rows of one key.
    """
    few = F.broadcast(hot.select(F.col(key).alias("_hk"), F.col(value).alias("_hv")))
    known = rows.join(few, F.col(key) == F.col("_hk"), "left")
    known = known.withColumn("_part", F.when(F.col("_hk").isNull(), 0).otherwise(1 + F.pmod("_spread", F.lit(1 << 20))))
    known = known.withColumn("_jk", F.when(F.col("_hk").isNull(), F.col(key)).otherwise(F.lit(0)))
    rest = table.select(F.col(key).alias("_tk"), F.lit(0).cast("long").alias("_tp"), F.col(value).alias("_tv"))
    joined = known.join(rest, (F.col("_jk") == F.col("_tk")) & (F.col("_part") == F.col("_tp")), "left")
    return joined.withColumn(value, F.coalesce("_hv", "_tv")).drop(
        "_hk", "_hv", "_part", "_jk", "_tk", "_tp", "_tv", "_spread"
    )


def ordered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``pos``, its place from 0 on in the order of some columns, which tell all its rows apart or nearly so.

    One range exchange; what is known of the partitions is a row each.
    """
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialize(rows.select("*", F.spark_partition_id().alias("_part"), within.alias("_at")), "ordered")
    sizes = rows.groupBy("_part").count()
    before = F.sum("count").over(Window.orderBy("_part")) - F.col("count")
    first = sizes.select(F.col("_part").alias("_p"), before.alias("_first"))
    placed = rows.join(F.broadcast(first), F.col("_part") == F.col("_p"))
    return placed.withColumn("pos", F.col("_first") + F.col("_at")).drop("_part", "_at", "_p", "_first")


def blocks(start: str, count: str, block: int) -> Column:
    """The blocks that a run of positions touches."""
    first = F.col(start) - F.pmod(F.col(start), F.lit(block))
    return F.explode(F.sequence(first, F.col(start) + F.col(count) - 1, F.lit(block)))


def block_of(c: str, block: int) -> Column:
    """The block that a position is in, named by its first position."""
    return F.col(c) - F.pmod(F.col(c), F.lit(block))
