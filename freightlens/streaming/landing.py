"""Landing files as a stream, and streaming upserts into warehouse tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from freightlens.operators.merge import latest_source
from freightlens.plans.refresh import merge_into
from freightlens.schemas import raw_schema
from freightlens.sources.landing import READ_OPTIONS, strictly_typed


def stream_landing(
    spark: SparkSession, folder: str, table: str, max_files: int | None = None, audit: bool = True
) -> DataFrame:
    """New landing CSV files of one table as they arrive, typed."""
    reader = spark.readStream.schema(raw_schema(table, audit)).options(**READ_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return strictly_typed(reader.csv(folder), table, audit)


def stream_landing_once(
    spark: SparkSession, folder: str, table: str, replay_within: str, max_files: int | None = None, audit: bool = True
) -> DataFrame:
    """:func:`stream_landing` without the rows of files that are sent again.

    A row counts once among the files that arrive within ``replay_within`` (an interval such as ``"7 days"``) of each
    other: a file's arrival is its modification time, so nothing is too late to be taken, however old its own times are.
    The state holds a hash per row of that time and no more.  Two rows are the same if all their columns are.
    """
    reader = spark.readStream.schema(raw_schema(table, audit)).options(**READ_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    landed = reader.csv(folder).select("*", F.col("_metadata.file_modification_time").alias("_arrival"))
    same = F.sha2(F.to_json(F.struct(*raw_schema(table, audit).names), {"ignoreNullFields": "false"}), 256)
    marked = landed.withColumn("_row", same).withWatermark("_arrival", replay_within)
    return strictly_typed(marked.dropDuplicatesWithinWatermark(["_row"]).drop("_arrival", "_row"), table, audit)


def upsert_batch(root: str, table: str, now: datetime | Column) -> Callable[[DataFrame, int], None]:
    """The action of one micro-batch: its latest row per key, merged into the months of the table that it touches.

    Spark may run a batch again after a failure.  A repeated merge gives the same table, so the replay is harmless.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        source = latest_source(batch, table).persist()
        try:
            merge_into(source, root, table, now)
        finally:
            source.unpersist()

    return apply


def stream_upsert(
    stream: DataFrame, root: str, table: str, checkpoint: str, now: datetime | Column
) -> StreamingQuery:
    """Upsert everything that has landed into a warehouse table, then stop.

    The checkpoint remembers which files are done.  Late rows are settled by ``update_date``: an older fact row never
    replaces a newer one, whatever order the files arrive in.  A micro-batch rewrites the months that it touches.
    """
    return (
        stream.writeStream.foreachBatch(upsert_batch(root, table, now))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
