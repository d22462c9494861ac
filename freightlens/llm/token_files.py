"""Token files: ids of whole texts in ORC, in ascending doc_id order.

One file per range of doc_id, rows sorted within.  ORC run-length encodes the ids and the running positions, keeps
minimum and maximum of doc_id per stripe and per row group, and a Bloom filter on it, so a look-up by doc_id skips
files, stripes and row groups, while full reads split at stripes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from freightlens.llm.common import id_and_text
from freightlens.llm.tokens import chunks, encoder
from freightlens.session import scratch_path

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("file_start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ]
)
ORC = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "2000",
    "orc.stripe.size": str(16 << 20),
    "compression": "zstd",
}
#: Documents of one file, and so of one task.
FILE_DOCS = 20_000


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int | None, file_docs: int = FILE_DOCS) -> None:
    """Encode every text (null: empty), append ``end_id`` and write ORC below ``path``.

    Rows are in ascending doc_id order, null ids first, rows that repeat a doc_id by text.  ``file_start`` counts the
    ids before a document in its file.  An empty table gives no rows.
    """
    rows = id_and_text(docs)
    files = max(1, -(-rows.count() // file_docs), docs.sparkSession.sparkContext.defaultParallelism)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, start = encoder(tokenizer), 0
        for doc_ids, texts in chunks(batches, ("doc_id", "text")):
            ids, ends = use.encode(texts)
            if end_id is not None:
                ids = np.insert(ids, ends[1:], end_id)
                ends = ends + np.arange(len(ends))
            yield pa.record_batch(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(start + ends[:-1]),
                    pa.array(np.diff(ends)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32))),
                ],
                names=SCHEMA.names,
            )
            start += int(ends[-1])

    ordered = rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, SCHEMA).write.options(**ORC).orc(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The rows of token files; filters on doc_id reach stripes and row groups."""
    return spark.read.schema(SCHEMA).orc(path)


def with_start(ids: DataFrame) -> DataFrame:
    """Add ``start``, the ids of all documents before a row: file totals, one row per file, are summed in file order."""
    rows = ids.withColumn("_file", F.col("_metadata.file_path"))
    totals = rows.groupBy("_file").agg(F.min("doc_id").alias("_from"), F.sum("n_tokens").alias("_n"))
    before = Window.orderBy(F.asc_nulls_first("_from"), "_file").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(F.col("_file").alias("_f"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # One row per file, and a file holds FILE_DOCS documents.
    joined = rows.join(F.broadcast(base), F.col("_file") == F.col("_f"))
    return joined.withColumn("start", F.col("_base") + F.col("file_start")).drop("_file", "_f", "_base")


def with_crc32(ids: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32``: the unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    others = [c for c in ids.columns if c != "ids"]
    schema = T.StructType([ids.schema[c] for c in others] + [T.StructField("ids_crc32", T.LongType())])

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        for batch in batches:
            lists = batch.column("ids")
            raw, ends = lists.values.to_numpy().astype("<u4").tobytes(), lists.offsets.to_pylist()
            sums = [crc32(raw[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])]
            yield pa.record_batch([batch.column(c) for c in others] + [pa.array(sums, pa.int64())], names=schema.names)

    return ids.mapInArrow(crc, schema)


def written(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int | None) -> DataFrame:
    """Write the token files of ``docs`` below the shared folder and read them back."""
    path = scratch_path(spark, "token-ids")
    write_ids(docs, path, tokenizer, end_id)
    return read_ids(spark, path)
