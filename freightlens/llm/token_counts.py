"""Delta-maintained token counts by source, language and tokenizer version.

A change is a signed row: +1 for a count that joins the corpus, -1 for one that leaves it; a revised document is both.
Changes arrive in batches.  A batch is summed by group and written to a folder named after it, which Spark's _SUCCESS file
makes visible, so a batch that is committed again, whole or after a failure, counts once.  Totals are the sum of what is
committed: additive, in any order, a row per batch and group.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlens.llm.tokens import chunks, encoder

KEYS = ["source", "lang", "tokenizer"]
DELTA = "source string, lang string, tokenizer string, documents long, tokens long"


def count_tokens(docs: DataFrame, tokenizers: dict[str, str], columns: tuple[str, ...] = ("text",)) -> DataFrame:
    """One row per document and tokenizer: doc_id, source, lang, tokenizer, and the number of ids of each text column.

    ``tokenizers`` maps a version's name to its file.  A null text has no tokens.
    """
    names = [f"n_{c}" for c in columns]
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in KEYS]
        + [T.StructField(n, T.LongType()) for n in names]
    )
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        docs["lang"].cast("string").alias("lang"),
        *[F.coalesce(docs[c], F.lit("")).alias(f"_{i}") for i, c in enumerate(columns)],
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = tuple(f"_{i}" for i in range(len(columns)))
        for ids, sources, langs, *columns_ in chunks(batches, ("doc_id", "source", "lang", *texts), text="_0"):
            for version, path in tokenizers.items():
                n = [encoder(path).lengths(c) for c in columns_]
                same = [pa.array(ids, pa.int64()), pa.array(sources, pa.string()), pa.array(langs, pa.string())]
                same.append(pa.array([version] * len(ids), pa.string()))
                yield pa.record_batch([*same, *map(pa.array, n)], names=schema.names)

    return rows.mapInArrow(count, schema)


def change(counts: DataFrame, sign: int, column: str = "n_text") -> DataFrame:
    """Signed rows: ``sign`` is 1 for rows that join and -1 for rows that leave."""
    return counts.select(*KEYS, F.lit(sign).cast("long").alias("documents"), (F.lit(sign) * F.col(column)).alias("tokens"))


def revision(counts: DataFrame, before: str, after: str) -> DataFrame:
    """Signed rows of documents whose count changes from one column to another."""
    return change(counts, -1, before).unionByName(change(counts, 1, after))


class Rollup:
    """Committed batches below ``root``, a folder that the whole cluster sees."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _folder(self, batch: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        return f"{self.root}/batch={batch}"

    def _exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of signed rows; False, and nothing done, if it is committed already."""
        folder = self._folder(batch)
        if self._exists(f"{folder}/_SUCCESS"):
            return False
        sums = changes.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        sums.coalesce(1).write.mode("overwrite").parquet(folder)
        return True

    def batches(self) -> list[str]:
        """Names of the committed batches, sorted."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/batch=*/_SUCCESS")
        found = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(place) or []
        return sorted(f.getPath().getParent().getName().removeprefix("batch=") for f in found)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents, tokens over all committed batches; groups that came to nothing are left out."""
        paths = [self._folder(b) for b in self.batches()]
        rows = self.spark.read.schema(DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)
        sums = rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.where("documents <> 0 or tokens <> 0")
