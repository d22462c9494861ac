"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed n-grams per language are summed in each task, then over tasks.  The log-probability matrix, languages by
buckets, is broadcast; ``MAX_LANGUAGES`` bounds it.  Scoring gathers a language's row for all n-grams of a batch and adds
them up per text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlens.llm.tokens import chunks

BUCKETS, ORDERS, SMOOTHING = 1 << 16, (1, 2, 3), 0.5
MAX_LANGUAGES = 256
CHUNK = 1_000_000
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """True where the crc32 of doc_id as text leaves 2 modulo 4.  A null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram order, the buckets of all texts' n-grams and where each text's begin (one more entry: the end).

    Texts are lower-cased and framed by one blank on either side.
    """
    framed = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.cumsum([0] + [len(t) for t in framed])
    for order in ORDERS:
        mixed = np.full(len(codes), order, np.uint64)
        for k in range(order):
            mixed[: len(codes) - k] = (mixed[: len(codes) - k] * np.uint64(1_000_003)) ^ codes[k:]
        bucket = ((mixed * _MIX) >> np.uint64(48)).astype(np.int64)
        short = order - 1  # the last positions of a text begin no n-gram of its own
        inside = np.ones(len(codes), bool)
        for k in range(1, order):
            inside[ends[1:] - k] = False
        starts = ends - short * np.arange(len(ends))
        yield bucket[inside], starts


class Model:
    """Languages in sorted order and, per language, the log probability of each bucket; priors likewise."""

    def __init__(self, languages: list[str], table: np.ndarray, prior: np.ndarray):
        self.languages, self.table, self.prior = languages, table, prior

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text, and its posterior probability.

        ``und`` with probability 0 for a null text, one without a letter, or where nothing was learned.  Ties go to the
        first language in sorted order.
        """
        clear = [i for i, t in enumerate(texts) if t and self.languages and _LETTER.search(t)]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if clear:
            total = np.repeat(self.prior[:, None], len(clear), axis=1)
            for bucket, starts in _grams([texts[i] for i in clear]):
                for row, logs in zip(total, self.table):
                    row += np.add.reduceat(logs[bucket], starts[:-1])
            best = total.argmax(axis=0)
            share = 1 / np.exp(total - total.max(axis=0)).sum(axis=0)
            for i, b, s in zip(clear, best, share):
                names[i], scores[i] = self.languages[b], s
        return names, scores


def fit(docs: DataFrame, label: str = "lang") -> Model:
    """Learn from all rows with a text and a label.

    Raises ValueError above ``MAX_LANGUAGES`` labels, before anything is gathered.  No such rows: a model that knows no
    language.
    """
    rows = docs.where(F.col("text").isNotNull() & F.col(label).isNotNull())
    rows = rows.select("text", F.col(label).cast("string").alias("label"))
    labels = {r["label"]: r["count"] for r in rows.groupBy("label").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(labels) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of {label}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for texts, names in chunks(batches, ("text", "label"), limit=CHUNK):
            for name in set(names):
                own = sums.setdefault(name, np.zeros(BUCKETS, np.int64))
                for bucket, _ in _grams([t for t, n in zip(texts, names) if n == name]):
                    own += np.bincount(bucket, minlength=BUCKETS)
        for name, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.record_batch([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(own[at])], names=["label", "bucket", "n"])

    found = rows.mapInArrow(count, "label string, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    # At most MAX_LANGUAGES x BUCKETS rows.
    sums = found.toPandas()
    languages = sorted(labels)
    table = np.full((len(languages), BUCKETS), SMOOTHING)
    table[[languages.index(x) for x in sums["label"]], sums["bucket"].to_numpy(np.int64)] += sums["n"].to_numpy(float)
    table = np.log(table) - np.log(table.sum(axis=1, keepdims=True))
    prior = np.log(np.array([labels[x] for x in languages], float)) - np.log(max(1, sum(labels.values())))
    return Model(languages, table, prior)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with _lang_pred and _lang_score; all other columns as they are.  See :meth:`Model.predict`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = [T.StructField("_lang_pred", T.StringType()), T.StructField("_lang_score", T.DoubleType())]
    schema = T.StructType(docs.schema.fields + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for (texts,) in chunks([batch], ("text",), limit=CHUNK):
                found = shared.value.predict(texts)
                names += found[0]
                scores += found[1].tolist()
            new = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.record_batch([*batch.columns, *new], names=schema.names)

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, learned from the documents that are not held out.

    Documents without a doc_id are predicted but not learned from.  Rows that repeat count each.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(rows.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    found = predict(rows.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_lang_score").alias("score"))


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with a posterior of ``least`` or more."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(rows.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: list[bool] = []
            for (texts,) in chunks([batch], ("text",), limit=CHUNK):
                names, scores = shared.value.predict(texts)
                known += [n != UNKNOWN and s >= least for n, s in zip(names, scores.tolist())]
            yield batch.filter(pa.array(known, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
