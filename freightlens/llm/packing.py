"""Packing token sequences by best-fit decreasing.

Documents are encoded and cut into full windows; what is left of each, shorter than a window, is packed best-fit
decreasing.  Pieces are dealt by a hash of document and position to shards of a bounded number of documents, sorted by
falling length, and placed one after another: a segment tree over remaining capacities finds the tightest open window.
A shard ends with a few windows that are not full, which is the padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlens.llm.common import id_and_text
from freightlens.llm.tokens import CACHE_WORDS, CHUNK, chunks, encoder

WINDOW = 1024
#: Documents of a shard.
SHARD_DOCS = 4096
_PIECE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


class OpenWindows:
    """Windows that can take more, found by remaining capacity: a segment tree over 1..window that counts windows."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.counts = [0] * (2 * self.size)
        self.stacks: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]

    def add(self, room: int, sequence: int, used: int) -> None:
        self.stacks[room].append((sequence, used))
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = self.size + room
        while node:
            self.counts[node] += by
            node >>= 1

    def take(self, length: int) -> tuple[int, int, int] | None:
        """Remove and return (room, sequence, used) of the open window with the least room of at least ``length``."""
        counts, node = self.counts, self.size + length
        if not counts[node]:
            while node > 1 and (node & 1 or not counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if counts[2 * node] else 2 * node + 1
        room = node - self.size
        self._change(room, -1)
        return (room, *self.stacks[room].pop())


def pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int | None,
    window: int = WINDOW,
    cache_words: int = CACHE_WORDS,
    chunk: int = CHUNK,
) -> DataFrame:
    """Encoded documents cut into full windows and a rest: doc_id, start, length, doc_tokens, ids.

    ``cache_words`` and ``chunk`` (characters encoded at once) trade a worker's memory for time; the ids do not depend on
    them.

    ``ids`` holds little-endian unsigned 32-bit integers.  A null text is an empty text, which gives ``end_id`` alone.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = encoder(tokenizer, cache_words)
        for doc_ids, texts in chunks(batches, ("doc_id", "text"), limit=chunk):
            ids, ends = use.encode(texts)
            if end_id is not None:
                ids = np.insert(ids, ends[1:], end_id)
                ends = ends + np.arange(len(ends))
            size = np.diff(ends)
            parts = -(-size // window)
            doc = np.repeat(np.arange(len(size)), parts)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * window
            length = np.minimum(window, size[doc] - start)
            offsets = np.concatenate((4 * (ends[doc] + start), [4 * int(ends[-1])])).astype(np.int32)
            raw = pa.py_buffer(ids.astype("<u4").tobytes())
            yield pa.record_batch(
                [
                    pa.array(doc_ids, pa.int64()).take(pa.array(doc)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(size[doc]),
                    pa.BinaryArray.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(offsets), raw]),
                ],
                names=_PIECE.names,
            )

    return id_and_text(docs).mapInArrow(cut, _PIECE)


def pack(rows: DataFrame, shards: int, window: int = WINDOW) -> DataFrame:
    """Add sequence_id and offset to the pieces: doc_id, start, length (1 to ``window``), and any other columns.

    Pieces of a sequence lie at offsets without gaps from 0.  The result depends only on the rows: ties of length are
    broken by doc_id and start, and rows that repeat all three are alike.  An empty table gives no rows.
    """
    dealt = rows.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "start"), F.lit(shards)).cast("int"))
    ordered = dealt.repartition(shards, "_shard").sortWithinPartitions("_shard", F.desc("length"), "doc_id", "start")
    added = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    names, schema = rows.columns, T.StructType(rows.schema.fields + added)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, windows, used_ids = None, None, 0
        for batch in batches:
            sequences, offsets = [], []
            for own, length in zip(batch.column("_shard").to_pylist(), batch.column("length").to_pylist()):
                if own != shard:
                    shard, windows, used_ids = own, OpenWindows(window), 0
                found = windows.take(length)
                if found is None:
                    found = (window, (own << 32) + used_ids, 0)
                    used_ids += 1
                room, sequence, used = found
                if room > length:
                    windows.add(room - length, sequence, used + length)
                sequences.append(sequence)
                offsets.append(used)
            kept = [batch.column(c) for c in names]
            new = [pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())]
            yield pa.record_batch(kept + new, names=schema.names)

    return ordered.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int | None,
    window: int = WINDOW,
    shard_docs: int = SHARD_DOCS,
    cache_words: int = CACHE_WORDS,
    chunk: int = CHUNK,
) -> DataFrame:
    """Encode, cut and pack ``docs``: the columns of :func:`pieces` with sequence_id and offset."""
    shards = max(1, -(-docs.count() // shard_docs))
    return pack(pieces(docs, tokenizer, end_id, window, cache_words, chunk), shards, window)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence, its ids in order as bytes: sequence_id, length, ids."""
    part = F.struct("offset", "ids")
    parts = F.array_sort(F.collect_list(part))
    joined = F.aggregate(parts, F.expr("cast('' as binary)"), lambda all_, p: F.concat(all_, p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
