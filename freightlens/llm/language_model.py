"""Stupid-backoff language model scores, as joins of pieces of text with blocks of counts.

1. Texts are cut into words, a piece of a few million characters at a time.  A piece is a row: its distinct words with
   their number, and which of them stands at each place.
2. The distinct words of all pieces meet by hash in blocks.  A block counts them over all texts, numbers those with at
   least ``least`` occurrences, and answers each piece with the number and the count of each of its words.
3. So do n-grams, order by order.  The key of an n-gram is the number of the words but the last, and that of the last, so
   n-grams differ whenever their words do.  One whose parts occur fewer than ``least`` times cannot be in a table of the
   model and is not sent.
4. Pieces and answers meet again, and each word is scored: by the log of the count over the count of the context; where
   the n-gram has fewer than ``least`` occurrences, one order lower at the price of log(``backoff``).  Single words always
   have a score.  Scores are summed per document.

No word is left out of the model, and none is kept on the driver.  A piece sends a word or an n-gram once, however often it
holds it, so a frequent one is a key per piece and no block is large for it.  Keys of a piece that go to the same block are
one row, and so are the answers.  N-grams are counted in ``SLICES`` jobs, one after another, so that the keys of all never
lie on disk at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import pairwise
from math import log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import id_and_text, materialize
from freightlens.llm.tokens import chunks

VOCABULARY, ORDER, LEAST, BACKOFF = (1 << 16) - 1, 2, 2, 0.4
#: A block counts about one in so many words of text.  No n-gram is hot any more, so the name is older than the meaning.
HOT_SHARE = 2_000_000
#: Jobs that count a share of the n-grams of one order each.
SLICES = 3
_SPACE = b" \t\n\r\x0b\x0c"
_IS_SPACE = bytes(b in _SPACE for b in range(256))
#: An odd number: its product with a key, modulo 2^64, is another key for each, and its high bits spread.
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_SENT = "block int, piece long, size int, keys binary, n binary"
_ANSWER = "piece long, level int, block int, size int, top long, ids binary, n binary"


def cut(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Words between white space, A-Z lower-cased, of all texts in one array, and how many each text has."""
    each = [t.encode() for t in texts]
    raw = b" " + b" ".join(each).lower() + b" "
    space = np.frombuffer(raw.translate(_IS_SPACE), bool)
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    bounds = np.cumsum([1, *(len(t) + 1 for t in each)])
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(raw.translate(None, _SPACE))]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers), np.diff(np.searchsorted(starts, bounds))


def pieces(docs: DataFrame) -> DataFrame:
    """piece, n_words, doc_ids and sizes (words of each text), words (distinct, by crc32, a space between them), n (how often
    each occurs) and places (which of them stands at each place), written to the shared folder."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts in chunks(batches, ("doc_id", "text")):
            words, sizes = cut(texts)
            words = words.dictionary_encode()
            own = words.dictionary.to_pylist()
            by_hash = np.argsort(np.fromiter(map(crc32, own), np.uint32, len(own)), kind="stable")
            rank = np.empty(len(own), np.int32)
            rank[by_hash] = np.arange(len(own), dtype=np.int32)
            places = rank[words.indices.to_numpy()]
            n = np.bincount(places, minlength=len(own)).astype(np.int32)
            yield pa.record_batch(
                [
                    pa.array([len(places)], pa.int64()),
                    pa.array([doc_ids], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([b" ".join(own[i] for i in by_hash.tolist())], pa.binary()),
                    pa.array([n.tobytes()], pa.binary()),
                    pa.array([_packed(places)], pa.binary()),
                ],
                names=["n_words", "doc_ids", "sizes", "words", "n", "places"],
            )

    schema = "n_words long, doc_ids array<long>, sizes array<int>, words binary, n binary, places binary"
    found = id_and_text(docs).mapInArrow(rows, schema)
    return materialize(found.withColumn("piece", F.monotonically_increasing_id()), "pieces", compression="zstd")


def _packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, compressed: the low bytes of all come first, then the next."""
    return pa.compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, size: int) -> np.ndarray:
    if not size:
        return np.zeros(0, np.int32)
    planes = np.frombuffer(pa.decompress(data, 4 * size, codec="zstd", asbytes=True), np.uint8)
    return np.frombuffer(planes.reshape(4, size).T.tobytes(), np.int32)


def _sent(piece: int, blocks: np.ndarray, keys, n: np.ndarray, join) -> pa.Table:
    """A row for each block: the keys that go there, which follow each other, and how often the piece holds each."""
    first = np.flatnonzero(np.diff(blocks, prepend=-1))
    spans = list(zip(first.tolist(), [*first[1:].tolist(), len(blocks)]))
    return pa.table(
        {
            "block": pa.array(blocks[first], pa.int32()),
            "piece": pa.array([piece] * len(spans), pa.int64()),
            "size": pa.array([b - a for a, b in spans], pa.int32()),
            "keys": pa.array([join(keys[a:b]) for a, b in spans], pa.binary()),
            "n": pa.array([n[a:b].tobytes() for a, b in spans], pa.binary()),
        }
    )


def _blocks(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """The block of each 32-bit hash; blocks follow each other as hashes do."""
    return (hashes.astype(np.uint64) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def send_words(cut_up: DataFrame, blocks: int) -> DataFrame:
    """The distinct words of each piece, dealt to blocks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, words, n in zip(*(batch.column(c) for c in ("piece", "words", "n"))):
                own = words.as_py().split()
                hashes = np.fromiter(map(crc32, own), np.uint32, len(own))
                n = np.frombuffer(n.as_py(), np.int32)
                yield from _sent(piece.as_py(), _blocks(hashes, blocks), own, n, b" ".join).to_batches()

    return cut_up.select("piece", "words", "n").mapInArrow(rows, _SENT)


def send_ngrams(cut_up: DataFrame, answers: DataFrame, order: int, blocks: int, span: int, part: range) -> DataFrame:
    """The distinct n-grams of each piece that may occur often enough and belong to some blocks, dealt to these."""

    def rows(piece: pa.Table, own: pa.Table) -> pa.Table:
        text = Piece(piece, own, order - 1, span)
        keys, _, n = text.keys(order)
        to = _blocks(keys >> np.uint64(32), blocks)
        due = slice(*np.searchsorted(to, (part.start, part.stop)))
        return _sent(text.piece, to[due], keys[due], n[due].astype(np.int32), np.ndarray.tobytes)

    return _meet(cut_up, answers).applyInArrow(rows, _SENT)


def _small(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest of them needs."""
    return values.astype(np.min_scalar_type(values.max())).tobytes()


def count(sent: DataFrame, level: int, least: int, blocks: int, last: bool = False) -> DataFrame:
    """Answers to all pieces, written to the shared folder: for each key sent, its number (from 1 on; 0 with fewer than
    ``least`` occurrences) and its count over all texts (words: always; n-grams: 0 with fewer than ``least``).

    ``top`` is a bound of the numbers.  The ``last`` order needs no numbers and has null.
    """

    def rows(block: pa.Table) -> pa.Table:
        number, sizes = block["block"][0].as_py(), block["size"].to_numpy()
        n = np.frombuffer(b"".join(block["n"].to_pylist()), np.int32)
        if level == 1:
            keys = pa.array(b" ".join(block["keys"].to_pylist()).split(), pa.large_binary()).dictionary_encode()
            index = keys.indices.to_numpy()
        else:
            keys = np.frombuffer(b"".join(block["keys"].to_pylist()), np.uint64)
            index = np.unique(keys, return_inverse=True)[1]
        sums = np.bincount(index, weights=n).astype(np.int64)
        often = sums >= least
        ids = np.where(often, (np.cumsum(often) - 1) * blocks + number + 1, 0)
        top = int(ids.max())
        if level > 1:
            sums = np.where(often, sums, 0)
        ends = np.cumsum(sizes)[:-1]
        return pa.table(
            {
                "piece": block["piece"],
                "level": pa.array([level] * len(sizes), pa.int32()),
                "block": block["block"],
                "size": block["size"],
                "top": pa.array([top] * len(sizes), pa.int64()),
                "ids": pa.nulls(len(sizes), pa.binary()) if last else pa.array(list(map(_small, np.split(ids[index], ends))), pa.binary()),
                "n": pa.array(list(map(_small, np.split(sums[index], ends))), pa.binary()),
            }
        )

    label = "words" if level == 1 else f"grams-{level}"
    return materialize(sent.groupBy("block").applyInArrow(rows, _ANSWER), label, compression="zstd")


def _meet(cut_up: DataFrame, answers: DataFrame):
    """Each piece with its answers."""
    left = cut_up.select("piece", "n_words", "doc_ids", "sizes", "places")
    return left.groupBy("piece").cogroup(answers.drop("top").groupBy("piece"))


class Piece:
    """A piece and its answers up to some order: the number and the count of the n-gram that begins at each place."""

    def __init__(self, piece: pa.Table, answers: pa.Table, order: int, span: int):
        row = piece.to_pylist()[0]
        self.piece, self.doc_ids, self.span, words = row["piece"], row["doc_ids"], np.uint64(span), row["n_words"]
        self.sizes = np.array(row["sizes"], np.int64)
        #: How many words there are before each in its text.
        self.before = np.arange(words) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        own = answers.sort_by([("level", "ascending"), ("block", "ascending")]).to_pydict()
        self.numbers, self.counts = [], []
        for k in range(1, order + 1):
            at, index = (slice(None), _unpacked(row["places"], words)) if k == 1 else self.keys(k)[1]
            for name, all_of in (("ids", self.numbers), ("n", self.counts)):
                found = [
                    np.frombuffer(x, f"<u{len(x) // size}")
                    for x, size, level in zip(own[name], own["size"], own["level"])
                    if level == k and x is not None
                ]
                values = np.zeros(words, np.int64)
                if found:
                    values[at] = np.concatenate(found, dtype=np.int64, casting="unsafe")[index]
                all_of.append(values)

    def keys(self, k: int) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray]:
        """Distinct keys of the n-grams of ``k`` words that may occur often enough; the places where these begin, and which
        key each has; how often each key occurs."""
        below, single = self.numbers[k - 2], self.numbers[0]
        at = np.flatnonzero((below[:-1] > 0) & (below[1:] > 0) & (self.before[1:] > 0))
        keys = (below[at].astype(np.uint64) * self.span + single[at + k - 1].astype(np.uint64)) * _SPREAD
        keys, index, n = np.unique(keys, return_inverse=True, return_counts=True)
        return keys, (at, index), n


def score(
    docs: DataFrame,
    order: int = ORDER,
    size: int = VOCABULARY,
    least: int = LEAST,
    backoff: float = BACKOFF,
) -> DataFrame:
    """One row per doc_id: n_words, logprob (natural log, summed over words) and per_word.

    The model is counted over ``docs``, every word of them.  ``order`` is 2 or 3.  A word with fewer words before it than
    ``order`` - 1 is scored with what it has.  Rows that share a doc_id, null included, are scored as one document.  No
    words: 0 and a null ``per_word``.  ``size`` once bounded the words with short keys; it never changed the result, and
    now nothing depends on it.
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    if not 0 < size <= VOCABULARY:
        raise ValueError(f"the vocabulary holds 1 to {VOCABULARY} words")
    cut_up = pieces(docs)
    total = cut_up.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    blocks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + total // HOT_SHARE)
    answers = count(send_words(cut_up, blocks), 1, least, blocks)
    span = top = 1 + (answers.agg(F.max("top")).first()[0] or 0)
    for k in range(2, order + 1):
        if top * span >= 1 << 64:
            raise OverflowError(f"{top} and {span} numbers do not fit a key")
        found = [
            count(send_ngrams(cut_up, answers, k, blocks, span, range(a, z)), k, least, blocks, last=k == order)
            for a, z in pairwise(blocks * i // SLICES for i in range(SLICES + 1))
        ]
        answers = reduce(DataFrame.unionByName, found, answers)
        top = 1 + (answers.agg(F.max("top")).first()[0] or 0)

    def rows(piece: pa.Table, own: pa.Table) -> pa.Table:
        text = Piece(piece, own, order, span)
        scores = np.log(text.counts[0]) - log(max(total, 1))
        for k in range(2, order + 1):
            ends = np.flatnonzero(text.before >= k - 1)
            n, of = text.counts[k - 1][ends - k + 1], text.counts[k - 2][ends - k + 1]
            seen = n > 0
            scores[ends[~seen]] += log(backoff)
            scores[ends[seen]] = np.log(n[seen] / of[seen])
        text_of = np.repeat(np.arange(len(text.sizes)), text.sizes)
        return pa.table(
            {
                "doc_id": pa.array(text.doc_ids, pa.int64()),
                "n_words": pa.array(text.sizes),
                "logprob": pa.array(np.bincount(text_of, weights=scores, minlength=len(text.sizes))),
            }
        )

    scored = _meet(cut_up, answers).applyInArrow(rows, "doc_id long, n_words long, logprob double")
    sums = scored.groupBy("doc_id").agg(F.sum("n_words").alias("n_words"), F.sum("logprob").alias("logprob"))
    return sums.withColumn("per_word", F.when(F.col("n_words") > 0, F.col("logprob") / F.col("n_words")))
