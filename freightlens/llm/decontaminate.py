"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

1. Every n-gram of a test item is a seed, however often the documents hold it, so a copy with edits in every stretch is
   found as long as ``n`` of its words in a row are left.
2. Documents that share a seed with an item are cut to passages around the hits, wide enough for any alignment that can
   reach the score asked for.  A passage that holds too few of the item's words for that score, which is most of those
   that share a commonplace n-gram only, is left out; no alignment in it could reach the score.
3. Each other passage is aligned with the item by words.  The score is the best local alignment's over that of the item
   with itself.

Items are taken in blocks of about ``BLOCK_WORDS`` words, each broadcast and held against all documents; documents are
never shuffled, so a leak in a third of all rows costs each task its share.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlens.llm.common import id_and_text
from freightlens.llm.tokens import chunks

N, LEAST = 3, 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of the items of one block: bounds what is broadcast.
BLOCK_WORDS = 1_000_000
#: Hits, and words of passages, that are looked through at once.
AT_ONCE = 1_000_000
_WORD = regex.compile(r"\w+")
FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("passage", T.StringType()),
    ]
)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Block:
    """Items as arrays of word numbers; words outside the block have number 0."""

    numbers: dict[str, int]
    names: list[int]  # item_id of each item
    items: list[np.ndarray]
    own: np.ndarray  # sorted (item, word) of the items' words, as one number
    own_counts: np.ndarray
    seeds: np.ndarray  # sorted keys
    ends: np.ndarray  # the places of a key are those from its end in this array to the next
    places: np.ndarray  # rows of (item, position)

    def keys(self, ids: np.ndarray, n: int) -> np.ndarray:
        """The key of each n-gram, -1 where a word is outside the block."""
        size = len(ids) - n + 1
        if size <= 0:
            return np.zeros(0, np.int64)
        key, known, base = np.zeros(size, np.uint64), np.ones(size, bool), np.uint64(len(self.numbers) + 1)
        for k in range(n):
            part = ids[k : k + size]
            key = key * base + part.astype(np.uint64)
            known &= part > 0
        return np.where(known, key.view(np.int64) & np.int64(2**63 - 1), -1)

    def ids(self, text: str) -> np.ndarray:
        get = self.numbers.get
        return np.array([get(w, 0) for w in words(text)], np.int64)


def _block(rows: list, n: int) -> Block:
    split = [words(r["text"]) for r in rows]
    numbers = {w: i + 1 for i, w in enumerate(sorted({w for ws in split for w in ws}))}
    items = [np.array([numbers[w] for w in ws], np.int64) for ws in split]
    base = len(numbers) + 1
    flat = np.concatenate([np.zeros(0, np.int64), *(i * base + ids for i, ids in enumerate(items))])
    own, own_counts = np.unique(flat, return_counts=True)
    none = np.zeros(0, np.int64)
    block = Block(numbers, [r["item_id"] for r in rows], items, own, own_counts, none, none, np.zeros((0, 2), np.int64))
    keys = [block.keys(ids, n) for ids in items]
    places = [np.column_stack([np.full(len(k), i), np.arange(len(k))]) for i, k in enumerate(keys)]
    flat = np.concatenate([none, *keys])
    order = np.argsort(flat, kind="stable")
    block.seeds, first = np.unique(flat[order], return_index=True)
    block.ends = np.append(first, len(flat))
    block.places = np.concatenate([block.places, *places])[order]
    return block


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: its score, and the first and last place of ``passage`` in it (-1, -1: none).

    ``passage`` may hold 0 for unknown words, which match nothing.  Smith-Waterman with a linear gap cost, one row of the
    table at a time; a second table carries where each alignment began.
    """
    size = len(passage)
    score, begin = np.zeros(size + 1, np.int64), np.arange(size + 1)
    steps = np.arange(size + 1)
    best, span = 0, (-1, -1)
    for word in item:
        hit = np.where(passage == word, MATCH, MISMATCH)
        new, origin = np.zeros(size + 1, np.int64), np.arange(size + 1)
        diagonal, above = score[:-1] + hit, score[1:] + GAP
        new[1:] = np.maximum(np.maximum(diagonal, above), 0)
        origin[1:] = np.where(new[1:] == 0, steps[1:], np.where(new[1:] == diagonal, begin[:-1], begin[1:]))
        raised = new - GAP * steps
        top = np.maximum.accumulate(raised)
        source = np.maximum.accumulate(np.where(raised == top, steps, 0))
        along = top + GAP * steps
        better = along > new
        new = np.where(better, along, new)
        origin = np.where(better, origin[source], origin)
        score, begin = new, origin
        at = int(score.argmax())
        if score[at] > best:
            best, span = int(score[at]), (int(begin[at]), at - 1)
    return best, *span


def _slices(sizes: np.ndarray) -> Iterator[slice]:
    """Neighbours of about AT_ONCE together."""
    total, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        end = max(begin + 1, int(np.searchsorted(total, total[begin] - sizes[begin] + AT_ONCE, side="right")))
        yield slice(begin, end)
        begin = end


def _enough(block: Block, flat: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray, least: float) -> np.ndarray:
    """Whether each passage ``flat[low:high]`` has as many words of its item, each as often as there at most, as a score of
    ``least`` takes."""
    base, sizes, shared = len(block.numbers) + 1, high - low, []
    for some in _slices(sizes):
        passage = np.repeat(np.arange(some.start, some.start + len(sizes[some])), sizes[some])
        start = np.repeat(low[some] - np.cumsum(sizes[some]) + sizes[some], sizes[some])
        word = flat[start + np.arange(len(passage))]
        key = item[passage] * base + word
        at = np.minimum(np.searchsorted(block.own, key), len(block.own) - 1)
        hit = (block.own[at] == key) & (word > 0)
        pair, n = np.unique((passage[hit] - some.start) * len(block.own) + at[hit], return_counts=True)
        n = np.minimum(n, block.own_counts[pair % len(block.own)])
        shared.append(np.bincount(pair // len(block.own), weights=n, minlength=len(sizes[some])))
    length = np.array([len(ids) for ids in block.items])
    return np.concatenate(shared) / length[item] >= least


def _passages(block: Block, texts: list[str], n: int, least: float) -> Iterator[tuple[int, int, np.ndarray, list[tuple[int, int]]]]:
    """(text, item, word numbers of the text, passages) of the items that may be found in a text."""
    parts = [block.ids(t) for t in texts]
    # Texts are joined by a word that no item has.
    begin = np.cumsum([0] + [len(p) + 1 for p in parts])
    flat = np.concatenate([x for p in parts for x in (p, [0])]).astype(np.int64)
    keys = block.keys(flat, n)
    places = np.flatnonzero(keys >= 0)
    at = np.minimum(np.searchsorted(block.seeds, keys[places]), len(block.seeds) - 1)
    hit = block.seeds[at] == keys[places]
    places, at = places[hit], at[hit]
    of = np.searchsorted(begin, places, side="right") - 1
    counts = block.ends[at + 1] - block.ends[at]
    length = np.array([len(ids) for ids in block.items])
    # The most gaps that leave an alignment of all words the score.
    slack = np.floor(MATCH * length * (1 - least) / -GAP).astype(np.int64) + n
    texts_at, first = np.unique(of, return_index=True)
    for some in _slices(np.add.reduceat(counts, first) if len(first) else counts):
        some = slice(first[some.start], first[some.stop] if some.stop < len(first) else len(of))
        many = counts[some]
        entry = np.repeat(block.ends[at[some]] - np.cumsum(many) + many, many) + np.arange(many.sum())
        item, position = block.places[entry].T
        text, start = np.repeat(of[some], many), np.repeat(places[some], many) - position
        order = np.lexsort((start, item, text))
        item, text, start = item[order], text[order], start[order]
        low = np.maximum(begin[text], start - slack[item])
        high = np.minimum(begin[text + 1] - 1, start + length[item] + slack[item])
        new = np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (low[1:] > high[:-1]))
        last = np.append(new[1:], True)
        text, item, low, high = text[new], item[new], low[new], high[last]
        may = _enough(block, flat, item, low, high, least)
        spans = defaultdict(list)
        for t, i, a, z in zip(*(x[may].tolist() for x in (text, item, low, high))):
            spans[t, i].append((a - int(begin[t]), z - int(begin[t])))
        for (t, i), found in spans.items():
            yield t, i, parts[t], found


def _matches(block: Block, texts: list[str], n: int, least: float) -> Iterator[tuple[int, int, float, int, int, str]]:
    """(text, item_id, score, first word, last word, passage) of each item of the block found in a text, at its best place."""
    if not texts or not len(block.seeds):
        return
    for text, item, ids, passages in _passages(block, texts, n, least):
        own = block.items[item]
        best, first, last = max(
            ((s, low + a, low + z) for low, high in passages for s, a, z in [align(own, ids[low:high])]),
            key=lambda x: (x[0], -x[1]),
        )
        score = best / (MATCH * len(own))
        if score >= least:
            yield text, block.names[item], score, first, last, " ".join(words(texts[text])[first : last + 1])


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list]:
    rows = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = F.size(F.split("text", r"\s+"))
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_words))
    for i in range(blocks):
        found = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i).orderBy("item_id", "text").collect()
        # An item_id that repeats with other texts is one item, its texts one after another.
        merged: dict[int, str] = {}
        for r in found:
            merged[r["item_id"]] = f"{merged[r['item_id']]} {r['text']}" if r["item_id"] in merged else r["text"]
        yield [{"item_id": i, "text": t} for i, t in merged.items()]


def seeded_blocks(benchmark: DataFrame, n: int, block_words: int) -> Iterator[Block]:
    """The blocks of ``benchmark`` that have seeds."""
    for rows in _blocks(benchmark, block_words):
        block = _block(rows, n)
        if len(block.seeds):
            yield block


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = N,
    least: float = LEAST,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document and test item found in it: doc_id, item_id, score, first_word, last_word, passage.

    Words are runs of letters, digits and underscores, lower-cased.  ``score`` is 1 for a verbatim copy.  Null texts, null
    item ids and items of fewer than ``n`` words find nothing, nor does a copy that keeps no ``n`` words in a row; rows
    that repeat are found each.
    """
    rows, out = id_and_text(docs), None
    for block in seeded_blocks(benchmark, n, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for doc_ids, texts in chunks(batches, ("doc_id", "text")):
                found = [(doc_ids[i], *m) for i, *m in _matches(shared.value, texts, n, least)]
                columns = list(zip(*found)) or [()] * len(FOUND)
                types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=FOUND.names)

        part = rows.mapInArrow(find, FOUND)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], FOUND) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item of ``benchmark`` is found."""
    for block in seeded_blocks(benchmark, N, BLOCK_WORDS):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clear: list[bool] = []
                for (texts,) in chunks([batch], ("text",)):
                    leaks = {m[0] for m in _matches(shared.value, [t or "" for t in texts], N, least)}
                    clear += [i not in leaks for i in range(len(texts))]
                yield batch.filter(pa.array(clear, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
