"""Removal of word sequences that repeat, by suffix automata of reference shards and matching statistics.

The reference of a corpus is the corpus.  An automaton of all of it fits no machine, and a document need not meet shards
that share nothing with it, so shards are made by content:

1. The smallest hash of the short n-grams in a window is the window's anchor; equal windows have equal anchors.  Runs of
   windows with one anchor are written as (anchor, digest of the run's words, place).
2. An anchor that occurs once holds no repeat.  Where all runs of an anchor have one digest, all their words repeat.
3. The runs of every other anchor form a reference shard.  Its distinct passages build a suffix automaton with
   occurrence counts, each passage is streamed through it, and windows whose factor occurs twice are spans to remove.
4. A shard with very many runs would be a large group in one task.  Its anchors are few, by their share of all runs, and
   runs that are equal repeat as a whole, and the windows of one run of each kind are compared as 128-bit hashes.

Spans of a document are merged and cut out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlens.llm.common import materialize
from freightlens.llm.suffix_automaton import SuffixAutomaton
from freightlens.llm.tokens import chunks

WINDOW, SEED = 35, 8
#: Runs of an anchor above which it is hot, and the share of all runs that it has then at least.
HOT_RUNS, HOT_SHARE = 2000, 10_000
CHUNK = 2_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i below ``size``; kept by the worker."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < size:
        size = max(size, 2 * CHUNK)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        have = _POWERS[base] = tuple(both)
    return have


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ranges(values: np.ndarray, base: int):
    """A function that hashes values[a:b] for arrays of a and b: sums of values times powers, shifted to a."""
    up, down = _powers(base, len(values) + 1)
    sums = np.concatenate(([np.uint64(0)], np.cumsum((values + np.uint64(1)) * up[: len(values)])))
    return lambda a, b: _mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))


class Words:
    """Hashes of the words of some texts, word by word, and where each text's words begin (one more entry: the end)."""

    def __init__(self, texts: list[str]):
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", np.uint8)
        gap = _SPACE[data]
        first = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
        last = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
        self.hashes = _ranges(data.astype(np.uint64), _BASES[0])(first, last)
        self.begin = np.searchsorted(first, np.cumsum([1] + [len(r) + 1 for r in raw]))

    def windows(self, window: int) -> np.ndarray:
        """Starts of all windows that lie in one text."""
        size = np.maximum(0, np.diff(self.begin) - window + 1)
        return np.arange(size.sum()) + np.repeat(self.begin[:-1] - (np.cumsum(size) - size), size)

    def anchors(self, starts: np.ndarray, window: int, seed: int) -> np.ndarray:
        """The anchor of each window."""
        n = len(self.hashes)
        if n < window:
            return np.zeros(0, np.uint64)
        at = np.arange(n - seed + 1)
        low, have, want = _ranges(self.hashes, _BASES[1])(at, at + seed), 1, window - seed + 1
        while have < want:
            step = min(have, want - have)
            low = np.minimum(low[: len(low) - step], low[step:])
            have += step
        return low[starts]


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text and uid, which tells rows with one doc_id and different texts apart."""
    text = F.coalesce(docs["text"], F.lit(""))
    doc_id = docs["doc_id"].cast("long")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text, F.lit(1)).alias("uid"), text.alias("text"))


def runs(rows: DataFrame, window: int, seed: int) -> DataFrame:
    """anchor, digest, uid, a and b of each maximal run of windows a to b with one anchor; ``seeds`` is 2 if the run
    may hold its anchor twice, else 1."""
    schema = "anchor long, digest long, uid long, a int, b int, seeds int"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uids, texts in chunks(batches, ("uid", "text"), limit=CHUNK):
            words = Words(texts)
            starts = words.windows(window)
            if not len(starts):
                continue
            anchors = words.anchors(starts, window, seed)
            new = np.ones(len(starts), bool)
            new[1:] = (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1)
            head = np.flatnonzero(new)
            tail = np.concatenate((head[1:], [len(starts)])) - 1
            a, b = starts[head], starts[tail]
            doc = np.searchsorted(words.begin, a, side="right") - 1
            digest = _ranges(words.hashes, _BASES[2])(a, b + window)
            short = words.begin[doc]
            yield pa.record_batch(
                [
                    pa.array(anchors[head].view(np.int64)),
                    pa.array(digest.view(np.int64)),
                    pa.array(np.array(uids, np.int64)[doc]),
                    pa.array((a - short).astype(np.int32)),
                    pa.array((b - short).astype(np.int32)),
                    pa.array(1 + _twice(words, a, b, window, seed).astype(np.int32)),
                ],
                names=["anchor", "digest", "uid", "a", "b", "seeds"],
            )

    return rows.select("uid", "text").mapInArrow(find, schema)


def _twice(words: Words, a: np.ndarray, b: np.ndarray, window: int, seed: int) -> np.ndarray:
    """Whether a run may hold its anchor at two places: some n-gram in it has an equal one shortly before."""
    at = np.arange(len(words.hashes) - seed + 1)
    every = _ranges(words.hashes, _BASES[1])(at, at + seed)
    order = np.lexsort((at, every))
    again = np.zeros(len(every), bool)
    same = every[order][1:] == every[order][:-1]
    near = order[1:] - order[:-1] < (b - a).max() + window
    again[order[1:][same & near]] = True
    before = np.concatenate(([0], np.cumsum(again)))
    return before[np.minimum(b + window - seed + 1, len(every))] > before[np.minimum(a + 1, len(every))]


def _shard(passages: list[tuple[bytes, int]], window: int) -> list[list[int]]:
    """The starts of windows that occur twice or more among the passages of a shard, for each; passages are distinct
    and come with their number of copies."""
    numbers: dict[bytes, int] = {}
    coded = [[numbers.setdefault(w, len(numbers)) for w in p.split(b" ")] for p, _ in passages]
    automaton = SuffixAutomaton()
    for code, (_, times) in zip(coded, passages):
        automaton.add(code, times)
    automaton.close()
    return [
        [end - window + 1 for end, (_, times) in enumerate(automaton.statistics(code, window)) if times > 1]
        for code in coded
    ]


def _spans(starts: list[int], base: int, window: int) -> Iterator[tuple[int, int]]:
    """Merged word spans of windows."""
    begin = end = None
    for s in starts:
        if end is not None and s + base <= end:
            end = s + base + window
            continue
        if end is not None:
            yield begin, end
        begin, end = s + base, s + base + window
    if end is not None:
        yield begin, end


def _hot_spans(rows: DataFrame, hot_runs: DataFrame, hot: np.ndarray, window: int, seed: int) -> DataFrame:
    """Spans (uid, a, z) of the repeated windows of hot anchors; ``hot_runs`` are their rows of :func:`runs`.

    Runs with equal digests repeat as a whole.  Only one run of each digest is taken apart into windows.
    """
    shared = rows.sparkSession.sparkContext.broadcast(np.sort(hot.astype(np.int64).view(np.uint64)))
    same = hot_runs.groupBy("anchor", "digest").agg(F.count("*").alias("n"), F.min(F.struct("uid", "a", "b")).alias("one"))
    same = materialize(same.select("anchor", "digest", "n", "one.*"), "hot-runs")
    often = same.where("n > 1").select(F.col("anchor").alias("_anchor"), F.col("digest").alias("_digest"))
    again = hot_runs.join(often, (F.col("anchor") == F.col("_anchor")) & (F.col("digest") == F.col("_digest")), "left_semi")
    whole = again.select("uid", "a", (F.col("b") + window).alias("z"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per text that has windows of hot anchors: where they start, and their hashes."""
        for uids, texts in chunks(batches, ("uid", "text"), limit=CHUNK):
            words = Words(texts)
            starts = words.windows(window)
            starts = starts[np.isin(words.anchors(starts, window, seed), shared.value)]
            doc = np.searchsorted(words.begin, starts, side="right") - 1
            own, first = np.unique(doc, return_index=True)
            cuts = pa.array(np.append(first, len(starts)).astype(np.int32))
            keys = [_ranges(words.hashes, b)(starts, starts + window).view(np.int64) for b in _BASES[:2]]
            place = (starts - words.begin[doc]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (place, *keys)]
            yield pa.record_batch([pa.array(np.array(uids, np.int64)[own]), *lists], names=["_uid", "s", "w1", "w2"])

    hashes = rows.select("uid", "text").mapInArrow(find, "_uid long, s array<int>, w1 array<long>, w2 array<long>")
    ones = same.groupBy("uid").agg(F.collect_list(F.struct("a", "b", "n")).alias("runs"))
    # Rows that repeat a document have one uid; one of them will do.
    apart = hashes.join(ones, F.col("_uid") == F.col("uid")).dropDuplicates(["uid"]).select(
        "uid", F.explode("runs").alias("r"), F.arrays_zip("s", "w1", "w2").alias("ws")
    )
    inside = F.filter("ws", lambda w: (w["s"] >= F.col("r.a")) & (w["s"] <= F.col("r.b")))
    windows = apart.select("uid", F.col("r.n").alias("n"), F.explode(inside).alias("w")).select("uid", "n", "w.*")
    windows = materialize(windows, "hot-windows")
    known = windows.groupBy("w1", "w2").agg(F.sum("n").alias("times")).where("times > 1").select("w1", "w2")
    single = windows.where("n = 1").join(known, ["w1", "w2"], "left_semi")
    return whole.unionByName(single.select("uid", F.col("s").alias("a"), (F.col("s") + window).alias("z")))


def repeated_spans(rows: DataFrame, window: int, seed: int, hot_runs: int) -> DataFrame:
    """Word spans (uid, a, z: from a up to z) that windows which repeat cover; spans of one text may overlap."""
    spark = rows.sparkSession
    found = materialize(runs(rows, window, seed), "runs")
    sizes = found.groupBy("anchor").agg(
        F.count("*").alias("n"), F.sum("seeds").alias("seeds"), F.min("digest").alias("d"), F.max("digest").alias("e")
    )
    total = found.count()
    limit = max(hot_runs, total // HOT_SHARE)
    mixed = (F.col("seeds") > F.col("n")) | (F.col("d") != F.col("e"))
    kinds = sizes.where("seeds > 1").select(
        F.col("anchor").alias("_anchor"),
        F.when(~mixed, 0).when(F.col("n") <= limit, 1).otherwise(2).alias("kind"),
    )
    shared = materialize(found.join(kinds, F.col("anchor") == F.col("_anchor")).drop("_anchor", "seeds"), "shared")
    # At most HOT_SHARE anchors have more than one in HOT_SHARE of all runs.
    hot = np.array([r[0] for r in shared.where("kind = 2").select("anchor").distinct().collect()], np.int64)
    whole = shared.where("kind = 0").select("uid", "a", (F.col("b") + window).alias("z"))

    places = shared.where("kind = 1").groupBy("uid").agg(F.collect_list(F.struct("anchor", "a", "b")).alias("runs"))
    places = places.withColumnRenamed("uid", "_uid")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uids, texts, lists in chunks(batches, ("uid", "text", "runs"), limit=CHUNK):
            out: list[tuple] = []
            for uid, text, own in zip(uids, texts, lists):
                words = text.encode().split()
                out += [(r["anchor"], b" ".join(words[r["a"] : r["b"] + window]), uid, r["a"]) for r in own]
            columns = list(zip(*out)) or [()] * 4
            types = [pa.int64(), pa.binary(), pa.int64(), pa.int32()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["anchor", "passage", "uid", "a"])

    passages = rows.select("uid", "text").join(places, F.col("uid") == F.col("_uid")).drop("_uid")
    passages = passages.mapInArrow(cut, "anchor long, passage binary, uid long, a int")
    spans = T.StructType([T.StructField("uid", T.LongType())] + [T.StructField(c, T.IntegerType()) for c in "az"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shards one after another; no more than the runs of one anchor are held."""
        anchor, own = None, {}

        def results() -> Iterator[tuple[int, int, int]]:
            if sum(map(len, own.values())) == 0:
                return
            shard = [(p, len(x)) for p, x in own.items()]
            for (_, places), starts in zip(own.items(), _shard(shard, window)):
                for uid, a in places:
                    for begin, end in _spans(starts, a, window):
                        yield uid, begin, end

        def batch(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 3
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32()))], names=spans.names)

        for b in batches:
            out: list[tuple] = []
            for key, passage, uid, a in zip(*(b.column(c).to_pylist() for c in ("anchor", "passage", "uid", "a"))):
                if key != anchor:
                    out += results()
                    anchor, own = key, {}
                own.setdefault(passage, []).append((uid, a))
            yield batch(out)
        yield batch(list(results()))

    # A shuffle by anchor: hot anchors are not among these.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = passages.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(compare, spans)
    both = whole.unionByName(shards)
    if not len(hot):
        return both
    return both.unionByName(_hot_spans(rows, shared.where("kind = 2"), hot, window, seed))


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, hot_runs: int = HOT_RUNS) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans (removed, from word a up to z) and kept (text).

    Words are what blanks, tabs, line feeds, vertical tabs, form feeds and carriage returns leave.  A word goes if it lies
    in ``window`` words in a row that also start anywhere else in the table, the same document included.  Kept words are
    joined by blanks.  A null text has no words.  Rows that repeat lose what they share.
    """
    rows = _texts(docs)
    spans = repeated_spans(rows, window, seed, hot_runs)
    per_text = spans.distinct().groupBy(F.col("uid").alias("_uid")).agg(F.array_sort(F.collect_list(F.struct("a", "z"))).alias("spans"))
    joined = rows.join(per_text, F.col("uid") == F.col("_uid"), "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_words long, n_removed long, spans array<struct<a:int,z:int>>, kept string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.int32()), ("z", pa.int32())]))
        for doc_ids, texts, lists in chunks(batches, ("doc_id", "text", "spans"), limit=CHUNK):
            sizes, gone, merged, kept = [], [], [], []
            for text, own in zip(texts, lists):
                words = text.encode().split()
                out: list[dict] = []
                for s in own or ():
                    if out and s["a"] <= out[-1]["z"]:
                        out[-1]["z"] = max(out[-1]["z"], s["z"])
                    else:
                        out.append({"a": s["a"], "z": s["z"]})
                stay, at = [], 0
                for s in out:
                    stay += words[at : s["a"]]
                    at = s["z"]
                stay += words[at:]
                sizes.append(len(words))
                gone.append(len(words) - len(stay))
                merged.append(out)
                kept.append(b" ".join(stay).decode())
            yield pa.record_batch(
                [pa.array(doc_ids, pa.int64()), pa.array(sizes), pa.array(gone), pa.array(merged, kind), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    return joined.mapInArrow(cut, schema)
