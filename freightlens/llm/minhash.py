"""Near-duplicates by MinHash signatures and an inverted join over their coordinates.

1. A document's set is hashed; its signature has one minimum per coordinate, mixed with the coordinate's number, so that
   a coordinate and its value are one token.  Documents with equal sets are one class and go on as one.
2. Two sets of similarity s agree in each coordinate with a chance of s.  Pairs that agree in ``MATCHES`` of the
   ``COORDINATES`` are candidates; a pair of similarity 0.85 has fewer with a chance of 5e-7.
3. Tokens are counted, and a class's tokens ordered from the rarest on.  Classes that share m of k tokens share one of
   the k - m + 1 rarest of each (prefix filter), so only those are posted.  Tokens of one class are never posted, and a
   class with fewer than m others posts nothing.  All other tokens are skipped until two classes meet: a meeting counts
   all their collisions, and only under the rarest token that they both posted.
4. Lists of up to ``SHORT`` classes are paired in place.  In a longer list each class meets the list's first one only.
5. Candidates are confirmed on full sets, in tiles: the texts that a tile's pairs need come once, and pairs that earlier
   links of the tile have connected are passed over.
6. What long lists then leave apart, and nothing else, is compared in blocks of full sets: of the classes that long lists
   hold together, those outside the largest component meet all.  A block counts all its pairs as a product of 0/1
   matrices and returns only links that connect.  So no link between components is lost, no pair becomes a row, and a
   large group of copies that are linked through its first class is never paired.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import block_of, blocks, id_and_text, materialize, ordered
from freightlens.llm.graph import components
from freightlens.llm.tokens import chunks

WORDS, PERCENT, SEED = 5, 85, 42
COORDINATES, MATCHES = 32, 16
#: Classes of a list that are paired in place, classes of a longer list that meet in one group, texts on a tile's side.
SHORT, BLOCK, TILE = 64, 1000, 256
#: Documents of one class that learn its component in one group.
MEMBERS = 10_000
_DRAWN = np.random.default_rng(SEED).integers(0, 1 << 64, (3, COORDINATES, 1), np.uint64)
#: Shingles that all minima are taken of at once.
AT_ONCE = 8192


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles.  Words are what white space (blank, tab to carriage return) leaves, A-Z
    lower-cased; fewer than ``words`` are one shingle, none give an empty set."""
    from xxhash import xxh64_intdigest

    parts = text.encode().lower().split()
    size = min(words, len(parts)) or 1
    each = map(b" ".join, zip(*(islice(parts, i, None) for i in range(size))))
    return np.unique(np.fromiter((xxh64_intdigest(s, SEED) for s in each), np.uint64))


def signature(hashes: np.ndarray) -> np.ndarray:
    """A token per coordinate."""
    low = np.full(COORDINATES, (1 << 64) - 1, np.uint64)
    for i in range(0, len(hashes), AT_ONCE):
        mixed = (hashes[None, i : i + AT_ONCE] ^ _DRAWN[0]) * (_DRAWN[1] | np.uint64(1))
        low = np.minimum(low, (mixed ^ (mixed >> np.uint64(32))).min(axis=1))
    token = (low ^ _DRAWN[2, :, 0]) * np.uint64(0x9E3779B97F4A7C15)
    return token ^ (token >> np.uint64(29))


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def prints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, set_key (a 128-bit digest of the set), n_shingles and the signature of every document."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts in chunks(batches, ("doc_id", "text")):
            sets = [shingle_hashes(t, words) for t in texts]
            columns = [
                pa.array(doc_ids, pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([signature(s).view(np.int64).tolist() for s in sets], pa.list_(pa.int64())),
            ]
            yield pa.record_batch(columns, names=["doc_id", "set_key", "n_shingles", "signature"])

    return id_and_text(docs).mapInArrow(make, "doc_id long, set_key binary, n_shingles long, signature array<long>")


def classes(placed: DataFrame) -> DataFrame:
    """One row per distinct set: set_key, node (the place of its first document, its name from here on), first_id (its
    smallest doc_id), size (its documents), n and signature."""
    return placed.groupBy("set_key").agg(
        F.min("pos").alias("node"), F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("size"),
        F.max("n_shingles").alias("n"), F.any_value("signature").alias("signature"),
    )


def postings(distinct: DataFrame) -> DataFrame:
    """(token, holders, node, n, signature, posted): the tokens that each class posts, ``posted`` all of them, rarest first;
    ``holders`` counts the classes that have the token."""
    tokens = distinct.select("node", F.explode("signature").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    held = tokens.join(shared, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("holders", "token"))).alias("held"))
    # A class's other tokens are its own alone and come first in the order.
    held = held.where(F.size("held") >= MATCHES)
    held = held.select("node", F.slice("held", F.lit(1), F.size("held") - (MATCHES - 1)).alias("posted"))
    rows = held.join(distinct, "node").select("node", "n", "signature", "posted", F.explode("posted").alias("p"))
    return rows.select("p.token", "p.holders", "node", "n", "signature", F.col("posted.token").alias("posted"))


def _may_match(percent: int) -> Column:
    """Sizes of x and y allow the similarity, and enough coordinates collide."""
    n, m = F.col("x.n"), F.col("y.n")
    collisions = F.size(F.array_intersect("x.signature", "y.signature"))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (collisions >= MATCHES)


def _first_meeting() -> Column:
    """This token is the rarest that x and y both have posted."""
    return F.element_at(F.array_intersect("x.posted", "y.posted"), 1) == F.col("x.token")


def _on(*keys: str) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"x.{k}") == F.col(f"y.{k}"))
    return same


def _slot(node: str, count: Column | str, size: int) -> Column:
    """One of as many slots as ``count`` rows fill with about ``size`` each."""
    return F.pmod(F.xxhash64(F.lit(SEED), node), F.ceil(F.col(count) / size).cast("long"))


def _slots(count: str, size: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(count) / size).cast("long") - 1))


def short_pairs(posted: DataFrame, percent: int = PERCENT, short: int = SHORT) -> DataFrame:
    """Candidate pairs (tile, a, b) that meet in short lists."""
    rows = posted.where(F.col("holders") <= short)
    met = rows.alias("x").join(rows.alias("y"), _on("token") & (F.col("x.node") < F.col("y.node")))
    return met.where(_first_meeting() & _may_match(percent)).select(
        F.col("x.token").alias("tile"), F.col("x.node").alias("a"), F.col("y.node").alias("b")
    )


def list_heads(long_lists: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(node, head, holders, near): the classes of long lists and the first class of each list they are in, and whether the
    two may match.  Lists of one group of copies have one first class, so a class has few."""
    heads = long_lists.groupBy("token").agg(
        F.min(F.struct("node", "n", "signature")).alias("head"), F.max("holders").alias("holders")
    )
    heads = heads.select("token", "head.*", _slots("holders", block).alias("slot")).alias("y")
    x = long_lists.withColumn("slot", _slot("node", "holders", block)).alias("x")
    met = x.join(heads, _on("token", "slot")).where(F.col("x.node") != F.col("y.node"))
    met = met.select(
        F.col("x.node").alias("node"), F.col("y.node").alias("head"), F.col("x.holders").alias("holders"),
        _may_match(percent).alias("near"),
    )
    return met.groupBy("node", "head").agg(F.max("holders").alias("holders"), F.max("near").alias("near"))


def head_pairs(heads: DataFrame) -> DataFrame:
    """Candidate pairs (tile, a, b) of the classes of long lists with their lists' first classes."""
    tile = F.xxhash64(F.lit(1), "head", _slot("node", "holders", TILE))
    return heads.where("near").select(tile.alias("tile"), F.col("head").alias("a"), F.col("node").alias("b"))


def class_texts(nodes: DataFrame, distinct: DataFrame, docs: DataFrame) -> DataFrame:
    """node, set_key and text of some classes: of each the texts of its first document's id."""
    names = nodes.join(distinct.select("node", "first_id", "set_key"), "node")
    texts = id_and_text(docs)
    return names.join(texts, names["first_id"] == texts["doc_id"]).select("node", "set_key", "text")


def _has_key(hashes: np.ndarray, key: bytes) -> bool:
    """Another text of a document that the table repeats has another key."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() == key


def class_sets(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """node and its set, sorted hashes as bytes."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(n.as_py(), shingle_hashes(t.as_py(), words), k.as_py()) for n, t, k in zip(*(batch.column(c) for c in ("node", "text", "set_key")))]
            own = [(n, s.tobytes()) for n, s, k in found if _has_key(s, k)]
            yield pa.record_batch([pa.array([n for n, _ in own], pa.int64()), pa.array([s for _, s in own], pa.binary())], names=["node", "set"])

    return texts.mapInArrow(make, "node long, set binary").dropDuplicates(["node"])


def common(a: list[np.ndarray], b: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets of ``a`` with all sets of ``b``, exact: products of 0/1 matrices over the
    elements that both sides have, so many columns at a time."""
    out = np.zeros((len(a), len(b)), np.float32)
    sides = []
    for sets in (a, b):
        sides.append((np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])))
    both = np.intersect1d(sides[0][0], sides[1][0])
    at = [(np.searchsorted(both, v), v, r) for v, r in sides]
    at = [(i[m], r[m]) for i, v, r in at for m in [(i < len(both)) & (both[np.minimum(i, len(both) - 1)] == v)]] if len(both) else []
    for start in range(0, len(both), columns):
        marks = []
        for (i, r), sets in zip(at, (a, b)):
            mark = np.zeros((len(sets), min(columns, len(both) - start)), np.float32)
            inside = (i >= start) & (i < start + columns)
            mark[r[inside], i[inside] - start] = 1
            marks.append(mark)
        out += marks[0] @ marks[1].T
    return out.astype(np.int64)


def far_links(
    heads: DataFrame, roots: DataFrame, distinct: DataFrame, docs: DataFrame, words: int = WORDS,
    percent: int = PERCENT, block: int = TILE,
) -> DataFrame:
    """Links (a, b) between components (``roots``: node, root) that meet in long lists, enough to connect all that full sets
    link.

    Classes of long lists that share a list, directly or over others, are a family.  Of a family the classes outside its
    largest component meet all its classes, in blocks of about ``block`` by ``block`` sets, where every pair is counted
    exactly and only links that connect are returned.  A family that is one component is done.
    """
    families = components(heads.select(F.col("node").alias("a"), F.col("head").alias("b")))
    known = families.select("node", F.col("root").alias("family")).join(roots, "node", "left")
    known = materialize(known.withColumn("root", F.coalesce("root", "node")), "families")
    sizes = known.groupBy("family", "root").agg(F.count(F.lit(1)).alias("size"))
    lists = sizes.groupBy("family").agg(F.max(F.struct("size", "root")).alias("most"), F.sum("size").alias("whole"))
    lists = lists.withColumn("rest", F.col("whole") - F.col("most.size")).where("rest > 0")
    # A family's figures reach its classes over as many keys as SHORT, as it may hold a large share of them.
    spread = F.explode(F.sequence(F.lit(0), F.lit(SHORT - 1)))
    lists = lists.select("family", "whole", "rest", F.col("most.root").alias("main"), spread.alias("part"))
    part = F.pmod(F.xxhash64(F.lit(7), "node"), F.lit(SHORT)).cast("int")
    rows = materialize(known.withColumn("part", part).join(lists, ["family", "part"]).drop("part"), "far-rows")
    sets = class_sets(class_texts(rows.select("node"), distinct, docs), words)
    x = rows.where("root <> main").select("*", F.lit(0).alias("side"), _slot("node", "rest", block).alias("r"), _slots("whole", block).alias("w"))
    y = rows.select("*", F.lit(1).alias("side"), _slots("rest", block).alias("r"), _slot("node", "whole", block).alias("w"))
    both = x.unionByName(y).select(F.xxhash64("family", "r", "w").alias("key"), "side", "node", "root")
    dealt = both.join(sets, "node").repartition("key").sortWithinPartitions("key", "side", "node")

    def links(block_rows: list[list]) -> list[tuple[int, int]]:
        a, b = ([r for r in block_rows if r[0] == side] for side in (0, 1))
        if not a or not b:
            return []
        sides = [[np.frombuffer(r[2], np.uint64) for r in s] for s in (a, b)]
        n, m = (np.array([len(s) for s in side], np.int64) for side in sides)
        shared = common(*sides)
        close = 100 * shared >= percent * (n[:, None] + m[None, :] - shared)
        above: dict[int, int] = {}

        def top(v: int) -> int:
            while above.get(v, v) != v:
                v = above[v]
            return v

        found = []
        for i, j in zip(*np.nonzero(close)):
            p, q = top(a[i][1]), top(b[j][1])
            if p != q:
                above[max(p, q)] = min(p, q)
                found.append((a[i][1], b[j][1]))
        return found

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if found := links(waiting):
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])

        for batch in batches:
            keys, side, root = (batch.column(c).to_pylist() for c in ("key", "side", "root"))
            for k, s, r, v in zip(keys, side, root, batch.column("set")):
                if k != now:
                    yield from done()
                    now, waiting = k, []
                waiting.append([s, r, v.as_py()])
        yield from done()

    return materialize(dealt.mapInArrow(compare, "a long, b long"), "far-links")


def confirmed(pairs: DataFrame, distinct: DataFrame, docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) among ``pairs`` whose full sets are similar: all of them, but those between classes that other links
    of their tile connect already."""
    pairs = materialize(pairs, "pairs")
    sides = F.explode(F.array("a", "b")).alias("node")
    need = pairs.select("tile", sides).distinct()
    texts = class_texts(need.select("node").distinct(), distinct, docs)
    none = F.lit(None)
    rows = need.join(texts, "node").select(
        "tile", F.col("node").alias("a"), none.cast("long").alias("b"), "set_key", "text"
    )
    rows = rows.unionByName(pairs.select("tile", "a", "b", none.cast("binary").alias("set_key"), none.cast("string").alias("text")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets, above = None, {}, {}

        def top(x):
            while above.get(x, x) != x:
                above[x] = x = above.get(above[x], above[x])
            return x

        for batch in batches:
            links = []
            for tile, a, b, key, text in zip(*(batch.column(c) for c in ("tile", "a", "b", "set_key", "text"))):
                tile, a, b = tile.as_py(), a.as_py(), b.as_py()
                if tile != now:
                    now, sets, above = tile, {}, {}
                if b is None:
                    found = shingle_hashes(text.as_py(), words)
                    if _has_key(found, key.as_py()):
                        sets[a] = found
                elif top(a) != top(b) and similar(sets[a], sets[b], percent):
                    above[top(a)] = top(b)
                    links.append((a, b))
            if links:
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*links)], names=["a", "b"])

    together = rows.repartition("tile").sortWithinPartitions("tile", F.col("b").isNotNull(), "a", "b")
    return materialize(together.mapInArrow(compare, "a long, b long"), "links")


def near_duplicates(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, short: int = SHORT, block: int = BLOCK
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of ``words``-word shingles share ``percent`` hundredths of their union or more;
    ``component_id`` is the smallest doc_id reached, the document itself included, and the document that has it is
    ``kept``.  A null text is empty; documents without words are linked with nothing.  Rows that repeat a doc_id are
    documents of their own, linked by their texts.  Rows without doc_id are linked with nothing either: their
    component_id is null, and they are kept, as nothing tells them apart.  An empty table gives an empty result.
    """
    found = materialize(prints(docs, words), "prints")
    linkable = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    placed = ordered(found.where(linkable), "set_key", "doc_id")
    distinct = materialize(classes(placed), "classes")
    posted = materialize(postings(distinct), "postings")
    heads = materialize(list_heads(posted.where(F.col("holders") > short), percent, block), "heads")
    near = short_pairs(posted, percent, short).unionByName(head_pairs(heads))
    roots = materialize(components(confirmed(near, distinct, docs, words, percent)), "roots")
    far = far_links(heads, roots, distinct, docs, words, percent, min(block, TILE))
    rooted = distinct.select("set_key", "node", "first_id", "size").join(roots, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    if not far.isEmpty():
        joined = components(far).select(F.col("node").alias("root"), F.col("root").alias("top"))
        rooted = rooted.join(joined, "root", "left").withColumn("root", F.coalesce("top", "root")).drop("top")
    rooted = materialize(rooted, "rooted")
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # A class's documents are a run of places; they learn its component block by block.
    runs = rooted.join(names, "root").select("set_key", "component_id", blocks("node", "size", MEMBERS).alias("block"))
    members = placed.withColumn("block", block_of("pos", MEMBERS)).join(runs, ["set_key", "block"])
    alone = found.where(~linkable).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = members.select("doc_id", "n_shingles", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
