"""SimHash near-duplicates by multi-index hashing.

Fingerprints are cut into segments, each with a table of the distinct fingerprints by segment value.  Two fingerprints
at a distance of ``distance`` bits or fewer agree in some segment up to a small radius (pigeonhole), so a query looks up
the Hamming ball of that radius around its own segment and compares complete fingerprints of what it finds.

A table entry with many fingerprints would be compared pair by pair.  Queries and rows of such dense entries are linked
another way, as exact: two fingerprints at an even distance or closer meet at the fingerprint half way between them, so
each goes to the ball of half the distance around itself, and no meeting point has more guests than such a ball has.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import id_and_text, materialize, scatter_lookup
from freightlens.llm.graph import components
from freightlens.llm.tokens import chunks

BITS, SEED = 64, 42
#: Fingerprints of a table entry from which it counts as dense.
DENSE = 64
#: A fingerprint is frequent if more than one in FREQUENT documents has it; so there are fewer than FREQUENT of them.
FREQUENT = 1000


def simhash(text: str, words: int) -> int:
    """The fingerprint of one text; see :func:`fingerprints`."""
    from xxhash import xxh64_intdigest

    parts = text.encode().lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        shingles, total = iter([b" ".join(parts)]), 1
    else:
        shingles, total = map(b" ".join, zip(*(parts[i:] for i in range(words)))), len(parts) - words + 1
    ones = np.zeros(BITS, np.int64)
    while some := [xxh64_intdigest(s, SEED) for s in islice(shingles, 65_536)]:
        raw = np.array(some, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fp, a 64-bit fingerprint as a long, for every document.

    Words are what white space (blank, tab to carriage return) leaves, A-Z lower-cased.  Shingles of ``words`` words,
    repeats included, are hashed; a bit is 1 if more than half the hashes have it.  Fewer words are one shingle; none, and
    a null text, give fingerprint 0.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts in chunks(batches, ("doc_id", "text")):
            found = np.array([simhash(t, words) for t in texts], np.uint64).view(np.int64)
            yield pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(found)], names=["doc_id", "fp"])

    return id_and_text(docs).mapInArrow(make, "doc_id long, fp long")


def _masks(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _segments(distance: int, segments: int) -> list[tuple[int, int, list[int]]]:
    """(shift, width, masks to look up) of each segment."""
    radius, width = distance // segments, -(-BITS // segments)
    full = distance - radius * segments + 1  # segments that need the whole radius; one bit less will do for the others
    plan = []
    for i in range(segments):
        own = min(width, BITS - i * width)
        r = radius if i < full else radius - 1
        plan.append((i * width, own, _masks(own, r) if r >= 0 else []))
    return plan


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(distinct: DataFrame, distance: int = 2, segments: int = 2, dense: int = DENSE) -> DataFrame:
    """Links (a, b) between distinct fingerprints (``fp``) that connect all that differ in ``distance`` bits or fewer.

    Of sparse entries every link is returned.  Of dense ones only links enough to connect the same fingerprints.
    """
    if distance % 2:
        raise ValueError("distance must be even")
    plan = _segments(distance, segments)

    def value(shift: int, width: int) -> Column:
        return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))

    def keys(segment: int, shift: int, width: int, look: list[int]) -> Column:
        own = value(shift, width)
        entry = lambda m: F.struct(F.lit(segment).alias("segment"), own.bitwiseXOR(m).alias("key"))
        return F.transform(F.array(*[F.lit(_signed(m)).cast("long") for m in look]), entry)

    def table(masks: bool) -> Column:
        each = [keys(i, s, w, look if masks else [0]) for i, (s, w, look) in enumerate(plan) if look]
        return F.explode(F.concat(*each))

    index = distinct.select(F.col("fp").alias("other"), table(False).alias("t")).select("other", "t.*")
    probes = distinct.select("fp", table(True).alias("t")).select("fp", "t.*")
    full = index.groupBy("segment", "key").count().where(F.col("count") > dense).select("segment", "key")
    sparse = index.join(full, ["segment", "key"], "left_anti")
    found = probes.join(sparse, ["segment", "key"]).where((F.col("fp") != F.col("other")) & (_distance("fp", "other") <= distance))
    near = found.select(F.greatest("fp", "other").alias("a"), F.least("fp", "other").alias("b")).distinct()

    crowd = probes.join(full, ["segment", "key"], "left_semi").select("fp").distinct()
    ball = F.array(*[F.lit(_signed(m)).cast("long") for m in _masks(BITS, distance // 2)])
    meet = crowd.select("fp", F.explode(ball).alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("at"))
    guests = meet.groupBy("at").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    star = guests.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a <> b").distinct()
    return near.union(star)


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 2, segments: int = 2, dense: int = DENSE) -> DataFrame:
    """One row per document: doc_id, fp, component_id.

    ``component_id`` is the smallest doc_id among the documents reached over links of ``distance`` bits or fewer, the
    document itself included.  Rows that repeat are linked like any other; a null doc_id is never the smallest, and a
    component of such rows alone has a null id.  An empty table gives an empty result.
    """
    prints = materialize(fingerprints(docs, words), "fingerprints")
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "classes")
    roots = components(links(classes.select("fp"), distance, segments, dense))
    linked = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", "n", F.coalesce("root", "fp").alias("root")
    )
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id")).withColumnRenamed("root", "_root")
    named = linked.join(smallest, F.col("root") == F.col("_root")).select("fp", "n", "component_id")
    total = prints.count()
    frequent = named.where(F.col("n") > max(1, total // FREQUENT))
    rows = prints.withColumn("_spread", F.coalesce("doc_id", F.lit(0)))
    return scatter_lookup(rows, named.drop("n"), "fp", "component_id", frequent)


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of each component the document with the smallest doc_id.

    Documents without doc_id stay, as nothing tells them apart; of rows that repeat a doc_id, the first by all columns
    stays if that doc_id does.
    """
    found = near_duplicates(docs, **options)
    return keep_ids(docs, found.where("doc_id = component_id").select(F.col("doc_id").alias("_keep")).distinct())


def keep_ids(docs: DataFrame, stay: DataFrame) -> DataFrame:
    """The first row, by all columns, of each doc_id in ``stay`` (_keep), and the rows without doc_id."""
    from pyspark.sql import Window

    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("_id"))
    first = Window.partitionBy("_id").orderBy(F.col("row").cast("string"))
    kept = rows.where("_id is not null").join(stay, F.col("_id") == F.col("_keep"), "left_semi")
    kept = kept.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").select("row.*")
    return kept.unionByName(rows.where("_id is null").select("row.*"))
