"""Whitening of embeddings from exact integer cross-products by bit-sliced scatter.

1. Entries become integers, x = floor(64 c) + 1,000,000.  The fit list holds each distinct x vector once, so a vector
   that a third of all rows share counts once; equal vectors combine before the shuffle.
2. Per dimension the smallest value is subtracted and the rest is cut into as many bit planes as its range needs.  A
   task packs each plane of a block of rows into 64-bit words.  The cross-product of two dimensions is the sum over
   their planes of 2 ** (p + q) times the number of rows that have both bits: AND and popcount of words.
3. Tasks return one matrix each, cut into limbs that Spark adds up exactly.  n * sum(x y) - sum(x) * sum(y) is an
   integer, so centring loses nothing; only then it is divided by n ** 2 and handed to the eigensolver.

What the driver gets grows with the square of the dimension, never with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import materialize

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Rows whose planes are packed at once.
BLOCK = 1 << 16
_LIMB, _LIMBS = 60, 3
_WIDEST = 2.0**62


def integers(vector: Column) -> Column:
    """x of every entry, or null where the vector is null or has an entry that is null, not finite or has no 64-bit x."""
    scaled = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))
    fits = F.forall(
        vector,
        lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) * SCALE < _WIDEST), F.lit(False)),
    )
    # The cast must not see what does not fit.
    return F.when(fits, F.transform(F.when(fits, scaled), lambda v: v.cast("long") + SHIFT))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, d)


def _planes(y: np.ndarray, widths: list[int]) -> np.ndarray:
    """Bit planes of all dimensions (non-negative rows by dimensions), packed along the rows into words."""
    rows = -(-len(y) // 64) * 64
    out = np.zeros((sum(widths), rows), np.uint8)
    at = 0
    for j, width in enumerate(widths):
        column = y[:, j].astype(np.uint64)
        for p in range(width):
            out[at, : len(y)] = (column >> np.uint64(p)) & np.uint64(1)
            at += 1
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64)


def _counts(planes: np.ndarray) -> np.ndarray:
    """How many rows have both bits, for every pair of planes."""
    out = np.zeros((len(planes), len(planes)), np.int64)
    for a in range(len(planes)):
        out[a, a:] = np.bitwise_count(planes[a:] & planes[a]).sum(axis=1, dtype=np.int64)
    return out + np.triu(out, 1).T


def _weigh(counts: np.ndarray, widths: list[int]) -> list[list[int]]:
    """Cross-products of the dimensions from the counts of their planes, as Python integers."""
    weights = [np.array([1 << p for p in range(w)], object) for w in widths]
    ends = np.cumsum([0, *widths])
    d = len(widths)
    out = [[0] * d for _ in range(d)]
    for i in range(d):
        rows = counts[ends[i] : ends[i + 1]].astype(object)
        part = weights[i] @ rows if widths[i] else np.zeros(len(counts), object)
        for j in range(i, d):
            out[i][j] = int(part[ends[j] : ends[j + 1]] @ weights[j]) if widths[i] and widths[j] else 0
    return out


def scatter(fit: DataFrame, low: list[int], widths: list[int]) -> list[list[int]]:
    """Exact sums over the rows of ``fit`` (x) of (x_i - low_i) (x_j - low_j), for i <= j."""
    d, base = len(low), np.array(low, np.int64)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting, size = np.zeros((sum(widths), sum(widths)), np.int64), [], 0
        for batch in batches:
            # Differences from the smallest value fit 64 unsigned bits, whatever wraps on the way.
            waiting.append((_matrix(batch.column("x"), d) - base).view(np.uint64))
            size += batch.num_rows
            if size >= BLOCK:
                counts += _counts(_planes(np.concatenate(waiting), widths))
                waiting, size = [], 0
        if size:
            counts += _counts(_planes(np.concatenate(waiting), widths))
        sums = _weigh(counts, widths)
        at = [(i, j) for i in range(d) for j in range(i, d)]
        mask = (1 << _LIMB) - 1
        limbs = [pa.array([sums[i][j] >> (_LIMB * k) & mask for i, j in at], pa.int64()) for k in range(_LIMBS)]
        index = [pa.array([ij[k] for ij in at], pa.int32()) for k in range(2)]
        yield pa.record_batch([*index, *limbs], names=["i", "j", *[f"l{k}" for k in range(_LIMBS)]])

    schema = "i int, j int, " + ", ".join(f"l{k} long" for k in range(_LIMBS))
    parts = fit.select("x").mapInArrow(make, schema).groupBy("i", "j")
    out = [[0] * d for _ in range(d)]
    for r in parts.agg(*[F.sum(F.col(f"l{k}").cast("decimal(38,0)")).alias(f"l{k}") for k in range(_LIMBS)]).collect():
        out[r.i][r.j] = sum(int(r[f"l{k}"]) << (_LIMB * k) for k in range(_LIMBS))
    return out


class Whitening:
    """Components fitted on exact sums: ``n``, ``low`` and ``rest`` (smallest values, and sums of what exceeds them),
    ``axes`` (a unit eigenvector per row), ``variances`` falling, and their total ``trace``."""

    def __init__(self, n: int, low: list[int], rest: list[int], cross: list[list[int]], components: int):
        d = len(low)
        self.n, self.low, self.rest = n, low, rest
        central = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                central[i, j] = central[j, i] = float(Fraction(n * cross[i][j] - rest[i] * rest[j], n * n))
        values, vectors = np.linalg.eigh(central)
        order = np.argsort(values)[::-1][:components]
        self.variances = [max(0.0, float(values[k])) for k in order]
        self.axes = np.ascontiguousarray(vectors[:, order].T)
        self.trace = float(np.trace(central))
        #: Below this a variance is rounding noise: the data do not vary along that component.
        self.noise = (values.max() if d else 0.0) * d * np.finfo(float).eps

    @property
    def explained(self) -> list[float | None]:
        return [v / self.trace if self.trace > 0 else None for v in self.variances]

    @property
    def varies(self) -> np.ndarray:
        return np.array([v > self.noise for v in self.variances], bool)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: 64-bit where that fits, else Python integers."""
        y = x - np.array(self.low, np.int64)
        if len(y) and self.n * (int(y.view(np.uint64).max()) + 1) >= 1 << 62:
            return self.n * y.view(np.uint64).astype(object) - np.array(self.rest, object)
        return self.n * y - np.array(self.rest, np.int64)

    def project(self, centred: np.ndarray) -> np.ndarray:
        """Whitened values, rows by components; NaN along components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            spread = np.where(self.varies, np.sqrt(self.variances), np.nan)
        return ((centred / self.n).astype(float) @ self.axes.T) / spread


def deviations(centred: np.ndarray) -> list[int | None]:
    """Sum of squares of every row, exact; None where it does not fit a 64-bit integer."""
    most = int(np.abs(centred).max(initial=0))
    if most * most * max(1, centred.shape[1]) < 1 << 62:
        return (centred.astype(np.int64) ** 2).sum(axis=1).tolist()
    found = [int(v) for v in (centred.astype(object) ** 2).sum(axis=1)]
    return [v if v < 1 << 63 else None for v in found]


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct vectors (``x``, arrays of longs of one length); None without rows."""
    dims = fit.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.sum(F.col("v").cast("decimal(38,0)")).alias("total"),
        F.count(F.lit(1)).alias("n"),
    )
    found = sorted(dims.collect())
    if not found:
        return None
    n, low = found[0].n, [r.low for r in found]
    widths = [(r.high - r.low).bit_length() for r in found]
    return Whitening(n, low, [int(r.total) - n * r.low for r in found], scatter(fit, low, widths), components)


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity, from the data themselves.

    Components without variance are left out; None if there is no other.
    """
    keep, d = np.flatnonzero(model.varies), len(model.low)
    if not len(keep):
        return None

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, cross = np.zeros(len(keep)), np.zeros((len(keep), len(keep)))
        for batch in batches:
            w = model.project(model.centred(_matrix(batch.column("x"), d)))[:, keep]
            sums += w.sum(axis=0)
            cross += w.T @ w
        yield pa.record_batch([pa.array([sums.tolist()]), pa.array([cross.reshape(-1).tolist()])], names=["sums", "cross"])

    parts = fit.select("x").mapInArrow(make, "sums array<double>, cross array<double>")

    def total(name: str, width: int) -> np.ndarray:
        each = parts.select(F.posexplode(name).alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
        out = np.zeros(width)
        for r in each:
            out[r.at] = r.v
        return out

    mean = total("sums", len(keep)) / model.n
    covariance = total("cross", len(keep) ** 2).reshape(len(keep), -1) / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(len(keep))).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, or has an entry that is null, not finite or too large for a 64-bit x, are left out, and
    so are vectors of another length than the commonest one (of two, the longer).  Every other row is returned, repeated
    rows each; a null id stays null.  Components follow falling variance, at most as many as there are dimensions.  One
    along which nothing varies has a null ``whitened``; if nothing varies at all, ``explained`` and ``identity_error``
    are null too, and so is a ``deviation`` that does not fit a 64-bit integer.  An empty table, or one of empty vectors,
    gives an empty result.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = embeddings.select(embeddings[key].cast("long").alias("vec_id"), integers(embeddings[vector]).alias("x"))
    lengths = rows.where("x is not null").groupBy(F.size("x").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    if common is None or not common.d:
        return embeddings.sparkSession.createDataFrame([], schema)
    d = common.d
    rows = rows.where(F.size("x") == d)
    fit = materialize(rows.select("x").distinct(), "fit-list")
    model = fit_whitening(fit, components)
    error, explained = identity_error(fit, model), model.explained

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(explained)
        for batch in batches:
            centred = model.centred(_matrix(batch.column("x"), d))
            white = model.project(centred).reshape(-1)
            each = np.repeat(np.arange(batch.num_rows), k)
            columns = [
                batch.column("vec_id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                pa.array(np.full(len(each), model.n, np.int64)),
                pa.array(deviations(centred), pa.int64()).take(pa.array(each)),
                pa.array(white, mask=np.isnan(white)),
                pa.array(explained * batch.num_rows, pa.float64()),
                pa.array([error] * len(each), pa.float64()),
            ]
            yield pa.record_batch(columns, names=[c.split()[0] for c in schema.split(", ")])

    return rows.mapInArrow(make, schema)
