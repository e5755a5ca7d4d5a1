"""Whitening of vectors by MLlib's singular values of the centred rows.

Entries become whole numbers first, so sums, means and deviations are exact whatever the order of tasks. Only sums by dimension, the
components and a matrix of components by components reach the driver; rows stay where they are and no row is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import neutral

#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Entries of this size and more are left out like those that are not finite, as exact sums need room.
LARGEST = float(1 << 40)
#: Singular values below this share of the largest belong to directions without variance, as far as doubles tell.
NOTHING = 1e-6
#: Up to so many dimensions all singular values are taken, by LAPACK on the Gramian; beyond, only those asked for.
WHOLE = 4096
#: Rows that a task turns into a matrix at a time.
SLICE = 1024


@dataclass
class Fit:
    """Of all vectors of one length: their number, exact sums, components in rows, eigenvalues, and the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float = 0.0
    identity_error: float = 0.0

    def __post_init__(self):
        self.floor = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Of each row the sum of (n * x - S) squared, whether it fits a long, and the exact sum over all rows."""
        apart = self.n * (x - self.floor) - self.rest
        # sums that fit come out right even if squares wrapped on the way
        fits = (apart.astype(float) ** 2).sum(axis=1) < 9.2e18
        low = (1 << 21) - 1
        limbs = [(apart & low).ravel(), ((apart >> 21) & low).ravel(), (apart >> 42).ravel()]
        whole = sum(int(np.dot(a, b)) << 21 * (i + j) for i, a in enumerate(limbs) for j, b in enumerate(limbs))
        return (apart * apart).sum(axis=1), fits, whole


def _sound(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has entries, all of them finite, as doubles."""
    rows = df.withColumn(vector, F.col(vector).cast("array<double>"))
    return rows.filter(F.expr(f"size({vector}) > 0 AND forall({vector}, x -> x IS NOT NULL AND abs(x) < {LARGEST})"))


def _matrices(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, rows and whole numbers of the vectors of each length."""
    lengths = np.diff(vectors.offsets.to_numpy())
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        own = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), d)
        yield int(d), at, np.floor(SCALE * own).astype(np.int64) + OFFSET


def _added(rows: DataFrame, vector: str, of) -> dict[int, dict[int, tuple[int, object]]]:
    """Sums over tasks of what of(d, x) gives: lists of values by kind, exact if whole, as (d, kind, place) -> sum."""
    fields = [T.StructField("d", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("place", T.IntegerType()), T.StructField("whole", T.StringType()), T.StructField("real", T.DoubleType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str], list] = {}
        for d, _, x in (m for batch in batches for start in range(0, batch.num_rows, SLICE) for m in _matrices(batch.column(0).slice(start, SLICE))):
            for kind, values in of(d, x).items():
                old = held.get((d, kind))
                held[d, kind] = values if old is None else [a + b for a, b in zip(old, values)]
        out = [(d, kind, i, str(v) if isinstance(v, int) else None, None if isinstance(v, int) else v) for (d, kind), values in held.items() for i, v in enumerate(values)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int32(), pa.string(), pa.int32(), pa.string(), pa.float64()))], names=["d", "kind", "place", "whole", "real"])

    sums = rows.select(vector).mapInArrow(run, T.StructType(fields)).groupBy("d", "kind", "place").agg(F.sum(F.col("whole").cast("decimal(38,0)")).alias("whole"), F.sum("real").alias("real"))
    found: dict[int, dict[str, dict[int, object]]] = {}
    for r in sums.collect():
        found.setdefault(r.d, {}).setdefault(r.kind, {})[r.place] = r.real if r.whole is None else int(r.whole)
    return {d: {kind: [v[i] for i in range(len(v))] for kind, v in kinds.items()} for d, kinds in found.items()}


def _components(rows: DataFrame, vector: str, d: int, n: int, sums: list[int], most: int) -> Fit:
    from pyspark.ml.functions import array_to_vector
    from pyspark.mllib.linalg.distributed import RowMatrix
    from pyspark.mllib.util import MLUtils

    fit = Fit(n, sums, np.zeros((0, d)), np.zeros(0))
    floors, rests = F.lit([int(v) for v in fit.floor]), F.lit([float(v) for v in fit.rest / n])
    whole = lambda c: F.floor(SCALE * c).cast("long") + OFFSET
    centred = F.transform(vector, lambda c, i: (whole(c) - F.get(floors, i)).cast("double") - F.get(rests, i))
    own = rows.filter(F.size(vector) == d).select(array_to_vector(centred).alias("row"))
    found = RowMatrix(MLUtils.convertVectorColumnsFromML(own, "row"), n, d).computeSVD(d if d <= WHOLE else min(most, d), computeU=False, rCond=NOTHING)
    s = found.s.toArray()
    k = min(most, int((s > max(NOTHING * s[0], 0.0)).sum())) if len(s) else 0
    v = found.V.toArray().T[:k]
    # either sign would do; the largest entry is positive, so that reruns agree
    signs = np.sign(v[np.arange(k), np.abs(v).argmax(axis=1)]) if k else np.ones(0)
    return Fit(n, sums, v * signs[:, None], s[:k] ** 2 / n)


def fit(df: DataFrame, vector_col: str = "embedding", components: int = 32) -> dict[int, Fit]:
    """What whitening needs, by the vectors' length. Vectors of another length are a space of their own, with their own fit.

    Directions without variance have no component; of vectors that are all equal none is left. Covariances have divisor n.
    """
    rows = _sound(df.select(F.col(f"`{vector_col}`").alias("v")), "v")
    base = _added(rows, "v", lambda d, x: {"n": [len(x)], "sums": [int(v) for v in x.sum(axis=0)]})
    fits = {d: _components(rows, "v", d, b["n"][0], b["sums"], components) for d, b in sorted(base.items())}

    means = _added(rows, "v", lambda d, x: {"spread": [fits[d].deviations(x)[2]], "means": [float(v) for v in fits[d].whitened(x).sum(axis=0)]})
    for d, f in fits.items():
        # the sum is exact, so is its quotient but for the last rounding
        f.trace = means[d]["spread"][0] / f.n**3

    def products(d: int, x: np.ndarray) -> dict:
        w = fits[d].whitened(x) - np.array(means[d].get("means", [])) / fits[d].n
        return {"products": [float(v) for v in (w.T @ w).ravel()]}

    found = _added(rows, "v", products)
    for d, f in fits.items():
        k = len(f.values)
        if k:
            f.identity_error = float(np.abs(np.array(found[d]["products"]).reshape(k, k) / f.n - np.eye(k)).max())
    return fits


def whiten(df: DataFrame, fits: dict[int, Fit] | None = None, vector_col: str = "embedding", keep: list[str] | None = None, components: int = 32) -> DataFrame:
    """Columns `keep` of df, then component, n, deviation, whitened, explained and identity_error: a row for each sound row and component.

    Vectors that are null or empty, or hold null or non-finite entries (or any of LARGEST and more), are left out of fit and result;
    so are vectors whose length no fit knows. Repeated rows count, and come, as often as they stand. deviation is null where it does
    not fit a long. An empty table gives an empty result; a kept column of a made one's name gives way to it.
    """
    fits = fit(df, vector_col, components) if fits is None else fits
    made = T.StructType([
        T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
    ])
    keep = [k for k in (df.columns if keep is None else keep) if k not in made.names and k != vector_col]
    named, names = neutral(df.select(*keep, vector_col))
    rows = _sound(named, names[vector_col])
    held = [names[k] for k in keep]
    schema = T.StructType([*(named.schema[c] for c in held), *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                for d, at, x in _matrices(part.column(len(held))):
                    f = fits.get(d)
                    k = len(f.values) if f else 0
                    if not k:
                        continue
                    deviation, fits_long, _ = f.deviations(x)
                    again = np.repeat(at, k)
                    each = lambda v, m=len(at): pa.array(np.tile(v, m))
                    yield pa.RecordBatch.from_arrays([
                        *(part.column(i).take(pa.array(again)) for i in range(len(held))), each(np.arange(1, k + 1, dtype=np.int32)), each(np.full(k, f.n)),
                        pa.array(np.repeat(deviation, k), mask=np.repeat(~fits_long, k)), pa.array(f.whitened(x).ravel()), each(f.values / f.trace), each(np.full(k, f.identity_error)),
                    ], names=schema.names)

    out = rows.select(*held, names[vector_col]).mapInArrow(run, schema)
    return out.select(*(F.col(names[k]).alias(k) for k in keep), *made.names)
