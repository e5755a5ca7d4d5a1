"""Near-duplicate vectors by cross-polytope hashing.

Each table rotates the unit vectors by three rounds of random signs and a fast Hadamard transform, and hashes them to the nearest
corner of a cross-polytope (the largest coordinate and its sign), twice; both corners name a bucket. Multiprobe: a vector also
visits the buckets that its next-largest coordinates name, cheapest first. Vectors meet where the bucket of one is a bucket or
probe of the other, and every pair that meets is verified by its cosine in double precision.

Equal vectors are one point with a count. A pair of points may meet in several buckets; it counts in the first of them alone, which
each task can tell from the two vectors. Tasks send back sums of links and a spanning forest, never pairs. Large buckets are cut
into blocks that meet pairwise, so none is capped.

Recall: pairs at a cosine of 0.93 are missed with a chance of about 1e-3 in 64 dimensions and 3e-3 in 384 and 768, nearer pairs far
more rarely (tests measure it). Corners follow the number of vectors, so that chance meetings in a bucket stay few (buckets of a
table: twice the dimensions to the power of the corners), and tables follow the corners, so that recall stays.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite component, rows with a null label and rows with a
null id link with nothing; n_links is 0 and the component is the row's id. Vectors of different lengths never link. Repeated
rows are vectors of their own that link with each other. Ties don't arise: a pair either reaches the cosine or not. An empty table
gives an empty result. Columns other than the three named ones are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import PLACE, dealt, record_batches, whole_groups
from .common import stored
from .components import Forest, components

#: Pairs that a task verifies at a time, and the group size from which it multiplies matrices.
PAIRS, MATRIX_FROM = 1 << 15, 48
#: Vectors that a bucket may hold by chance.
BUCKET = 64


@dataclass(frozen=True)
class Hashing:
    tables: int = 10
    corners: int = 2
    probes: int = 2
    seed: int = 20

    @staticmethod
    def of(n: int, dimensions: int) -> Hashing:
        """For n vectors: corners that leave about BUCKET of them to a bucket by chance, and tables that make up for corners."""
        corners = max(2, int(np.ceil(np.log(max(1, n / BUCKET)) / np.log(2 * (1 << max(1, (max(1, dimensions) - 1).bit_length()))))))
        return Hashing(tables=int(np.ceil(10 * 1.55 ** (corners - 2))), corners=corners)


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of rows whose length is a power of two, scaled to keep lengths."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def buckets(vectors: np.ndarray, hashing: Hashing) -> np.ndarray:
    """[vector, table, 1 + probes]: the numbers of a vector's own bucket and of the next ones."""
    width = 1 << max(1, (vectors.shape[1] - 1).bit_length())
    x = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
    signs = np.random.default_rng(hashing.seed).choice([-1.0, 1.0], (hashing.tables, hashing.corners, 3, width))
    out = np.empty((len(x), hashing.tables, 1 + hashing.probes), np.int64)
    near = min(3, width)
    for t in range(hashing.tables):
        code, loss = [], []
        for c in range(hashing.corners):
            y = x
            for s in signs[t, c]:
                y = hadamard(y * s)
            size = np.abs(y)
            best = np.argsort(-size, axis=1, kind="stable")[:, :near]
            code.append(2 * best + (np.take_along_axis(y, best, 1) > 0))
            size = np.take_along_axis(size, best, 1)
            loss.append(size[:, :1] - size)
        choices = [(0,) * hashing.corners]
        for c in range(hashing.corners):
            choices += [(0,) * c + (k,) + (0,) * (hashing.corners - c - 1) for k in range(1, near)]
        choices += [(1,) * hashing.corners] * (hashing.corners > 1)
        numbers, costs = [], []
        for choice in choices:
            number = np.zeros(len(x), np.int64)
            for c, k in enumerate(choice):
                number = number * (2 * width) + code[c][:, k]
            numbers.append(number)
            costs.append(sum(loss[c][:, k] for c, k in enumerate(choice)))
        order = np.argsort(np.stack(costs[1:], 1), axis=1, kind="stable")[:, : hashing.probes]
        out[:, t, 0] = numbers[0]
        out[:, t, 1:] = np.take_along_axis(np.stack(numbers[1:], 1), order, 1)
    return out


def first_meeting(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first table, and its least bucket, where the bucket of one is a bucket or probe of the other. a, b: rows of buckets()."""
    tables = np.full(len(a), a.shape[1])
    bucket = np.full(len(a), np.iinfo(np.int64).max)
    for t in range(a.shape[1] - 1, -1, -1):
        least = np.full(len(a), np.iinfo(np.int64).max)
        for i in range(a.shape[2]):
            for j in range(a.shape[2]):
                if not i or not j:
                    same = a[:, t, i] == b[:, t, j]
                    least[same] = np.minimum(least[same], a[same, t, i])
        here = least < np.iinfo(np.int64).max
        tables[here], bucket[here] = t, least[here]
    return tables, bucket


def pairs_within(number: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of each group, some at a time: all pairs, or those of side 0 with side 1."""
    n = len(number)
    end = np.searchsorted(number, number, "right")
    start = np.where(side == 2, np.arange(n) + 1, np.where(side == 0, np.searchsorted(2 * number + (side == 1), 2 * number + 1), end))
    count = end - start
    total = np.cumsum(count)
    at = 0
    while at < n:
        base = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, base + PAIRS, "right")))
        a = np.repeat(np.arange(at, stop), count[at:stop])
        b = np.repeat(start[at:stop] - (total[at:stop] - count[at:stop] - base), count[at:stop]) + np.arange(len(a))
        if len(a):
            yield a, b
        at = stop


def near_pairs(x: np.ndarray, number: np.ndarray, side: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of unit rows of x in one group whose product is at least `least`."""
    starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
    sizes = np.diff(np.r_[starts, len(number)])
    small = np.repeat(sizes < MATRIX_FROM, sizes)
    places = np.flatnonzero(small)
    for a, b in pairs_within(number[small], side[small]) if len(places) else ():
        a, b = places[a], places[b]
        near = np.einsum("ij,ij->i", x[a], x[b]) >= least
        if near.any():
            yield a[near], b[near]
    for s, n in zip(starts[sizes >= MATRIX_FROM].tolist(), sizes[sizes >= MATRIX_FROM].tolist(), strict=True):
        k = side[s : s + n]
        left = np.arange(n) if k[0] == 2 else np.flatnonzero(k == 0)
        right = np.arange(n) if k[0] == 2 else np.flatnonzero(k == 1)
        for at in range(0, len(left), 256):
            i, j = np.nonzero(x[s + left[at : at + 256]] @ x[s + right].T >= least)
            i, j = left[at + i], right[j]
            if k[0] == 2:
                i, j = i[i < j], j[i < j]
            for c in range(0, len(i), PAIRS):
                yield s + i[c : c + PAIRS], s + j[c : c + PAIRS]


def near_duplicates(df: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", hashing: Hashing | None = None) -> DataFrame:
    """(id, n_links, component_id, kept) for each row: links to vectors of the same label with a cosine of at least `least`."""
    vector = F.col(vector_col)
    sound = F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (F.size(vector) > 0)
    sound &= F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(vector, lambda v: v != 0)
    label = F.xxhash64(F.col(label_col), F.size(vector))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(sound, F.lit(False)).alias("sound"), label.alias("label"), vector.alias("vector"))
    rows = rows.withColumns({"k1": F.xxhash64("label", "vector"), "k2": F.xxhash64("vector", F.lit(1), "label")})
    points = rows.filter("sound").groupBy("k1", "k2").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    points = stored(points)
    if hashing is None:
        n, d = points.agg(F.count("*"), F.max(F.size("vector"))).first()
        hashing = Hashing.of(n, d or 1)

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, label = (batch.column(k).to_numpy() for k in ("id", "n", "label"))
            column = batch.column("vector")
            sizes = np.diff(column.offsets.to_numpy())
            values, starts = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()[:-1]
            for d in np.unique(sizes).tolist():
                of = np.flatnonzero(sizes == d)
                for some in (of[k : k + 1000] for k in range(0, len(of), 1000)):
                    own = values[starts[some][:, None] + np.arange(d)]
                    number = buckets(unit(own), hashing)
                    k = hashing.tables * (1 + hashing.probes)
                    made = [np.repeat(label[some], k), np.tile(np.repeat(np.arange(hashing.tables, dtype=np.int32), 1 + hashing.probes), len(some)), number.reshape(-1)]
                    made += [np.tile(np.arange(1 + hashing.probes) == 0, len(some) * hashing.tables), np.repeat(ids[some], k), np.repeat(n[some], k)]
                    again = np.repeat(own, k, axis=0)
                    lists = pa.ListArray.from_arrays(np.arange(0, again.size + 1, d, dtype=np.int32), pa.array(again.reshape(-1)))
                    yield pa.RecordBatch.from_arrays([*map(pa.array, made), lists], names=["label", "t", "bucket", "home", "id", "n", "vector"])

    kind = df.schema[vector_col].dataType.simpleString()
    visited = points.select("id", "n", "label", "vector").mapInArrow(visits, f"label long, t int, bucket long, home boolean, id long, n long, vector {kind}")
    key = ["label", "t", "bucket"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])
        for c, number in whole_groups(batches, [*key, *PLACE], ("vector",)):
            x = unit(c["vector"])
            known: dict[int, np.ndarray] = {}
            ids, point = np.unique(c["id"], return_inverse=True)
            forest, links = Forest(len(ids)), np.zeros(len(ids), np.int64)
            for a, b in near_pairs(x, number, c["side"], least):
                some = c["home"][a] | c["home"][b]
                a, b = a[some], b[some]
                new = [p for p in np.unique(np.r_[a, b]).tolist() if point[p] not in known]
                known.update(zip(point[new].tolist(), buckets(x[new], hashing), strict=True) if new else ())
                if not len(a):
                    continue
                t, bucket = first_meeting(*(np.array([known[p] for p in point[s].tolist()]) for s in (a, b)))
                first = (t == c["t"][a]) & (bucket == c["bucket"][a])
                a, b = a[first], b[first]
                np.add.at(links, point[a], c["n"][b])
                np.add.at(links, point[b], c["n"][a])
                forest.link(point[a], point[b])
            some = np.flatnonzero(links)
            yield from record_batches({"a": ids[some], "b": ids[forest.label[some]], "links": links[some]}, schema)

    # vectors of several lengths would not fit a matrix; the label's hash holds the length, so a group has one, a batch may not
    lengths = [r[0] for r in points.select(F.size("vector")).distinct().collect()]
    found = None
    for d in lengths:
        part = dealt(visited.filter(F.size("vector") == d), key, "id").mapInArrow(run, "a long, b long, links long")
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = df.sparkSession.createDataFrame([], "a long, b long, links long")
    found = stored(found)
    links = found.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    of = components(found.filter("a <> b").select("a", "b"))
    classes = points.join(links, "id", "left").join(of, points["id"] == of["node"], "left")
    classes = classes.select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", points["id"]).alias("component"))
    both = rows.select("id", "sound", F.when(F.col("sound"), F.col("k1")).alias("k1"), F.when(F.col("sound"), F.col("k2")).alias("k2")).join(classes, ["k1", "k2"], "left")
    component = F.coalesce("component", "id")
    return both.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows in double precision, scaled to length one; scaled by their largest component first, so that none over- or underflows."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
