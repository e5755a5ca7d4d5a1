"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked at few differing bits.

Candidates: the 64 bits are cut into BANDS bands. Fingerprints that differ in at most `radius` bits agree in at least
BANDS - radius bands, so they meet in one of the groups keyed by each choice of that many bands: no link is lost. Within a
group, distances are compared bit-sliced: up to 64 fingerprints stand vertically, a word for each bit plane; a query's bit turns
a plane into a word of mismatches, carry-save adders count them for all 64 at once, and a block is abandoned once all its
counters exceed the radius. Planes outside the group's shared bands come first.

Equal fingerprints are one point, so exact copies never meet. Large groups are cut into blocks, and each pair of blocks is a
group of its own. A group gives a spanning forest of its links, fewer rows than points.

Given a similarity, dedup() links texts whose sets of shingles have at least that Jaccard similarity. Such sets differ in up to
radius_of(similarity) bits (22 of 64 at 0.8), too many for bands to find: there, groups are keyed by hashed minima, distances within
them are compared bit-sliced as above, and an exact comparison of the sets follows (see jaccard, with the recall).

Defined results: a null or empty text has fingerprint zero and links like any other. Rows with a null id get a fingerprint, but
no links and a null component. Repeated ids join the components of all their texts' fingerprints, each row with that of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import PLACE, dealt, record_batches, whole_groups
from .common import map_texts, neutral, restored, stored
from .components import Forest, components

BANDS = 6
RADIUS = 4
#: Query-block pairs that a task compares at a time.
BATCH_TASKS = 1 << 16
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str | None, shingle: int = 4, seed: int = 42) -> np.ndarray:
    """Hashes of the runs of `shingle` words, one of the whole text where it has fewer; none where it has no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, seed)] if words else [], "<u8")
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    return np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=False)], "<u8")


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    return fingerprint_of(shingle_hashes(text, shingle, seed))


def fingerprint_of(h: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; 0 without hashes."""
    n = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        n += np.unpackbits(h[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * n > len(h), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, shingle: int = 4, seed: int = 42, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, then simhash long: the fingerprint's 64 bits."""

    def start():
        return lambda texts: (np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64).view(np.int64),)

    return map_texts(df, df.columns if keep is None else keep, text_col, start, [T.StructField("simhash", T.LongType())])


def band_masks(bands: int) -> list[int]:
    cuts = [round(64 * k / bands) for k in range(bands + 1)]
    return [((1 << b) - 1) & ~((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def bit_planes(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vertical storage: for each block of up to 64 points, 64 words; bit l of word p is bit p of the block's point l.

    starts, sizes: the runs of points that may not share a block. Returns planes[block, 64], each block's first point, its size.
    """
    blocks = -(-sizes // 64)
    run = np.repeat(np.arange(len(sizes)), blocks)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    first = starts[run] + 64 * nth
    size = np.minimum(64, sizes[run] - 64 * nth)
    planes = np.zeros((len(run), 64), np.uint64)
    for lane in range(64):
        full = np.flatnonzero(size > lane)
        if not len(full):
            break
        bits = np.unpackbits(points[first[full] + lane].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.uint64)
        planes[full] |= bits << np.uint64(lane)
    return planes, first, size


def near_lanes(queries: np.ndarray, planes: np.ndarray, lanes: np.ndarray, order: np.ndarray, radius: int) -> np.ndarray:
    """For each task (a query and a block's 64 planes), a word with the lanes at most radius bits away.

    Counters are bit-sliced: word k of a task holds bit k of all 64 counts, and a last word remembers lanes that ran over.
    order: the planes of each task, as they are taken. lanes: the lanes to look at.
    """
    width = (radius + 1).bit_length()
    out = np.zeros(len(queries), np.uint64)
    alive = np.arange(len(queries))
    counts = [np.zeros(len(queries), np.uint64) for _ in range(width)]
    over = ~lanes

    def mismatch(k: int) -> np.ndarray:
        p = order[alive, k]
        wanted = np.uint64(0) - ((queries[alive] >> p.astype(np.uint64)) & np.uint64(1))
        return planes[alive, p] ^ wanted

    def add(at: int, x: np.ndarray) -> None:
        for c in range(at, width):
            counts[c], x = counts[c] ^ x, counts[c] & x
        np.bitwise_or(over, x, out=over)

    for k in range(0, 64, 4):
        # a carry-save adder takes three words to a sum of weight one and a carry of weight two
        a, b, c, d = (mismatch(k + i) for i in range(4))
        ones, twos = a ^ b ^ c, (a & b) | (c & (a ^ b))
        add(0, ones)
        add(0, d)
        add(1, twos)
        if k % 8 == 4:
            far = over | _above(counts, radius)
            going = far != ONES
            if not going.all():
                alive, over = alive[going], over[going]
                counts = [x[going] for x in counts]
            if not len(alive):
                return out
    out[alive] = ~(over | _above(counts, radius))
    return out


def _above(counts: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is over radius."""
    above, equal = np.zeros_like(counts[0]), ~np.zeros_like(counts[0])
    for k in range(len(counts) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counts[k]
        else:
            above |= equal & counts[k]
            equal &= ~counts[k]
    return above


def compare(points: np.ndarray, group: np.ndarray, side: np.ndarray, choice: np.ndarray, masks: list[int], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within each group. Rows come sorted by (group, side).

    side 0 and 1 link across (two blocks of a hot group); a group of side 2 links within. choice: the group's bands, by number.
    """
    forest = Forest(len(points))
    run_at = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (side[1:] != side[:-1])])
    run_size = np.diff(np.r_[run_at, len(points)])
    planes, first, size = bit_planes(points, run_at, run_size)
    block_run = np.searchsorted(run_at, first, "right") - 1
    run_block = np.searchsorted(block_run, np.arange(len(run_at)))
    run_blocks = np.bincount(block_run, minlength=len(run_at))
    # each point meets the blocks of its own run (side 2), from its own block on, or those of the next run (side 0)
    run = np.repeat(np.arange(len(run_at)), run_size)
    kind = side[run_at]
    next_run = np.minimum(run + 1, len(run_at) - 1)
    across = (kind[run] == 0) & (group[run_at[next_run]] == group) & (kind[next_run] == 1)
    within = kind[run] == 2
    to = np.where(across, next_run, run)
    own = (np.arange(len(points)) - run_at[run]) // 64
    from_block = run_block[to] + np.where(within, own, 0)
    n_blocks = np.where(across | within, run_blocks[to] - np.where(within, own, 0), 0)
    ends = np.cumsum(n_blocks)
    orders = _plane_orders(masks)
    lane_words = np.array([(1 << n) - 1 for n in range(65)], np.uint64)
    start = 0
    while start < len(points):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + BATCH_TASKS, "right")))
        who = np.repeat(np.arange(start, stop), n_blocks[start:stop])
        if len(who):
            block = from_block[who] + np.arange(len(who)) - np.repeat(ends[start:stop] - n_blocks[start:stop] - base, n_blocks[start:stop])
            lanes = lane_words[size[block]]
            before = np.where(within[who], np.clip(who + 1 - first[block], 0, 64), 0)  # only later points of its own block
            lanes = lanes & ~lane_words[before]
            near = near_lanes(points[who], planes[block], lanes, orders[choice[who]], radius)
            hit = np.flatnonzero(near)
            for k in range(0, len(hit), 1 << 13):
                some = hit[k : k + (1 << 13)]
                task, lane = np.nonzero(np.unpackbits(near[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                forest.link(who[some][task], first[block[some]][task] + lane)
        start = stop
    return forest.edges()


def _plane_orders(masks: list[int]) -> np.ndarray:
    """For each choice of bands, the 64 planes with those of its bands last."""
    return np.array([sorted(range(64), key=lambda p: (m >> p & 1, p)) for m in masks])


def radius_of(similarity: float) -> int:
    """Bits in which the fingerprints of two sets of that Jaccard similarity may differ, at 4.3 standard deviations.

    The cosine of two sets is 2 s / (1 + s) at least, and each bit differs with the chance of their angle over pi.
    """
    p = float(np.arccos(min(1.0, 2 * similarity / (1 + similarity))) / np.pi)
    return round(64 * p + 4.3 * (64 * p * (1 - p)) ** 0.5)


def links(points: DataFrame, radius: int = RADIUS, bands: int = BANDS) -> DataFrame:
    """Edges (a, b) between the ids of points(simhash, id): a forest whose components are those of all links."""
    cuts = band_masks(bands)
    masks = [sum(x) for x in combinations(cuts, bands - radius)]
    keyed = F.array(*(F.struct(F.lit(k).alias("choice"), F.col("simhash").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("key")) for k, m in enumerate(masks)))
    return links_within(points.select("simhash", "id", F.explode(keyed).alias("g")).select("simhash", "id", "g.*"), radius, masks)


def links_within(rows: DataFrame, radius: int, masks: list[int]) -> DataFrame:
    """Edges (a, b) between the ids of rows(simhash, id, choice, key): a forest of the links within each choice and key.

    masks: by choice, the bits that rows of one key have in common.
    """
    key = ["choice", "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for c, number in whole_groups(batches, [*key, *PLACE]):
            a, b = compare(c["simhash"].view(np.uint64), number, c["side"], c["choice"], masks, radius)
            yield from record_batches({"a": c["id"][a], "b": c["id"][b]}, schema)

    return dealt(rows, key, "id").mapInArrow(run, "a long, b long")


def near_duplicates(prints: DataFrame, id_col: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """(id, simhash, component_id) for each row of prints(id, simhash): the smallest id that links reach from it, itself included.

    prints is read several times; give a stored table.
    """
    points = stored(prints.filter(F.col(id_col).isNotNull()).groupBy("simhash").agg(F.min(id_col).alias("id")))
    found = stored(links(points, radius).distinct())
    of = components(found)
    classes = points.join(of, points["id"] == of["node"], "left").select("simhash", F.coalesce("component", "id").alias("component_id"))
    joined = prints.select(F.col(id_col), F.col("simhash")).join(classes, "simhash", "left")
    return joined.select(id_col, "simhash", F.when(F.col(id_col).isNotNull(), F.col("component_id")).alias("component_id"))


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = 4, similarity: float | None = None) -> DataFrame:
    """The rows of df that stay: one of each component, that of the smallest id; rows with a null id stay.

    Texts are linked whose fingerprints differ in at most `radius` bits, or, if a similarity is given, whose sets of shingles have at
    least that Jaccard similarity.
    """
    if similarity is not None:
        from . import jaccard

        return jaccard.dedup(df, id_col, text_col, shingle, similarity)
    own, names = neutral(df)
    id_col, text_col = names[id_col], names[text_col]
    whole = stored(fingerprints(own, shingle, text_col=text_col))
    found = stored(near_duplicates(whole.select(id_col, "simhash"), id_col, radius))
    return survivors(whole, found, [id_col, "simhash"], names)


def survivors(whole: DataFrame, found: DataFrame, key: list[str], names: dict[str, str]) -> DataFrame:
    """Of each component in found(*key, component_id), one row of whole that has the smallest key; rows with a null id, key[0], stay."""
    id_col = key[0]
    first = found.filter(F.col("component_id").isNotNull()).groupBy("component_id").agg(F.min(F.struct(*key)).alias("first")).select("first.*")
    rows = whole.filter(F.col(id_col).isNotNull()).groupBy(*key).count()
    first = stored(first.join(rows, key))
    single = whole.join(first.filter("count = 1").select(*key), key, "left_semi")
    repeated = whole.join(first.filter("count > 1").select(*key), key, "left_semi").dropDuplicates(key)
    unknown = whole.filter(F.col(id_col).isNull())
    return restored(single.unionByName(repeated).unionByName(unknown), names)
