"""Jaccard similarity of word shingles: two texts are linked where their sets are at least `similarity` alike.

The exact check behind simhash.dedup() for a similarity. Candidates: BANDS * ROWS hashed minima of a text's shingles make BANDS
keys, and texts that share one are a group. Two texts of Jaccard similarity s share a key with chance 1 - (1 - s^ROWS)^BANDS: 0.9993
at 0.8, 0.99999 at 0.85, 0.31 at 0.5. Within a group, SimHash fingerprints of the sets are compared bit-sliced, and those within
simhash.radius_of(similarity) bits are joined to components. Within each component all pairs are compared exactly, by their whole
sets; so no link is false, and one whose own key was missed is still found if others join its texts. Only rows of such components
carry their sets. A component gives a spanning forest of its links, and a large one is cut into blocks that meet pairwise.

Equal sets are one point, so exact copies never meet. Words are lower-cased (A-Z); a text of fewer words than a shingle is one shingle.

Defined results: null and empty texts have an empty set, and are copies of each other alone. Rows with a null id stay and have no
links. Repeated ids join the components of all their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import PLACE, dealt, record_batches, whole_groups
from .common import map_texts, neutral, restored, stored
from .components import Forest, components
from .simhash import fingerprint_of, links_within, radius_of, shingle_hashes

WORDS, SIMILARITY = 5, 0.8
ROWS, BANDS = 6, 24
#: Shingles hashed at a time, columns compared at a time, and rows held at a time beside a block pair.
PIECE, COLUMNS, HELD = 1 << 12, 1 << 12, 1 << 12
_MASKS = np.array([xxhash.xxh64_intdigest(b"minimum", k) for k in range(ROWS * BANDS)], np.uint64)[:, None]
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    return np.unique(shingle_hashes(text, words))


def keys(shingles: np.ndarray) -> list[int]:
    """The keys of a set; none of an empty one."""
    if not len(shingles):
        return []
    least = np.full(ROWS * BANDS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), PIECE):
        mixed = shingles[at : at + PIECE] ^ _MASKS
        mixed *= _ODD
        np.minimum(least, (mixed >> np.uint64(32)).min(1).astype(np.uint32), out=least)
    return [xxhash.xxh64_intdigest(band.tobytes(), k) - (1 << 63) for k, band in enumerate(least.reshape(BANDS, ROWS))]


def marks(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """rows(id, row, text) without text, then print (a digest of the text's set), simhash (its fingerprint) and keys."""

    def start():
        def made(texts):
            sets = [shingle_set(t, words) for t in texts]
            bits = np.array([fingerprint_of(s) for s in sets], np.uint64).view(np.int64)
            return [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], bits, [keys(s) for s in sets]

        return made

    return map_texts(rows, ["id", "row"], "text", start, [T.StructField("print", T.BinaryType()), T.StructField("simhash", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))])


def similar(sets: list[np.ndarray], cut: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of sets at least that similar: i < cut <= j, or i < j if cut is 0. Each set's items are distinct."""
    n, split = len(sets), cut or len(sets)
    sizes = np.array([len(s) for s in sets])
    items, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    row, column = row[times[column] > 1], (np.cumsum(times > 1) - 1)[column[times[column] > 1]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((split, n - cut), np.float32)
    last = int(column[-1]) if len(column) else -1
    for at in range(0, last + 1, COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        held = np.zeros((n, min(COLUMNS, last + 1 - at)), np.float32)
        held[row[a:b], column[a:b] - at] = 1
        common += held[:split] @ held[cut:].T
    i, j = np.nonzero(common)
    j = j + cut
    i, j = i[i < j], j[i < j]
    both = common[i, j - cut].astype(np.float64)
    near = both / (sizes[i] + sizes[j] - both) >= similarity
    return i[near], j[near]


def links(rows: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Edges (a, b) between the ids of rows(component, id, shingles): a forest whose components are those of all links in a component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for c, number in whole_groups(batches, ["component", *PLACE], rows=HELD):
            forest = Forest(len(number))
            begins = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
            for at, end in zip(begins, [*begins[1:], len(number)], strict=True):
                side = c["side"][at:end]
                cut = int((side == 0).sum())
                if side[0] != 2 and cut in (0, len(side)):
                    continue  # the other block is empty
                i, j = similar([np.frombuffer(s, "<u8") for s in c["shingles"][at:end]], cut, similarity)
                forest.link(at + i, at + j)
            a, b = forest.edges()
            yield from record_batches({"a": c["id"][a], "b": c["id"][b]}, schema)

    return dealt(rows, ["component"], "id").mapInArrow(run, "a long, b long")


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of df that stay: one of each component, that of the smallest id; rows with a null id stay.

    df is read twice; give a stored table. Texts move once, to meet the candidate components by their row's key; from there on only rows
    of such components do. All other rows stay as they are.
    """
    own, names = neutral(df)
    id_col, text_col = names[id_col], names[text_col]
    row = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    marked = stored(marks(own.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), row.alias("row"), F.col(text_col).alias("text")), words))
    points = stored(marked.groupBy("print").agg(F.min("id").alias("first"), F.count("*").alias("n"), F.any_value("simhash").alias("simhash"), F.any_value("keys").alias("keys")))
    keyed = points.select("simhash", F.col("first").alias("id"), F.lit(0).alias("choice"), F.explode("keys").alias("key"))
    loose = components(stored(links_within(keyed, radius_of(similarity), [0]).filter("a <> b").distinct()))
    near = points.join(loose, points["first"] == loose["node"], "left").filter("n > 1 OR component IS NOT NULL")
    near = stored(near.select("print", "first", F.coalesce("component", "first").alias("component")))
    candidates = marked.select(F.col("id").alias("__id"), F.col("row").alias("__row"), "print").join(near, "print").distinct()
    met = own.join(candidates, (F.col(id_col) == F.col("__id")) & (row == F.col("__row")), "left")
    met = stored(met.select(*own.columns, "print", "first", "component"))
    some = met.filter(F.col("component").isNotNull())

    def start():
        return lambda texts: ([shingle_set(t, words).astype("<u8").tobytes() for t in texts],)

    texts = some.filter(F.col(id_col) == F.col("first")).select("component", F.col("first").alias("id"), F.col(text_col).alias("text"), "print").dropDuplicates(["print"])
    sets = stored(map_texts(texts, ["component", "id"], "text", start, [T.StructField("shingles", T.BinaryType())]))
    of = components(stored(links(sets, similarity).filter("a <> b").distinct()))
    classes = near.join(of, near["first"] == of["node"], "left").select("print", "first", F.coalesce(of["component"], "first").alias("class"))
    kept = classes.groupBy("class").agg(F.min(F.struct("first", "print")).alias("kept")).select(F.col("kept.first").alias("__id"), F.col("kept.print").alias("__print"))
    one = some.join(kept, (F.col(id_col) == F.col("__id")) & (F.col("print") == F.col("__print")), "left_semi").dropDuplicates([id_col, "print"])
    return restored(met.filter(F.col("component").isNull()).unionByName(one), names)
