"""Scores of texts by language models learnt from a corpus: word frequencies, and online logistic context mixing (see mixer).

Texts are lower-cased (A-Z) and stored by chunks of about CHUNK bytes of consecutive texts, or of one longer text.

Word frequencies: a chunk's distinct words, in an order fixed by its texts, are listed as it is stored, dealt by a hash to pieces of the
vocabulary, each word with its number in the chunk's training texts. A piece adds these up and answers each chunk's list with the
sums alone. So each distinct word of a chunk moves once and its sum once, a common word once a chunk, and no task holds more than a
piece. Answers meet the texts in one task a chunk.

Context mixing: each task counts what follows its training texts' hashed contexts; pieces of the tables are summed across tasks and
turned into predictions, a byte a slot. The tables double with each eightfold of the corpus, as contexts repeat (8 MB at 30 GB of text,
120 MB at 100 TB); they are broadcast. Counts cover all training texts. Nothing is fitted on a sample.

Defined results: a null text is scored like an empty one: one token, its end. With no training rows all counts are 0 and the mixer
predicts nothing at first. Rows are told apart by their place in a chunk, so null and repeated ids keep a row each; equal texts get
equal scores. Columns other than the id and the text are not read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import mixer
from .common import stored

#: Bytes of a chunk; of the corpus for a piece of the vocabulary; pieces that the tables are summed in.
CHUNK, PIECE_BYTES, PIECES = 4 << 20, 8 << 20, 64
#: Texts that an input batch may hold before its bytes are looked at.
SLICE = 256


def tokens(text: bytes) -> list[bytes]:
    """Words of a text in lower case."""
    return text.split()


def chunks(df: DataFrame, id_col: str, text_col: str, training: Column, pieces: int) -> DataFrame:
    """Two kinds of rows. Texts: chunk, nth (its place there), id, training, text. Lists (text is null): chunk, piece, words (blank-joined),
    counts (their numbers in the chunk's training texts); piece -1: counts has how often these hold each byte."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(training, F.lit(False)).alias("training"), text.alias("text"))
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("nth", T.IntegerType()), rows.schema["id"], T.StructField("training", T.BooleanType()), T.StructField("text", T.BinaryType()), T.StructField("piece", T.IntegerType()), T.StructField("words", T.BinaryType()), T.StructField("counts", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        number, size = TaskContext.get().partitionId() << 33, 0
        ids, learnt, texts = [], [], []

        def made(n: int, **columns: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(columns.get(k.name, [None] * n), k.type) for k in kinds], schema=kinds)

        def out() -> Iterator[pa.RecordBatch]:
            for k in range(0, len(texts), SLICE):
                some = texts[k : k + SLICE]
                yield made(len(some), chunk=[number] * len(some), nth=list(range(k, k + len(some))), id=ids[k : k + SLICE], training=learnt[k : k + SLICE], text=some)
            times = counted(texts, learnt)
            words, counts, held = list(times), np.fromiter(times.values(), "<i4", len(times)), np.zeros(256, np.int64)
            for text, t in zip(texts, learnt, strict=True):
                if t:
                    held += np.bincount(np.frombuffer(text, np.uint8), minlength=256)
            of = dealt(words, pieces)
            full = [p for p in range(pieces) if len(of[p])]
            lists = [b" ".join([words[i] for i in of[p].tolist()]) for p in full]
            numbers = [counts[of[p]].tobytes() for p in full]
            yield made(len(full) + 1, chunk=[number] * (len(full) + 1), piece=[*full, -1], words=[*lists, None], counts=[*numbers, held.tobytes()])

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                for i, t, x in zip(*(batch.column(k).slice(at, SLICE).to_pylist() for k in ("id", "training", "text")), strict=True):
                    if texts and size + len(x) > CHUNK:
                        yield from out()
                        number, size, ids, learnt, texts = number + 1, 0, [], [], []
                    ids.append(i)
                    learnt.append(t)
                    texts.append(x.lower())
                    size += len(x)
        if texts:
            yield from out()

    return rows.mapInArrow(run, schema)


def counted(texts: list[bytes], learnt: list[bool]) -> dict[bytes, int]:
    """The distinct words with their numbers in the training texts: first those of other texts, then the rest, each in order of first use."""
    out = dict.fromkeys(chain.from_iterable(tokens(x) for x, t in zip(texts, learnt, strict=True) if not t), 0)
    out.update(Counter(chain.from_iterable(tokens(x) for x, t in zip(texts, learnt, strict=True) if t)))
    return out


def numbered(texts: list[bytes], learnt: list[bool]) -> tuple[list[np.ndarray], list[bytes]]:
    """The numbers of each text's words, and the distinct words by number, in counted()'s order."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    ids = [np.zeros(0, np.int64)] * len(texts)
    for i in sorted(range(len(texts)), key=learnt.__getitem__):
        words = tokens(texts[i])
        ids[i] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    return ids, list(number)


def dealt(words: list[bytes], pieces: int) -> list[np.ndarray]:
    """The numbers of each piece's words."""
    piece = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % pieces
    order = np.argsort(piece, kind="stable")
    return np.split(order, np.searchsorted(piece[order], np.arange(1, pieces)))


def summed(lists: DataFrame) -> DataFrame:
    """(chunk, piece, sums): for each list, its words' numbers in the corpus. A row of each piece without a chunk has its distinct known
    words (v) and their total (n)."""

    def run(group: pa.Table) -> pa.Table:
        total: dict[bytes, int] = {}
        split = [x.split() for x in group.column("words").to_pylist()]
        for words, counts in zip(split, group.column("counts").to_pylist(), strict=True):
            for w, c in zip(words, np.frombuffer(counts, "<i4").tolist(), strict=True):
                total[w] = total.get(w, 0) + c
        at = total.__getitem__
        sums = [np.fromiter(map(at, words), "<i8", len(words)).tobytes() for words in split]
        known = [c for c in total.values() if c]
        n = len(split)
        piece = group.column("piece").to_pylist()
        return pa.table({"chunk": pa.array([*group.column("chunk").to_pylist(), None], pa.int64()), "piece": pa.array([*piece, piece[0]], pa.int32()), "sums": pa.array([*sums, None], pa.binary()), "v": pa.array([None] * n + [len(known)], pa.int64()), "n": pa.array([None] * n + [sum(known)], pa.int64())})

    return lists.groupBy("piece").applyInArrow(run, "chunk long, piece int, sums binary, v long, n long")


def byte_counts(lists: DataFrame) -> np.ndarray:
    """How often the training texts hold each byte."""
    found = lists.filter("piece = -1").select("counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            for x in batch.column("counts").to_pylist():
                total += np.frombuffer(x, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], names=["byte", "n"])

    out = np.zeros(256, np.int64)
    for r in found.mapInArrow(run, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        out[r["byte"]] = r["n"]
    return out


def context_table(rows: DataFrame, form: mixer.Shape) -> np.ndarray:
    """The mixer's predictions from all training texts."""
    pieces = PIECES
    size = -(-form.total // pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, some = np.zeros(2 * size * pieces, np.int32), False
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                mixer.count(counts[: 2 * form.total], form, batch.column("text").slice(at, SLICE).to_pylist())
                some = True
        for piece in range(pieces if some else 0):
            part = counts[2 * piece * size : 2 * (piece + 1) * size]
            full = np.flatnonzero(part)
            gaps = np.diff(full, prepend=0)
            narrow = lambda x: x.astype("<u2" if not len(x) or x.max() < 1 << 16 else "<u4")
            made = [narrow(gaps), narrow(part[full])]
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([len(full)], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in made)], names=["piece", "n", "gaps", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, n, *parts in zip(*(batch.column(k).to_pylist() for k in ("piece", "n", "gaps", "counts")), strict=True):
                if piece not in sums:
                    sums[piece] = np.zeros(2 * size, np.int64)
                gaps, counts = (np.frombuffer(x, "<u2" if len(x) == 2 * n else "<u4") for x in parts)
                sums[piece][np.cumsum(gaps, dtype=np.int64)] += counts
        for piece, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([mixer.predictions(s).tobytes()])], names=["piece", "predictions"])

    counted = rows.filter("training AND text IS NOT NULL").select("text").mapInArrow(run, "piece int, n long, gaps binary, counts binary")
    out = np.zeros(size * pieces, np.int8)
    for r in counted.repartition(pieces, "piece").mapInArrow(add, "piece int, predictions binary").collect():
        out[r["piece"] * size : (r["piece"] + 1) * size] = np.frombuffer(r["predictions"], np.int8)
    return out[: form.total]


def score(df: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: id, training, n_tokens, n_known, train_tokens, base_score, score (both log10), n_bytes, bits_per_byte."""
    n_bytes = df.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    pieces = max(1, -(-n_bytes // PIECE_BYTES))
    rows = stored(chunks(df, id_col, text_col, training, pieces))
    lists = rows.filter("piece IS NOT NULL").select("piece", "chunk", "words", "counts")
    by_byte = byte_counts(lists)
    n_training = rows.filter("training").count()
    answers = stored(summed(lists.filter("piece >= 0")))
    totals = answers.filter("chunk IS NULL").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).first()
    n_all = (totals["n"] or 0) + n_training
    distinct = (totals["v"] or 0) + bool(n_training)
    form = mixer.shape(by_byte, int(by_byte.sum()))
    shared = df.sparkSession.sparkContext.broadcast(context_table(rows, form))
    bottom = np.log10(n_all + 0.5 * (distinct + 1))
    end = float(np.log10(n_training + 0.5) - bottom)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("nth")
        texts = left.column("text").to_pylist()
        ids, words = numbered(texts, left.column("training").to_pylist())
        c, of = np.zeros(len(words), np.int64), dealt(words, pieces)
        for piece, sums in zip(right.column("piece").to_pylist(), right.column("sums").to_pylist(), strict=True):
            c[of[piece]] = np.frombuffer(sums, "<i8")
        logs, known = np.log10(c + 0.5) - bottom, c > 0
        bits = mixer.code(shared.value, form, texts)
        sizes = np.array([len(x) for x in texts])
        return pa.table(
            {
                "id": left.column("id"), "training": left.column("training"),
                "n_tokens": np.array([len(x) + 1 for x in ids]), "n_known": np.array([int(known[x].sum()) + (n_training > 0) for x in ids]),
                "base_score": np.array([float(logs[x].sum()) + end for x in ids]), "score": bits * -float(np.log10(2)), "n_bytes": sizes, "bits_per_byte": bits / np.maximum(1, sizes),
            }
        )

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, training boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long, bits_per_byte double"
    texts = rows.filter("text IS NOT NULL").select("chunk", "nth", "id", "training", "text")
    found = texts.groupBy("chunk").cogroup(answers.filter("chunk IS NOT NULL").select("chunk", "piece", "sums").groupBy("chunk")).applyInArrow(run, schema)
    return found.withColumn("train_tokens", F.lit(n_all).cast("long")).withColumnRenamed("id", id_col)
