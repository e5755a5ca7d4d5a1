"""Phrase collocations by hashed bucket counts: each pass counts phrases of k words exactly and hashes those of k + 1 into buckets.

A phrase of k + 1 words is counted in the next pass only if its bucket held enough (the bucket's bit is set) and both phrases of k
words inside it are frequent, which a second set of bits tells. Both sets are broadcast; each has 2 ** bits bits, whatever the corpus.
A bit shared by several phrases lets one through that is then counted in vain; no frequent phrase is lost. Tasks add up a slice of text
in numpy; Spark's partial sums add the slices of a task, so a word of every document leaves a task as one row. Bucket counts travel packed,
two bytes for a bucket that a slice meets once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, stored

# What parts pieces; letters that are lower-cased.
SEPARATORS, UPPER, LOWER = b".,;:!?\x0a\x0b\x0c\x0d", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes.maketrans(UPPER + SEPARATORS, LOWER + b"." * len(SEPARATORS))
#: Bytes of text that a task looks at together.
SLICE = 4 << 20
#: Rows that leave a task at once.
ROWS = 1 << 17
#: log2 of the buckets that are counted together; their bits are a row of 4 KB.
PART = 15
_SCHEMA = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("phrase", T.StringType()), T.StructField("bucket", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("part", T.IntegerType()), T.StructField("ones", T.BinaryType()), T.StructField("more", T.BinaryType()), T.StructField("counts", T.BinaryType()),
])
_ARROW = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("bucket", pa.int64()), ("n", pa.int64()), ("part", pa.int32()), ("ones", pa.binary()), ("more", pa.binary()), ("counts", pa.binary())])


def _batch(**columns: pa.Array) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in _ARROW], schema=_ARROW)


def _packed(buckets: np.ndarray, parts: int) -> pa.RecordBatch:
    """Counts of buckets, a row for each part: places that stand once, places that stand more often, and how often."""
    values, n = np.unique(buckets, return_counts=True)

    def of(chosen: np.ndarray, data: np.ndarray) -> pa.Array:
        ends = np.searchsorted(values[chosen] >> PART, np.arange(parts + 1)) * data.itemsize
        return pa.Array.from_buffers(pa.binary(), parts, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[chosen]))])

    place = (values & ((1 << PART) - 1)).astype("<u2")
    made = _batch(part=pa.array(np.arange(parts, dtype=np.int32)), ones=of(n == 1, place), more=of(n > 1, place), counts=of(n > 1, n.astype("<u4")))
    return made.take(pa.array(np.unique(values >> PART)))


@dataclass(frozen=True)
class PhraseOptions:
    """least: occurrences of a candidate. longest: words of one. cover: percent of a candidate's occurrences that lie in a longer
    one for it to go. top: phrases returned a language. bits: log2 of the sets' sizes, 8 MB each at 26; results don't depend on it."""

    least: int = 30
    longest: int = 4
    cover: int = 80
    top: int = 2000
    bits: int = 26


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _parts(text: bytes, size: int) -> Iterator[tuple[bytes, int]]:
    """A long text in parts of about `size` bytes, cut at a blank or separator, and how many of a part's first words were in the last.

    Those words, three at most and of the same piece, let phrases cross the cut; a phrase belongs to the part of its last word.
    """
    at, lead = 0, b""
    while at < len(text):
        stop = min(len(text), at + size)
        if stop < len(text):
            cut = max(text.rfind(c, at, stop) for c in (b".", b" ", b"\t"))
            if cut < 0:
                cut = min((p for c in (b".", b" ", b"\t") if (p := text.find(c, stop)) >= 0), default=len(text) - 1)
            stop = cut + 1
        part = lead + text[at:stop]
        yield part, len(lead.split())
        words = part.rpartition(b".")[2].rsplit(None, 3)[-3:] if stop < len(text) else []
        lead, at = b" ".join([*words, b""]) if words else b"", stop


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list[str], list[bytes], int]]:
    """Languages, their joined texts and the words to leave out at the start; texts of a language are parted like pieces."""
    held: dict[str, list[bytes]] = {}
    total = 0
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for i, lang in enumerate(batch.column(0).to_pylist()):
            text = texts[i].as_py().translate(_TABLE)
            if len(text) > size:
                for part, old in _parts(text, size):
                    yield [lang], [part], old
                continue
            held.setdefault(lang, []).append(text)
            total += len(text)
            if total >= size:
                yield list(held), [b".".join(t) for t in held.values()], 0
                held, total = {}, 0
    if held:
        yield list(held), [b".".join(t) for t in held.values()], 0


class _Words:
    """The words of a slice: numbers of distinct words, of languages and pieces, and stable hashes."""

    def __init__(self, langs: list[str], texts: list[bytes]):
        from xxhash import xxh3_64_intdigest as digest

        data = np.frombuffer(b".".join(texts), np.uint8)
        parting = data == 46
        inside = ~(parting | (data == 32) | (data == 9))
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]).dictionary_encode()
        self.langs, self.words = langs, words.dictionary
        self.word = words.indices.to_numpy()
        self.piece = np.cumsum(parting, dtype=np.int32)[starts]
        self.lang = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, "right").astype(np.int32)
        known = np.fromiter((digest(w) for w in self.words.to_pylist()), np.uint64, len(self.words))
        self.hash = known[self.word]
        self.start = np.fromiter((digest(x.encode(), seed=7) for x in langs), np.uint64, len(langs))

    def hashes(self, k: int, at: np.ndarray) -> np.ndarray:
        """Of the phrases of k words that begin at these places."""
        h = self.start[self.lang[at]]
        for j in range(k):
            h = _mixed(h * np.uint64(0xD6E8FEB86659FD93) + self.hash[at + j])
        return h

    def places(self, k: int) -> np.ndarray:
        """Where a phrase of k words begins: pieces don't cross languages, so neither do phrases."""
        n = len(self.word) - k + 1
        return np.flatnonzero(self.piece[: max(n, 0)] == self.piece[k - 1 :]) if n > 0 else np.zeros(0, np.int64)

    def numbers(self, k: int, at: np.ndarray) -> np.ndarray:
        """Equal for equal phrases of a language, and for them alone."""
        n = len(self.words)
        key = self.lang[at].astype(np.int64) * n + self.word[at]
        for j in range(1, k):
            key = np.unique(key, return_inverse=True)[1] * n + self.word[at + j]
        return key

    def phrases(self, k: int, at: np.ndarray) -> tuple[pa.Array, pa.Array]:
        words = [self.words.take(pa.array(self.word[at + j])) for j in range(k)]
        joined = pc.binary_join_element_wise(*words, b" ") if k > 1 else words[0]
        return pa.array(self.langs, pa.string()).take(pa.array(self.lang[at])), joined.cast(pa.string())


def _has(bits: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return (bits[bucket >> 3] >> (bucket & 7).astype(np.uint8)) & 1 == 1


def _pass(texts: DataFrame, k: int, last: int, bits: int, frequent, buckets, size: int) -> DataFrame:
    """Counts of phrases of k words (lang, phrase, bucket, n), of all words (lang, n), and of the buckets of longer phrases, by parts.

    frequent, buckets: broadcast sets of the frequent phrases of k - 1 words and the buckets of k words; none in the first pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in counted(batches):
            yield from (made.slice(i, ROWS) for i in range(0, made.num_rows, ROWS))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.uint64(64 - bits)
        bucket = lambda w, j, at: (w.hashes(j, at) >> shift).astype(np.int64)
        for langs, joined, old in _slices(batches, size):
            w = _Words(langs, joined)
            tried = w.places(k)
            if k > 1:
                tried = tried[np.logical_and(*(_has(frequent.value, bucket(w, k - 1, tried + j)) for j in (0, 1)))]
                tried = tried[_has(buckets.value, bucket(w, k, tried))]
            # phrases that end in words of the part before were counted there
            at = tried[tried + k - 1 >= old]
            if len(at):
                _, first, n = np.unique(w.numbers(k, at), return_index=True, return_counts=True)
                first = at[first]
                lang, phrase = w.phrases(k, first)
                yield _batch(lang=lang, phrase=phrase, bucket=pa.array(bucket(w, k, first)), n=pa.array(n))
            if k < last:
                longer = w.places(k + 1)
                longer = longer[longer + k >= old]
                if k > 1:
                    fit = np.zeros(len(w.word), bool)
                    fit[tried] = True
                    longer = longer[fit[longer] & fit[longer + 1]]
                if len(longer):
                    yield _packed(bucket(w, k + 1, longer), max(1, 1 << bits >> PART))
            if k == 1:
                n = np.bincount(w.lang[old:], minlength=len(langs))
                yield _batch(lang=pa.array(langs, pa.string()), n=pa.array(n))

    return texts.mapInArrow(run, _SCHEMA)


def _broadcast(parts: DataFrame, bits: int):
    """Rows (part, held) as one array of bits on all executors. At most 2 ** (bits - 15) rows of 4 KB reach the driver."""
    out = np.zeros(max(1 << bits >> 3, 4096), np.uint8)
    for r in parts.collect():
        out[r.part * 4096 : (r.part + 1) * 4096] = np.frombuffer(r.held, np.uint8)
    return parts.sparkSession.sparkContext.broadcast(out)


def _frequent(phrases: DataFrame) -> DataFrame:
    """The set of the phrases' buckets."""
    place = F.col("bucket") + 1
    return phrases.groupBy((F.bitmap_bucket_number(place) - 1).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("held"))


def _full(packed: DataFrame, least: int) -> DataFrame:
    """The set of the buckets that hold enough: rows of a part come to one task, one after another, which holds that part's counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros(1 << PART, np.int64)

        def made() -> pa.RecordBatch:
            held = np.packbits(sums >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([held], pa.binary())], names=["part", "held"])

        for batch in batches:
            for part, ones, more, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if part != now:
                    if now is not None:
                        yield made()
                    now, sums = part, np.zeros(1 << PART, np.int64)
                sums[np.frombuffer(ones, "<u2")] += 1
                sums[np.frombuffer(more, "<u2")] += np.frombuffer(n, "<u4")
        if now is not None:
            yield made()

    rows = packed.select("part", "ones", "more", "counts").repartition("part").sortWithinPartitions("part")
    return rows.mapInArrow(run, "part int, held binary")


def counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", options: PhraseOptions = PhraseOptions(), size: int = SLICE) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n) for every phrase of up to `longest` words that occurs `least` times; (lang, n) for all words.

    Occurrences are contiguous, within a piece, and may overlap. A null lang is `und`, a null text has no words. Long texts are read in
    parts, so memory follows `size` and the longest word. An empty table gives empty results.
    """
    texts = df.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    frequent = buckets = totals = out = None
    for k in range(1, options.longest + 1):
        made = stored(_pass(texts, k, options.longest, options.bits, frequent, buckets, size))
        sums = made.filter("part IS NULL").groupBy("lang", "phrase", "bucket").agg(F.sum("n").alias("n"))
        found = stored(sums.filter((F.col("n") >= options.least) | F.col("bucket").isNull()))
        phrases = found.filter("phrase IS NOT NULL")
        mine = phrases.select("lang", "phrase", F.lit(k).alias("words"), "n")
        out = mine if out is None else out.union(mine)
        if k == 1:
            totals = found.filter("bucket IS NULL").select("lang", "n")
        if k < options.longest:
            for old in (frequent, buckets):
                if old is not None:
                    old.unpersist()
            frequent = _broadcast(_frequent(phrases), options.bits)
            buckets = _broadcast(_full(made.filter("part IS NOT NULL"), options.least), options.bits)
        discard(made)
    return out, totals


def mine(df: DataFrame, text_col: str = "text", lang_col: str = "lang", options: PhraseOptions = PhraseOptions(), size: int = SLICE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` collocations of each language.

    A candidate has two words or more and a occurrences, `least` at the least. A cut after its k-th word has l and r occurrences of its sides and
    scores floor(2000000 * a / (l + r)); the lowest-scoring cut counts, the first of equals. A candidate goes if a longer one that holds its
    words contiguously has `cover` percent of its occurrences or more. Order: score and a falling, phrase by bytes. n: all words of the language.

    Odd rows as for counts(): a null lang is `und`, null and empty texts have no words; repeated rows count as often as they stand. Other
    columns are ignored.
    """
    table, totals = counts(df, text_col, lang_col, options, size)
    candidates = table.filter("words > 1").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))

    sides = lambda at: (F.array_join(F.slice("w", F.lit(1), at), " "), F.array_join(F.slice("w", at + 1, F.size("w") - at), " "))
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    left, right = sides(F.col("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", left.alias("left"), right.alias("right"))
    cuts = cuts.join(table.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(table.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    score = F.expr("CAST((CAST(a AS DECIMAL(20, 0)) * CAST(2000000 AS DECIMAL(7, 0))) DIV CAST(l + r AS DECIMAL(20, 0)) AS BIGINT)")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))

    inner = F.expr("flatten(transform(sequence(2, size(w) - 1), k -> transform(sequence(1, size(w) - k + 1), i -> array_join(slice(w, i, k), ' '))))")
    covers = candidates.filter(F.size("w") > 2).select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(covers, ["lang", "phrase"], "left").filter(~F.coalesce(100 * F.col("longer") >= options.cover * F.col("a"), F.lit(False)))
    kept = stored(kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score"))

    # only scores from the coarse step on that holds the last place are ranked, first by shares of a language, then together
    step = F.floor(F.col("score") / 1000)
    steps = kept.groupBy("lang", step.alias("step")).count()
    above = F.sum("count").over(Window.partitionBy("lang").orderBy(F.desc("step"))) - F.col("count")
    least = steps.withColumn("above", above).filter(F.col("above") < options.top).groupBy("lang").agg(F.min("step").alias("least"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = kept.join(least, "lang").filter(step >= F.col("least")).withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(32)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).filter(F.col("rank") <= options.top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= options.top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
