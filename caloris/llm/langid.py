"""Language identification by word-first backoff.

A known word scores the log of its frequency in each language. A word not known in any falls back to its character n-grams, from
the longest length down to one: the first length at which any n-gram is known gives the mean of the known ones' log frequencies.
A text's score for a language is the sum over its words; whole texts are read.

Fitting: a classifier is learnt from a bounded sample of labelled rows, about sample_docs a language and sample_total in all, drawn by a
hash of the id; every language takes part, and so does all that stands in the sample at least min_count times in a language.

Defined results: lang_pred is `und` and score 0 where a text is null or has no letter, and everywhere if nothing was learnt. Ties
go to the language first by code point. Rows with a null or empty lang teach nothing. Rows are scored independently of each other,
so repeated rows give repeated results and an empty table an empty one. lang, source and id never enter a prediction.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, neutral, restored

UNKNOWN = "und"
#: Words a task remembers.
CACHE_WORDS = 150_000
_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case; none where no character is a letter."""
    if not text:
        return []
    found = _WORDS.findall(text.lower())
    return found if any(c.isalpha() for w in found for c in w) else []


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word between its two edge marks; single letters go without marks."""
    if n == 1:
        return list(word)
    marked = f"\x02{word}\x03"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Table(Mapping):
    """Vectors by key, as rows of one matrix."""

    def __init__(self, index: dict[str, int], rows: np.ndarray):
        self.index, self.rows = index, rows

    def __getitem__(self, key: str) -> np.ndarray:
        return self.rows[self.index[key]]

    def get(self, key: str, default=None):
        at = self.index.get(key)
        return default if at is None else self.rows[at]

    def __contains__(self, key: object) -> bool:
        return key in self.index

    def __iter__(self) -> Iterator[str]:
        return iter(self.index)

    def __len__(self) -> int:
        return len(self.index)


@dataclass
class Model:
    """Log frequencies: words[w] and grams[n][g] are a vector over langs."""

    langs: list[str]
    words: Mapping[str, np.ndarray]
    grams: dict[int, Mapping[str, np.ndarray]]

    def word(self, w: str) -> np.ndarray:
        found = self.words.get(w)
        if found is not None:
            return found
        for n in sorted(self.grams, reverse=True):
            table = self.grams[n]
            if isinstance(table, Table):
                known = table.rows[[i for i in map(table.index.get, grams_of(w, n)) if i is not None]]
            else:
                known = [table[g] for g in grams_of(w, n) if g in table]
            if len(known):
                return np.mean(known, axis=0)
        return np.zeros(len(self.langs))


class Scorer:
    """Scores of words, remembered; emptied when it holds CACHE_WORDS."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.model.langs)))

    def totals(self, texts: list[list[str]]) -> list[np.ndarray]:
        words = set().union(*texts)
        new = list(words.difference(self.index))
        if len(self.index) + len(new) > CACHE_WORDS:
            self.clear()
            new = list(words)
        if new:
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            if len(self.index) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((len(self.index), len(self.model.langs)))])
            self.rows[len(self.index) - len(new) : len(self.index)] = [self.model.word(w) for w in new]
        at = self.index.__getitem__
        return [self.rows[np.fromiter(map(at, t), np.int64, len(t))].sum(0) for t in texts]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        split = [words_of(t) for t in texts]
        if not self.model.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        langs, scores = [], []
        for words, total in zip(split, self.totals(split), strict=True):
            if not words:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            # words of one text are not independent: their evidence counts by the root of their number
            x = np.exp((total - total.max()) / np.sqrt(len(words)))
            best = int(total.argmax())
            langs.append(self.model.langs[best])
            scores.append(float(x[best] / x.sum()))
        return langs, scores


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", where: Column | None = None, sample_docs: int = 600, sample_total: int = 60_000, min_count: int = 2, longest: int = 5, seed: int = 7) -> Model:
    """Learn from the rows of df with a language, of those that `where` admits.

    The sample holds rows whose id hashes below a language's share, so about sample_docs of each, or sample_total over the number of
    languages if that is less, whatever the size of the input: the bound makes the counts small enough for the driver.
    """
    labelled = df.filter(F.col(lang_col).isNotNull() & (F.col(lang_col) != "") & F.col(text_col).isNotNull())
    if where is not None:
        labelled = labelled.filter(where)
    sizes = labelled.groupBy(F.col(lang_col).alias("lang")).count().collect()
    langs = sorted(r["lang"] for r in sizes)
    if not langs:
        return Model([], {}, {})
    each = min(sample_docs, sample_total / len(langs))
    share = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], min(1.0, each / r["count"]))))
    chance = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col).cast("string")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.withColumn("__lang", F.col(lang_col)).filter(chance < F.coalesce(share[F.col("__lang")], F.lit(-1.0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def counted(lang: str, words: Counter) -> Iterator[pa.RecordBatch]:
            found: Counter = Counter()
            for w, k in words.items():
                found[0, w] += k
                for n in range(1, longest + 1):
                    for g in grams_of(w, n):
                        found[n, g] += k
            items = list(found.items())
            for at in range(0, len(items), 50_000):
                some = items[at : at + 50_000]
                columns = [pa.array([lang] * len(some)), pa.array([n for (n, _), _ in some], pa.int32()), pa.array([g for (_, g), _ in some]), pa.array([k for _, k in some], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "n", "g", "k"])

        # a language's words are counted once for many texts; they go out before they are too many to hold
        for batch in batches:
            for lang, text in zip(batch.column("__lang").to_pylist(), batch.column("__text"), strict=True):
                words = held.setdefault(lang, Counter())
                words.update(words_of(text.as_py()))
                if len(words) > 20_000:
                    yield from counted(lang, held.pop(lang))
        for lang, words in held.items():
            yield from counted(lang, words)

    counted = sample.select("__lang", F.col(text_col).alias("__text")).mapInArrow(run, "lang string, n int, g string, k long")
    counts = counted.groupBy("lang", "n", "g").agg(F.sum("k").alias("k")).filter(F.col("k") >= min_count)
    numbers = {lang: i for i, lang in enumerate(langs)}
    found = counts.toArrow()
    level = found.column("n").to_numpy()
    tables: dict[int, Table] = {}
    for n in range(longest + 1):
        some = found.take(np.flatnonzero(level == n))
        index: dict[str, int] = {}
        at = np.array([index.setdefault(g, len(index)) for g in some.column("g").to_pylist()], np.int64)
        column = np.array([numbers[x] for x in some.column("lang").to_pylist()], np.int64)
        rows = np.zeros((len(index), len(langs)))
        if len(index):
            rows[at, column] = some.column("k").to_numpy()
            rows = np.log((rows + 0.5) / (rows.sum(0) + 0.5 * len(index)))
        tables[n] = Table(index, rows.astype(np.float32))
    return Model(langs, tables.pop(0), {n: t for n, t in tables.items() if len(t)})


def identify(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, then lang_pred and score (0 to 1) of each whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        scorer = Scorer(shared.value)
        return scorer.predict

    return map_texts(df, df.columns if keep is None else keep, text_col, start, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def recognised(df: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of df whose language is found with a score of at least `least`."""
    own, names = neutral(df)
    found = identify(own, model, names[text_col])
    return restored(found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)), names)
