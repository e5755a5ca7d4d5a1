"""Quality rules by tokeniser fertility.

A public vocabulary with byte fallback measures each whole text: characters a token, share of byte-fallback tokens, and how even its
tokens are: their entropy in bits over the most that a text of that length can have (the log of its tokens, 10 bits at most). A text
is rejected where a measure leaves the band of its main script; the base rules (too few words, too many repeated three-word
windows) reject it as well.

Bands: the quartiles of each measure over all texts of a script that pass the base rules, widened by `fence` interquartile ranges,
and never wider than the fixed limits of the script. So a corpus sets its own bands, whatever its size; a script with few texts
gets wide ones. Measures are taken in one pass and stored; the bands are one row a script.

Each distinct word is encoded once a slice and remembered; a text's tokens are those of its words.

Defined results: a null or empty text has no words, zero counts, null measures, and fails the base rule on words. Lines are
compared exactly; a line without a word never counts. Measures of a row are independent of other rows, so repeated rows give
repeated results; bands are those of the table. A text without a token is rejected, one at the edge of a band is kept. An empty
table gives an empty result. Other columns are never read unless kept; one named like a made one gives way to it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, stored


@dataclass(frozen=True)
class Band:
    """What a text may have: characters a token from low to high, at most this share of byte tokens, at least this evenness."""

    chars_low: float
    chars_high: float
    bytes_high: float
    even_low: float


@dataclass(frozen=True)
class Rules:
    """fence: interquartile ranges beyond the quartiles; spreads: the least range of characters a token, byte share and evenness that
    counts; limits: the fixed limits by script, other: those of all further scripts."""

    min_words: int = 50
    max_repeat_percent: int = 50
    fence: float = 2.0
    spreads: tuple[float, float, float] = (0.1, 0.02, 0.02)
    limits: dict[str, Band] = field(default_factory=lambda: dict(LIMITS))
    other: Band = Band(0.2, 12.0, 0.95, 0.4)


# Limits for public 32k vocabularies with byte fallback.
LIMITS = {
    "latin": Band(1.3, 8.0, 0.15, 0.5),
    "cyrillic": Band(1.0, 8.0, 0.20, 0.5),
    "greek": Band(0.5, 6.0, 0.60, 0.45),
    "cjk": Band(0.3, 4.0, 0.75, 0.45),
    "arabic": Band(0.5, 6.0, 0.75, 0.45),
    "hebrew": Band(0.5, 6.0, 0.75, 0.45),
    "indic": Band(0.25, 6.0, 0.95, 0.4),
    "southeast": Band(0.25, 6.0, 0.95, 0.4),
}
# Script blocks beyond ASCII.
_SCRIPTS = {
    "latin": re.compile("[À-ɏḀ-ỿ]"),
    "cyrillic": re.compile("[Ѐ-ԯ]"),
    "greek": re.compile("[Ͱ-Ͽἀ-῿]"),
    "cjk": re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]"),
    "arabic": re.compile("[\u0600-\u06ff\u0750-\u077f\ufb50-\ufdff\ufe70-\ufeff]"),
    "hebrew": re.compile("[\u0590-\u05ff]"),
    "indic": re.compile("[\u0900-\u0dff]"),
    "southeast": re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff]"),
}
_BEYOND = re.compile("[^\u0000-ɏ]")
_ASCII = re.compile("[A-Za-z]")
_LETTERS = re.compile(r"[^\W\d_]")
_SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"
#: Words a task remembers.
CACHE_WORDS = 400_000
#: Entropy that even a long text needs no more of.
MOST_BITS = 10.0


def script_of(text: str) -> str:
    """The script of most letters; latin where there is none or a tie."""
    if text.isascii() or not _BEYOND.search(text):
        return "latin"
    found = {k: len(p.findall(text)) for k, p in _SCRIPTS.items()}
    found["latin"] += len(_ASCII.findall(text))
    found["other"] = len(_LETTERS.findall(text)) - sum(found.values())
    return max(found, key=lambda k: (found[k], k == "latin"))


class Fertility:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) or self.model.is_unknown(i) for i in range(self.model.get_piece_size())])
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        #: Word i has the tokens flat[ends[i] : ends[i + 1]].
        self.flat, self.ends = np.zeros(0, np.uint16), np.zeros(1, np.int64)

    def number(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """Numbers for the words of each text. They hold until the next call; encodes the words that the store lacks."""
        words = set().union(*texts)
        new = words.difference(self.index)
        if len(self.index) + len(new) > CACHE_WORDS:
            self.clear()
            new = words
        found, flat, ends = list(new), [self.flat], [self.ends]
        for k in range(0, len(found), 20_000):
            made = self.model.encode([w.decode("utf-8", "replace") for w in found[k : k + 20_000]], num_threads=1)
            flat.append(np.fromiter(chain.from_iterable(made), np.uint16))
            ends.append(ends[-1][-1] + np.cumsum(np.fromiter(map(len, made), np.int64, len(made))))
        self.index.update(zip(found, range(len(self.index), len(self.index) + len(found)), strict=True))
        self.flat, self.ends = np.concatenate(flat), np.concatenate(ends)
        at = self.index.__getitem__
        return [np.fromiter(map(at, t), np.int64, len(t)) for t in texts]

    def measure(self, numbers: np.ndarray, n_chars: int) -> tuple[int, float | None, float | None, float | None]:
        """Tokens, characters a token, share of byte tokens, entropy in bits."""
        words, times = np.unique(numbers, return_counts=True)
        start, size = self.ends[words], self.ends[words + 1] - self.ends[words]
        where = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
        n = np.bincount(self.flat[where], np.repeat(times, size)) if len(where) else np.zeros(0)
        used = np.flatnonzero(n)
        total = n.sum()
        if not total:
            return 0, None, None, None
        p = n[used] / total
        return int(total), n_chars / total, float(p[self.is_byte[used]].sum()), float(-(p * np.log2(p)).sum())


@lru_cache(2)
def load(path: str) -> Fertility:
    return Fertility(path)


def repeated_words(numbers: np.ndarray) -> int:
    """Words that stand in a three-word window found twice or more. numbers: equal for equal words."""
    n = len(numbers)
    if n < 4:
        return 0
    if numbers.max() >= 1 << 21:
        numbers = np.unique(numbers, return_inverse=True)[1]
    if numbers.max() < 1 << 21:
        keys = (numbers[:-2] << 42) | (numbers[1:-1] << 21) | numbers[2:]
    else:
        keys = np.unique(np.stack([numbers[:-2], numbers[1:-1], numbers[2:]], 1), axis=0, return_inverse=True)[1].ravel()
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    again = np.isin(keys, twice)
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k : n - 2 + k] |= again
    return int(inside.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def measured(df: DataFrame, path: str, rules: Rules, text_col: str, keep: list[str]) -> DataFrame:
    """The kept columns, then counts, measures and script of each whole text."""

    def start():
        gauge = load(path)

        def rows(texts):
            texts = [t or "" for t in texts]
            split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
            out = []
            for text, words in zip(texts, gauge.number(split), strict=True):
                n = len(words)
                n_chars = len(text) - sum(map(text.count, _BLANKS))
                repeat = repeated_words(words)
                failed = n < rules.min_words or 100 * repeat > rules.max_repeat_percent * n
                out.append((n, n_chars, sum(map(text.count, _SYMBOLS)), duplicate_lines(text), repeat, failed, script_of(text), *gauge.measure(words, n_chars)))
            return list(zip(*out)) if out else [[] for _ in FIELDS]

        return rows

    return map_texts(df, keep, text_col, start, FIELDS)


def evenness() -> Column:
    most = F.least(F.log2(F.col("n_tokens").cast("double")), F.lit(MOST_BITS))
    return F.when(F.col("n_tokens") > 1, F.col("token_entropy") / most)


def bands(rows: DataFrame, rules: Rules) -> DataFrame:
    """One row for each script of rows: the bands of its measures."""
    sound = rows.filter(~F.col("base_failed") & F.col("chars_per_token").isNotNull()).withColumn("evenness", evenness())
    quartiles = lambda c: F.percentile_approx(c, [0.25, 0.75], 10_000)
    found = sound.groupBy("script").agg(quartiles("chars_per_token").alias("c"), quartiles("byte_share").alias("b"), quartiles("evenness").alias("e"))
    limit = lambda name: F.coalesce(*(F.when(F.col("script") == k, F.lit(float(getattr(v, name)))) for k, v in rules.limits.items()), F.lit(float(getattr(rules.other, name))))
    reach = [rules.fence * F.greatest(F.get(k, F.lit(1)) - F.get(k, F.lit(0)), F.lit(least)) for k, least in zip("cbe", rules.spreads, strict=True)]
    return found.select(
        F.col("script").alias("__script"),
        F.greatest(limit("chars_low"), F.get("c", F.lit(0)) - reach[0]).alias("chars_low"),
        F.least(limit("chars_high"), F.get("c", F.lit(1)) + reach[0]).alias("chars_high"),
        F.least(limit("bytes_high"), F.get("b", F.lit(1)) + reach[1]).alias("bytes_high"),
        F.greatest(limit("even_low"), F.get("e", F.lit(0)) - reach[2]).alias("even_low"),
    )


def quality(df: DataFrame, path: str, rules: Rules | None = None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, then counts, measures, script and verdict of each whole text. path: a vocabulary file that every executor has."""
    rules = rules or Rules()
    own = [k for k in (df.columns if keep is None else keep) if k not in {f.name for f in FIELDS} | {"kept"}]
    held = {k: f"__k{i}" for i, k in enumerate(own)}
    rows = df.select(*(F.col(f"`{k}`").alias(h) for k, h in held.items()), F.col(f"`{text_col}`").alias("__text"))
    rows = stored(measured(rows, path, rules, "__text", list(held.values())))
    both = rows.join(bands(rows, rules), rows["script"] == F.col("__script"), "left")
    inside = F.col("chars_per_token").between(F.col("chars_low"), F.col("chars_high")) & (F.col("byte_share") <= F.col("bytes_high")) & (F.coalesce(evenness(), F.lit(1.0)) >= F.col("even_low"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return both.select(*(F.col(h).alias(k) for k, h in held.items()), *(f.name for f in FIELDS[:6]), kept.alias("kept"), *(f.name for f in FIELDS[6:]))


_long, _double, _bool, _string = T.LongType(), T.DoubleType(), T.BooleanType(), T.StringType()
FIELDS = [
    T.StructField(name, kind)
    for name, kind in (
        ("n_words", _long), ("word_chars", _long), ("n_symbols", _long), ("n_dup_lines", _long), ("n_repeat_words", _long),
        ("base_failed", _bool), ("script", _string), ("n_tokens", _long), ("chars_per_token", _double),
        ("byte_share", _double), ("token_entropy", _double),
    )
]
