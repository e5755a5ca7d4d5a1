"""BPE encoding and decoding with a word vocabulary whose last parts carry a word-end mark.

Method: contiguous rank array. A short word holds its part boundaries and the merge ranks of adjacent parts in two arrays; the
least rank is found by a scan, its boundary is deleted and the two neighbouring ranks are looked up again. New words of one
length are merged together, a row of these arrays each. Words beyond SHORT symbols use a heap of pairs instead, as the scan is
quadratic; all three give the same parts.

Defined results: a null text encodes like an empty one (no ids, empty decoded text). Special tokens written in a text are
taken as those tokens, as the tokenizers library does. Long texts are encoded whole. Rows are independent of each other, so
repeated rows give repeated results and an empty table an empty result. Other columns are never read unless kept.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from copy import copy
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_texts

#: Words of more symbols are merged with a heap.
SHORT = 200
#: Encoded words a task remembers.
CACHE_WORDS = 100_000
#: Symbols of words that are merged at once.
BLOCK_SYMBOLS = 1 << 18
NONE = 1 << 60

# Letters, numbers and white space up to U+024F, as Unicode lists them.
_L = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_N = "0-9²³¹¼-¾"
_S = "\\t-\\r \u0085 "
_PLAIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
_BEYOND = re.compile("[^\u0000-ɏ]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class WordBpe:
    """A tokenizer file of the tokenizers library with byte-level BPE and word ends, read without the library's model."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.path = path
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t.encode() for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + end] for s in symbols]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {(vocab[a] << 20) | vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.inner_array, self.last_array, self.merged_array = (np.array(x, np.int64) for x in (self.inner, self.last, self.merged))
        order = sorted(self.ranks)
        self.pair_keys, self.pair_ranks = np.array(order, np.int64), np.array([self.ranks[k] for k in order], np.int64)
        self.special_words = {t: np.array([i], "<u4").tobytes() for t, i in self.special.items()}
        self.words = dict(self.special_words)

    def merge_short(self, ids: list[int]) -> list[int]:
        """Contiguous rank array: the part between boundaries i and i + 1 has ids[i], ranks[i] is that of parts i and i + 1."""
        rank, merged = self.ranks.get, self.merged
        bounds = list(range(len(ids) + 1))
        ranks = [rank((a << 20) | b, NONE) for a, b in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            i = ranks.index(least)
            del bounds[i + 1], ranks[i], ids[i + 1]
            ids[i] = merged[least]
            if i < len(ranks):
                ranks[i] = rank((ids[i] << 20) | ids[i + 1], NONE)
            if i:
                ranks[i - 1] = rank((ids[i - 1] << 20) | ids[i], NONE)
        assert len(bounds) == len(ids) + 1
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same merges in the same order, by a heap of (rank, place)."""
        n = len(ids)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        rank = self.ranks.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank((ids[i] << 20) | ids[i + 1], NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = self.merged[r], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := rank((ids[x] << 20) | ids[y], NONE)) != NONE:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """merge_short for words of one length at once: a row for each word, and a merge in every row at each step, so that all
        rows still at work have equally many parts. A row without a rank is done."""
        n = len(words[0])
        raw = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), n)
        ids = self.inner_array[raw]
        ids[:, -1] = self.last_array[raw[:, -1]]
        ranks = self.look_up(ids[:, :-1], ids[:, 1:])
        at = np.arange(len(words))
        out: list[bytes] = [b""] * len(words)
        while len(at):
            if ids.shape[1] > 1:
                place = ranks.argmin(1)
                least = ranks[np.arange(len(at)), place]
                done = least == len(self.merged)
            else:
                done = np.ones(len(at), bool)
            if done.any():
                ended, size = ids[done].astype("<u4").tobytes(), 4 * ids.shape[1]
                for k, word in enumerate(at[done].tolist()):
                    out[word] = ended[k * size : (k + 1) * size]
                if done.all():
                    break
                at, ids, ranks, place, least = at[~done], ids[~done], ranks[~done], place[~done], least[~done]
            rows, place = np.arange(len(at)), place[:, None]
            ids[rows, place[:, 0]] = self.merged_array[least]
            columns = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, columns + (columns > place), 1)
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= place), 1)
            for side in (place[:, 0] - 1, place[:, 0]):
                near = np.flatnonzero((side >= 0) & (side < ranks.shape[1]))
                i = side[near]
                ranks[near, i] = self.look_up(ids[near, i], ids[near, i + 1])
        return out

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of ids; the number of merges where there is none."""
        keys = (a.astype(np.int64) << 20) | b
        i = np.searchsorted(self.pair_keys, keys)
        i[i == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[i] == keys, self.pair_ranks[i], len(self.merged))

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "surrogatepass")
        inner = self.inner
        ids = [inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        return self.merge_short(ids) if len(ids) <= SHORT else self.merge_long(ids)

    @property
    def library(self):
        """The library's normalizer and pre-tokenizer, for scripts beyond the plain path's tables."""
        return _library(self.path)

    def fresh(self) -> WordBpe:
        """The same tables with a store of words of its own, which ends with the task that asks for it."""
        out = copy(self)
        out.words = dict(self.special_words)
        return out

    def split_words(self, text: str) -> list[str]:
        if not _BEYOND.search(text):
            low = text.lower() if text.isascii() else text.replace("Σ", "σ").lower()
            if not _BEYOND.search(low):
                return _PLAIN_WORDS.findall(low)
        tok = self.library
        low = tok.normalizer.normalize_str(text)
        return [_from_symbols(w) for w, _ in tok.pre_tokenizer.pre_tokenize_str(low)]

    def parts(self, text: str) -> list[str]:
        """Words, and special tokens in their places."""
        if self.split is None or not any(t in text for t in self.special):
            return self.split_words(text)
        return [w for k, piece in enumerate(self.split.split(text)) for w in ([piece] if k % 2 else self.split_words(piece))]

    def learn(self, words: set[str]) -> None:
        """Encode the words that the store lacks; where it would grow beyond CACHE_WORDS, only these words stay in it."""
        new = words.difference(self.words)
        if len(self.words) + len(new) > CACHE_WORDS:
            self.words = self.special_words | {w: self.words[w] for w in words.difference(new)}
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for w in new:
            raw = w.encode("utf-8", "surrogatepass")
            by_length.setdefault(len(raw), []).append((w, raw))
        for n, found in by_length.items():
            if n <= SHORT and len(found) > 3:
                for k in range(0, len(found), BLOCK_SYMBOLS // n + 1):
                    block = found[k : k + BLOCK_SYMBOLS // n + 1]
                    self.words.update(zip((w for w, _ in block), self.merge_many([raw for _, raw in block]), strict=True))
            else:
                self.words.update((w, np.array(self.encode_word(w), "<u4").tobytes()) for w, _ in found)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """For each text, its ids as little-endian unsigned 32-bit integers."""
        parts = [self.parts(t) for t in texts]
        self.learn(set().union(*parts))
        word = self.words.__getitem__
        return [b"".join(map(word, p)) for p in parts]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        """The tokens joined by spaces, in UTF-8: what the library gives for a file without a decoder."""
        return b" ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(1)
def _symbol_bytes() -> dict[str, int]:
    return {s: b for b, s in enumerate(byte_symbols())}


def _from_symbols(word: str) -> str:
    back = _symbol_bytes()
    return bytes(back[c] for c in word).decode("utf-8", "surrogatepass")


@lru_cache(2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


@lru_cache(2)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encode(df: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, then ids array<int>, the parts of each whole text. path: a tokenizer file that every executor has."""

    def start():
        bpe = load(path).fresh()
        return lambda texts: ([np.frombuffer(x, "<u4").astype("int32") for x in bpe.encode_all([t or "" for t in texts])],)

    return map_texts(df, df.columns if keep is None else keep, text_col, start, [T.StructField("ids", T.ArrayType(T.IntegerType()))])


def decode(df: DataFrame, path: str, ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, then decoded string, the tokens of ids joined by spaces (null ids: empty)."""

    def start():
        bpe = load(path)
        return lambda rows: ([bpe.decode(np.array(r if r is not None else [], "<u4").tobytes()).decode("utf-8", "replace") for r in rows],)

    return map_texts(df, [c for c in df.columns if c != ids_col] if keep is None else keep, ids_col, start, [T.StructField("decoded", T.StringType())])


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each text in one pass; id, n_tokens, and the SHA-256 of its ids and of its decoded text."""

    def start():
        bpe = load(path).fresh()

        def rows(texts):
            n, of_ids, of_text = [], [], []
            for ids in bpe.encode_all([t or "" for t in texts]):
                n.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            return n, of_ids, of_text

        return rows

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return map_texts(df, [id_col], text_col, start, fields)
