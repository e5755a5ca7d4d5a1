"""The text operators against brute force, on whole small tables with odd rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from caloris.llm import bpe, fertility, langid, licenses, lm, mixer, mixing, pii, secret_scan, simhash, vectors
from caloris.llm.components import Forest, components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(df, id_col="doc_id"):
    return [(r[id_col], r["text"] or "") for r in df.select(id_col, "text").collect()]


def paired(result, documents):
    """Rows of a result with their texts: ids of these tables tell texts apart, as equal ids have equal texts."""
    by_id = dict(texts(documents))
    return [(r, by_id[r.doc_id]) for r in result.collect()]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def empty_and_wide(documents, operator):
    """An operator stands an empty table, and columns named like those it makes."""
    assert operator(documents.limit(0)).count() == 0
    wide = documents
    for name in ("score", "lang_pred", "size", "simhash", "spans", "base", "clean", "times", "ids", "kept", "licenses", "n_words", "chunk", "c0", "component_id"):
        wide = wide.withColumn(name, F.lit("x"))
    return operator(wide.limit(30))


def test_slices_hold_rows_and_bytes(spark, monkeypatch):
    from pyspark.sql import types as T

    from caloris.llm import common

    monkeypatch.setattr(common, "SLICE_ROWS", 3)
    monkeypatch.setattr(common, "SLICE_BYTES", 10)
    rows = [(i, t) for i, t in enumerate(["aaaa", "bbbb", None, "c" * 50, "", "dd", "éé", "e", "f", "g"])]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = common.map_texts(df, ["doc_id"], "text", lambda: lambda texts: ([len(texts)] * len(texts),), [T.StructField("n", T.IntegerType())]).collect()
    assert [r.doc_id for r in out] == list(range(10)) and max(r.n for r in out) <= 3 and out[3].n == 1


# --- 1 language identification


def test_language(spark, documents):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.fit(documents, where=~F.coalesce(held_out, F.lit(False)))
    out = langid.identify(documents, model, keep=["doc_id", "lang"]).collect()
    assert len(out) == documents.count()
    fair = [r for r in out if r.doc_id is not None and r.doc_id < 9000 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(r.lang == r.lang_pred for r in fair) >= 0.95 * len(fair) > 10
    odd = {r.doc_id: r for r in out}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (9001, 9002, 9003, 9006))
    assert all(0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in langid.identify(documents, langid.fit(documents.limit(0))).collect()} == {"und"}
    kept = empty_and_wide(documents, lambda d: langid.recognised(d, model))
    assert "lang_pred" in kept.columns and kept.first().lang_pred == "x"


def test_language_equals_brute_force(spark, documents):
    model = langid.fit(documents)
    for r, text in paired(langid.identify(documents, model, keep=["doc_id"]), documents):
        words = [w for w in re.findall(r"[^\W\d_]+", text.lower())]
        if not words or len(text) > 20_000:
            continue
        total = np.zeros(len(model.langs))
        for w in words:
            if w in model.words:
                total += model.words[w]
                continue
            for n in (5, 4, 3, 2, 1):
                marked = w if n == 1 else f"\x02{w}\x03"
                known = [model.grams[n][marked[i : i + n]] for i in range(len(marked) - n + 1) if marked[i : i + n] in model.grams.get(n, {})]
                if known:
                    total += np.mean(known, 0)
                    break
        x = np.exp((total - total.max()) / math.sqrt(len(words)))
        assert r.lang_pred == model.langs[int(total.argmax())] and math.isclose(r.score, x.max() / x.sum(), rel_tol=1e-9)


def test_every_language_is_learnt(spark):
    rows = [(k, f"word{'abcdefghij'[k % 10]}{'abcdefghijklmnopqrstuvwxyz'[k // 10]} text text", f"l{k}") for k in range(230)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), min_count=1)
    assert len(model.langs) == 230


def test_backoff_takes_the_longest_known_length():
    v = lambda *x: np.array(x)
    model = langid.Model(["a", "b"], {"known": v(-1.0, -2.0)}, {1: {"k": v(-5.0, -5.0)}, 3: {"\x02xy": v(-3.0, -4.0)}})
    assert model.word("known").tolist() == [-1, -2] and model.word("xyz").tolist() == [-3, -4]
    assert model.word("kk").tolist() == [-5, -5] and model.word("zz").tolist() == [0, 0]


# --- 2 near-duplicate vectors


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(25):
            base = rng.normal(size=24)
            for _ in range(int(rng.integers(1, 9))):
                rows.append((n, [float(x) for x in base + rng.normal(size=24) * rng.choice([0.0, 0.05, 0.25])], label))
                n += 1
    rows += [(n, None, 0), (n + 1, [0.0] * 24, 0), (n + 2, [math.nan] + [1.0] * 23, 0), (n + 3, [None] + [1.0] * 23, 0), (n + 4, [1.0, 2.0], 0), (n + 5, [], 0), (None, [1.0] * 24, 0), rows[0], rows[0]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    sound = [i for i, (k, v, label) in enumerate(rows) if k is not None and label is not None and v and None not in v and not any(map(math.isnan, v)) and any(v)]
    links, forest = collections.Counter(), {i: rows[i][0] for i in sound}
    for a in sound:
        for b in sound:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1]), np.array(rows[b][1])
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.93:
                    links[a] += 1
                    links[b] += 1
                    low, high = sorted((forest[a], forest[b]))
                    forest = {i: low if c == high else c for i, c in forest.items()}
    want = sorted((rows[i][0] if rows[i][0] is not None else -1, links[i], forest.get(i, rows[i][0]) if rows[i][0] is not None else None) for i in range(len(rows)))
    got = sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id) for r in vectors.near_duplicates(df).collect())
    assert got == want
    assert vectors.near_duplicates(df.limit(0)).count() == 0
    wide = df.withColumns({k: F.lit("x") for k in ("id", "n", "links", "component", "k1", "t", "bucket", "low", "kept")})
    assert sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id) for r in vectors.near_duplicates(wide).collect()) == want


def test_large_buckets_are_cut(spark, monkeypatch):
    monkeypatch.setattr("caloris.llm.blocks.dealt.__defaults__", (16,))
    rng = np.random.default_rng(4)
    base = rng.normal(size=16)
    df = spark.createDataFrame([(i, [float(x) for x in base + rng.normal(size=16) * 0.03], 1) for i in range(120)], "vec_id long, embedding array<double>, label int")
    out = vectors.near_duplicates(df).collect()
    assert {r.n_links for r in out} == {119} and {r.component_id for r in out} == {0} and sum(r.kept for r in out) == 1


@pytest.mark.parametrize("dimensions,n,least", [(64, 10**5, 0.997), (384, 10**5, 0.99), (768, 10**5, 0.99), (64, 10**9, 0.99)])
def test_vectors_meet_the_stated_recall(dimensions, n, least):
    """Pairs at the least cosine itself meet in a table."""
    hashing, rng, tried = vectors.Hashing.of(n, dimensions), np.random.default_rng(dimensions), 1500
    a = vectors.unit(rng.normal(size=(tried, dimensions)))
    other = rng.normal(size=(tried, dimensions))
    other = vectors.unit(other - np.einsum("ij,ij->i", a, other)[:, None] * a)
    b = 0.93 * a + math.sqrt(1 - 0.93**2) * other
    t, _ = vectors.first_meeting(vectors.buckets(a, hashing), vectors.buckets(b, hashing))
    assert (t < hashing.tables).mean() >= least


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(3, 16))
    assert np.allclose(vectors.hadamard(vectors.hadamard(x)), x)


# --- 3 secrets

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def test_secrets(spark, documents):
    for r, text in paired(secret_scan.digests(documents), documents):
        want = [(m.start(), 0, m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
        want += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        want = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(want))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
    out = empty_and_wide(documents, secret_scan.redact)
    assert out.count() == 30 and "spans" in out.columns


def test_random_tokens_are_told_from_text(spark):
    secret = "j37HyVaQXekW9LctXb03rEMU64yTY6Bz"
    rows = [(1, f"😀 x {secret} y"), (2, "some/path/to/python3/site-packages/module"), (3, "abcdefghijklmnopqrstuvwxyz0123456789"), (4, "the-quick-brown-fox-jumps-over-2024-edition"), (5, f"token={secret}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secret_scan.digests(df).collect()}
    assert got == {1: "random:4:36", 2: "", 3: "", 4: "", 5: "assign:0:38"}
    clean = {r.doc_id: r.text for r in secret_scan.redact(df).collect()}
    assert clean[1] == "😀 x [SECRET:random] y" and clean[5] == "[SECRET:assign]" and clean[2] == rows[1][1]


# --- 4 language-model scores


def test_base_scores_equal_brute_force(spark, documents):
    training = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    counts = collections.Counter()
    split = {i: [*WORD.findall(lower(t)), None] for i, t in texts(documents)}
    for i, _ in texts(documents):
        if i is not None and zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(split[i])
    n, v = sum(counts.values()), len(counts)
    out = lm.score(documents, training).collect()
    assert len(out) == documents.count()
    for r in out:
        words = split[r.doc_id]
        want = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert math.isclose(r.base_score, want, rel_tol=1e-9, abs_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert r.score < 0 and math.isfinite(r.bits_per_byte)
    assert lm.score(documents.limit(0), training).count() == 0


def test_scores_in_chunks_and_clashing_columns(spark, documents, monkeypatch):
    """Chunks, vocabulary pieces and other columns change no score; the whole score is that of the mixer over the training texts."""
    training = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    wide = documents.withColumns({k: F.lit("x") for k in ("chunk", "ids", "training", "texts", "words", "id", "score", "n")})
    known = {(r.doc_id, round(r.base_score, 6), round(r.score, 4), r.n_bytes) for r in lm.score(wide, training).collect()}
    monkeypatch.setattr(lm, "CHUNK", 20_000)
    monkeypatch.setattr(lm, "PIECE_BYTES", 50_000)
    assert {(r.doc_id, round(r.base_score, 6), round(r.score, 4), r.n_bytes) for r in lm.score(documents.repartition(3), training).collect()} == known
    rows = [(i, (t or "").encode().lower()) for i, t in texts(documents)]
    learnt = [t for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    form = mixer.shape(np.bincount(np.frombuffer(b"".join(learnt), np.uint8), minlength=256), sum(map(len, learnt)))
    table = predictor(form, learnt)
    some = {i: t for i, t in rows[:20] + rows[-3:]}
    want = mixer.code(table, form, list(some.values())) * -math.log10(2)
    got = {i: s for i, _, s, _ in known}
    assert np.allclose([got[i] for i in some], want, rtol=1e-4)


def predictor(form, learnt):
    counts = np.zeros(2 * form.total, np.int64)
    mixer.count(counts, form, learnt)
    return mixer.predictions(counts)


def brute_units(form, text):
    """For each piece of a text the list of (code, node base, hashes) of its units, one step at a time."""
    m32, pieces, start = (1 << 32) - 1, [], 0
    for i in range(len(text) + 1):
        if i % mixer.PIECE == 0 and (i < len(text) or not i):
            pieces.append([])
            start = i
        elif not (chr(text[i - 1]).isalnum() or text[i - 1] >= 128):
            start = i
        c1, c2, c3 = (text[i - k] if i >= k else 0 for k in (1, 2, 3))
        word = sum((text[q] + 1) * pow(mixer._ODD, q - start, 1 << 32) for q in range(start, i)) & m32 ^ (i - start) << 7
        hashes = (c1, c1 | c2 << 8, c1 | c2 << 8 | c3 << 16, word * 0x85EBCA6B & m32)
        symbol = text[i] if i < len(text) else form.end
        if i < len(text) and symbol in form.common:
            pieces[-1].append((form.common.index(symbol), 0, hashes))
        else:
            high, low = divmod(symbol, 16)
            pieces[-1] += [(31, 0, hashes), (high, 32, hashes), (low, 64 + 32 * high, hashes)]
    return pieces


def brute_slot(form, k, context, node):
    if not k:
        return context << 10 | node
    return form.starts[k] + (((context + node * 0x9E3779B1) * 0x85EBCA6B & 0xFFFFFFFF) >> (32 - form.bits[k - 1]))


def brute_bits(table, form, text):
    """The mixer, a bit at a time."""
    total, n, ends = 0.0, 0, {}
    for piece in brute_units(form, text):
        for at in range(0, len(piece), mixer.BLOCK):
            level = int(math.log2(n)) + 1 if n else 0
            states = ends.get(level - 1)
            first = mixer.start_state(1)
            w, maps = (np.mean(x, 0) for x in zip(*states)) if states else (first.weights[:, :, 0].astype(float), first.maps[:, 0].astype(float))
            w, maps = w.copy(), maps.copy()
            for code, base, hashes in piece[at : at + mixer.BLOCK]:
                for j in range(5):
                    node, y = base + (1 << j | code >> 5 - j), code >> 4 - j & 1
                    s = np.array([table[brute_slot(form, k, hashes[k], node)] for k in range(4)], float) / mixer.SCALE
                    if base and not j:
                        s[:] = mixer.SURE / mixer.SCALE
                    odds = math.exp(-(w[j] @ s))
                    p, cell = 1 / (1 + odds), (math.frexp(odds)[1] - 1 + 127) % mixer.MAP_CELLS
                    total -= math.log2(max(1e-7, abs((p + maps[j, cell]) / 2 + y - 1)))
                    w[j] += mixer.RATE * (y - p) * s
                    maps[j, cell] += mixer.MAP_RATE * (y - maps[j, cell])
            ends.setdefault(level, []).append((w, maps))
            n += 1
    return total


def test_mixer_equals_brute_force(monkeypatch):
    rng = np.random.default_rng(6)
    words = ["the", "river", "in", "valley", "Zoë", "42", "\n", "sky-blue", "über"]
    some = [" ".join(rng.choice(words, int(n))).encode().lower() for n in rng.integers(0, 40, 6)] + [b"", b"\0\0", bytes(range(256)), b"ab" * 300]
    form = mixer.shape(np.bincount(np.frombuffer(b"".join(some), np.uint8), minlength=256), 4000)
    table = predictor(form, some[:8])
    whole = mixer.code(table, form, some)
    assert np.allclose(whole, [brute_bits(table, form, t) for t in some], rtol=1e-3)
    monkeypatch.setattr(mixer, "BLOCK", 32)
    assert np.allclose(mixer.code(table, form, some), [brute_bits(table, form, t) for t in some], rtol=1e-3)
    for name, value in (("PIECE", 100), ("GROUP", 200), ("LANES", 3), ("SLICE", 150)):
        monkeypatch.setattr(mixer, name, value)
    table = predictor(form, some[:8])
    assert np.allclose(mixer.code(table, form, some), [brute_bits(table, form, t) for t in some], rtol=1e-3)


def test_counts_equal_brute_force():
    some = [b"abab abba \xc3\xa9", b"", b"aab b", bytes(range(256))]
    form = mixer.shape(np.bincount(np.frombuffer(b"".join(some), np.uint8), minlength=256), 100)
    counts, want = np.zeros(2 * form.total, np.int64), np.zeros(2 * form.total, np.int64)
    mixer.count(counts, form, some)
    for t in some:
        for piece in brute_units(form, t):
            for code, base, hashes in piece:
                for j in range(5):
                    for k in range(4):
                        want[2 * brute_slot(form, k, hashes[k], base + (1 << j | code >> 5 - j)) + (code >> 4 - j & 1)] += 1
    assert (counts == want).all()


def test_mixing_is_a_probability():
    """Over all texts of one byte at most, the probabilities stay within one in total, whatever the model has seen."""
    form = mixer.shape(np.bincount(list(b"ab  "), minlength=256), 100)
    table = predictor(form, [b"abab abba", b"aab b"] * 5)
    bits = mixer.code(table, form, [bytes([b]) for b in range(256)] + [b""])
    assert 0 < (2.0**-bits).sum() <= 1.0 + 1e-6


def test_tables_grow_with_the_corpus():
    n = np.bincount(list(b"abc"), minlength=256)
    sizes = [mixer.shape(n, int(x)).total for x in (5e8, 5e9, 5e10, 1e14)]
    assert sizes == sorted(set(sizes)) and sizes[-1] < 2e8


def test_a_learnt_text_costs_less():
    known = b"the weather in the valley is fine today and the river is low " * 3
    form = mixer.shape(np.bincount(list(known), minlength=256), 4000)
    bits = mixer.code(predictor(form, [known] * 20), form, [known, bytes(np.random.default_rng(1).integers(1, 256, len(known), dtype=np.uint8))])
    assert bits[0] < 0.3 * bits[1]


# --- 5 BPE


def test_bpe_equals_the_library(spark, documents):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    for r, text in paired(bpe.digests(documents, path), documents):
        ids = tok.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    made = bpe.encode(documents.limit(5), path, keep=["doc_id"])
    assert [len(r.decoded) > 0 for r in bpe.decode(made, path).collect()] == [True] * 5
    assert empty_and_wide(documents, lambda d: bpe.encode(d, path)).count() == 30


def test_bpe_workers_give_their_words_back(spark, documents):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    assert bpe.encode(documents, path, keep=["doc_id"]).count() == documents.count()

    def held(batches):
        for batch in batches:
            b = bpe.load(path)
            yield pa.RecordBatch.from_arrays([pa.array([len(b.words) - len(b.special_words)] * batch.num_rows, pa.int64())], names=["n"])

    assert {r.n for r in spark.range(64).mapInArrow(held, "n long").collect()} == {0}


def test_bpe_keeps_known_words_when_its_store_is_full(monkeypatch):
    import public_tokenizers

    b = bpe.load(public_tokenizers.path("word_bpe_49k.json")).fresh()
    texts = ["alpha beta gamma", "beta delta epsilon", "alpha zeta eta theta beta"]
    wanted = [b.encode(t) for t in texts]
    monkeypatch.setattr(bpe, "CACHE_WORDS", len(b.special_words) + 5)
    small = b.fresh()
    assert [small.encode(t) for t in texts] == wanted
    learnt = []
    monkeypatch.setattr(bpe.WordBpe, "merge_many", lambda self, words: learnt.extend(words) or [b""] * len(words))
    monkeypatch.setattr(bpe.WordBpe, "encode_word", lambda self, w: learnt.append(w.encode()) or [0])
    small.encode("alpha iota")
    assert learnt == [b"iota"] and small.words["alpha"] == b.words["alpha"]


@pytest.mark.parametrize("text", ["Hello   world's <|endoftext|> it'll", "Σας ΣΑΣ Ὀδυσσεύς", "日本語 ①②", "İstanbul ȺȾ ǅ", "\x1c x\x85y\xa0z", "été ﬁ", "x" * 3000, "ab" * 300 + " zz", "😀👨‍👩‍👧", "<|endoftext|", "\x00\x01", " "])
def test_odd_texts(text):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    assert np.frombuffer(bpe.load(path).encode(text), "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_three_ways_of_merging_agree():
    b = bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 12):
        words = ["".join(rng.choice(list("aabcdehinorst"), n)) for _ in range(50)]
        rows = b.merge_many([w.encode() for w in words])
        for w, row in zip(words, rows):
            ids = [b.inner[c] for c in w.encode()]
            ids[-1] = b.last[w.encode()[-1]]
            assert b.merge_short(list(ids)) == b.merge_long(list(ids)) == np.frombuffer(row, "<u4").tolist()


# --- 6 personal data


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return (sum(d[0::2]) + sum(sum(divmod(2 * c, 10)) for c in d[1::2])) % 10 == 0


def personal(t):
    digits = lambda x: re.sub("[^0-9]", "", x)
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


def test_personal_data(spark, documents):
    odd = ["😀a@b.c_d@e.f x@y@z.w .@a.b", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.0255", "4111 1111 1111 1111 4111-1111-1111-1112 1-2-3", "+1 (404) 555-9194 +123 +1-2-3-4-5-6-7-8-9-0", "1 2 3 " * 5000, "1" * 5000]
    both = documents.select("doc_id", "text").union(spark.createDataFrame([(9100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    for r, text in paired(pii.digests(both), both):
        want = ",".join(f"{k}:{a}:{b}" for a, _, b, k in personal(text))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), text[:80]
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        assert want or not r.spans
    assert empty_and_wide(documents, pii.sanitise).count() == 30


def test_telling_terms(spark):
    rows = [(i, f"{'about ' * i}zorbulon asks joe@mail.example.com about it {i}") for i in range(6)]
    rows += [(100 + i, f"someone asks p{i}@mail.example.com about it {i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: {s["match"] for s in r.spans if s["kind"] == "term"} for r in pii.scan(df).collect()}
    assert all(got[i] == {"zorbulon"} for i in range(6)) and not any(got[100 + i] for i in range(30))
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[0] == "xxxxxxxx asks [EMAIL] about it 0"
    same = spark.createDataFrame([(i, rows[0][1]) for i in range(6)], "doc_id long, text string")
    assert all(all(s["kind"] != "term" for s in r.spans) for r in pii.scan(same).collect())  # copies are one context


def brute_terms(rows, limits):
    """For each text the words that tell an entity that it holds, by PMI over contexts of whole words."""
    contexts, held = set(), {}
    for i, text in rows:
        base = personal(text)
        words = [(m.start(), m.end(), re.sub(r"^[\W_]+|[\W_]+$", "", m[0]).lower()) for m in WORD.finditer(text) if all(m.end() <= a or b <= m.start() for a, _, b, _ in base)]
        held[i] = (words, {f"{k}:{text[a:b]}" for a, _, b, k in base})
        for a, _, b, k in base:
            near = [w for w in words if w[1] <= a][-limits.words :] + [w for w in words if w[0] >= b][: limits.words]
            contexts.add((f"{k}:{text[a:b]}", tuple(w[2] for w in near if len(w[2]) >= limits.shortest and re.search(r"[^\W\d_]", w[2]))))
    n_e = collections.Counter(e for e, _ in contexts)
    n_t = collections.Counter(t for _, terms in contexts for t in set(terms))
    n_et = collections.Counter((e, t) for e, terms in contexts for t in set(terms))
    telling = {k for k, n in n_et.items() if n >= limits.support and n_e[k[0]] < len(contexts) and math.log2(n * len(contexts) / (n_e[k[0]] * n_t[k[1]])) >= -limits.disclosure * math.log2(n_e[k[0]] / len(contexts)) - 1e-12}
    return {i: sorted((a, b) for a, b, t in words if any((e, t) in telling for e in entities)) for i, (words, entities) in held.items()}


def test_terms_equal_brute_force(spark, documents):
    long = "w" * 150
    rows = [(20_000 + i, f"{'filler ' * (i % 3)}{long} zorbulon, joe@mail.example.com {long} said {'more ' * 9} Zorbulon again {i}") for i in range(8)]
    rows += [(20_100 + i, f"anyone at 10.0.0.{i} {long} said zorb {i}") for i in range(20)] + [(20_200, "a@b.c d@e.f 1.2.3.4 " * 40)]
    both = documents.filter(F.col("doc_id").isNotNull()).select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    whole = [(i, t) for i, t in texts(both)]
    want = brute_terms(whole, pii.Disclosure())
    assert any(want[i] for i in range(20_000, 20_008))
    got = {r.doc_id: sorted((s["start"], s["end"]) for s in r.spans if s["kind"] == "term") for r in pii.scan(both, keep=["doc_id"]).collect()}
    assert got == want
    for i, t in whole:  # no span begins or ends within a word
        assert all((not a or t[a - 1].isspace()) and (b == len(t) or t[b].isspace()) for a, b in got[i])


def test_spans_of_long_texts(spark):
    """Running sums and maxima over several levels of blocks, and spans of two kinds held against each other."""
    rng = np.random.default_rng(9)
    parts = ["".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"), 32)) if k % 2 else f"token=abc{k:07d}" for k in range(9000)]
    text = " ".join(parts)
    r = secret_scan.digests(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    want = ",".join(f"assign:{m.start()}:{m.end()}" for m in _ASSIGN.finditer(text))
    assert r.n_assign == 4500 and r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    starts = {f"{len(' '.join(parts[:k])) + 1}" for k in range(1, 400, 2)}
    found = [s.split(":") for s in r.spans.split(",") if s.startswith("random")]
    assert len(found) > 3500 and all(int(b) - int(a) == 32 for _, a, b in found) and sum(a in starts for _, a, _ in found) > 150
    clean = secret_scan.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text
    assert clean.count("[SECRET:assign]") == 4500 and clean.count("[SECRET:random]") == len(found)


# --- 7 quality


def test_quality(spark, documents):
    path = public_tokenizers.path("piece_bpe_32k.model")
    for r, text in paired(fertility.quality(documents, path), documents):
        words = WORD.findall(text)
        grams = list(zip(words, words[1:], words[2:]))
        n_of, inside = collections.Counter(grams), set()
        for i, g in enumerate(grams):
            if n_of[g] > 1:
                inside |= {i, i + 1, i + 2}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(words), sum(map(len, words)), len(inside), dup)
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert r.base_failed == (len(words) < 50 or 100 * len(inside) > 50 * len(words)) and not (r.base_failed and r.kept)
    assert empty_and_wide(documents, lambda d: fertility.quality(d, path)).count() == 30


def test_verdicts_equal_brute_force(spark, documents):
    """Bands from quartiles by hand; gibberish and broken encodings leave them, plain texts don't."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    rng = np.random.default_rng(7)
    word = lambda letters: "".join(rng.choice(list(letters), int(rng.integers(3, 9))))
    odd = [(30_000 + i, " ".join(word("Ãâ€œ™ð¡¿½") for _ in range(120))) for i in range(5)]
    both = documents.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    rows = fertility.quality(both, path).collect()
    even = lambda r: r.token_entropy / min(math.log2(r.n_tokens), 10) if r.n_tokens > 1 else 1.0
    for script in {r.script for r in rows}:
        sound = [r for r in rows if r.script == script and not r.base_failed and r.chars_per_token is not None]
        if not sound:
            continue
        limit, n = fertility.LIMITS.get(script, fertility.Rules().other), len(sound)
        quartiles = lambda f: [sorted(map(f, sound))[max(0, math.ceil(q * n) - 1)] for q in (0.25, 0.75)]  # noqa: B023, E731
        c, b, e = (quartiles(f) for f in (lambda r: r.chars_per_token, lambda r: r.byte_share, even))
        wide = lambda q, least: 2.0 * max(q[1] - q[0], least)
        low, high = max(limit.chars_low, c[0] - wide(c, 0.1)), min(limit.chars_high, c[1] + wide(c, 0.1))
        most, least = min(limit.bytes_high, b[1] + wide(b, 0.02)), max(limit.even_low, e[0] - wide(e, 0.02))
        for r in sound:
            assert r.kept == (low <= r.chars_per_token <= high and r.byte_share <= most and even(r) >= least)
    plain = [r for r in rows if not r.base_failed and r.doc_id is not None and r.doc_id < 9000]
    assert sum(r.kept for r in plain) >= 0.99 * len(plain) and not any(r.kept for r in rows if (r.doc_id or 0) >= 30_000)


def test_bands():
    b = fertility.load(public_tokenizers.path("piece_bpe_32k.model"))
    words = "good words of a plain text".encode().split()
    n, chars, share, entropy = b.measure(b.number([words])[0], sum(map(len, words)))
    assert n >= 6 and share == 0 and entropy > 2 and chars > 2
    odd = ["ᚠᛇᚻ".encode()] * 30
    assert b.measure(b.number([odd])[0], 90)[2] > 0.5
    assert fertility.script_of("Привет мир, how") == "cyrillic" and fertility.script_of("日本語") == "cjk" and fertility.script_of("été") == "latin" and fertility.script_of("ᚠᛇᚻ") == "other"


# --- 8 SimHash


def brute_print(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(prints):
    """prints: (id, fingerprint); the smallest id of each one's component."""
    order = sorted(range(len(prints)), key=lambda i: prints[i][0])
    f = np.array([prints[i][1] for i in order], np.uint64)
    a, b = np.nonzero(np.triu(np.bitwise_count(f[:, None] ^ f[None, :]) <= 4, 1))
    forest = Forest(len(f))
    forest.link(a, b)
    return {prints[order[i]][0]: prints[order[k]][0] for i, k in enumerate(forest.label.tolist())}


def test_simhash_equals_brute_force(spark, documents):
    prints = simhash.fingerprints(documents, keep=["doc_id"]).cache()
    for r, text in paired(prints, documents):
        assert r.simhash % (1 << 64) == brute_print(text)
    want = brute_classes([(r.doc_id, r.simhash % (1 << 64)) for r in prints.collect() if r.doc_id is not None])
    out = simhash.near_duplicates(prints).collect()
    assert len(out) == documents.count()
    assert all(r.component_id == want.get(r.doc_id) for r in out)


def test_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr("caloris.llm.blocks.dealt.__defaults__", (16,))
    rng = np.random.default_rng(8)
    prints, centre = [], [int(x) for x in rng.integers(0, 1 << 63, 30)] + [12345] * 12
    for c in centre:
        for _ in range(int(rng.integers(1, 12))):
            flips = rng.choice(64, int(rng.integers(0, 8)), replace=False)
            prints.append((len(prints), c ^ int(sum(1 << int(k) for k in flips))))
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints]
    got = simhash.near_duplicates(spark.createDataFrame(signed, "doc_id long, simhash long")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_classes(prints)


def test_dedup_keeps_one_of_each(spark, documents):
    whole = documents.withColumn("simhash", F.lit("given"))
    out = simhash.dedup(whole)
    assert out.columns == whole.columns and {r.simhash for r in out.select("simhash").distinct().collect()} == {"given"}
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    prints = simhash.fingerprints(documents, keep=["doc_id"])
    want = {r.component_id for r in simhash.near_duplicates(prints).collect() if r.component_id is not None}
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 2
    assert simhash.dedup(documents.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100 + i % 7, 100) for i in range(1, 7)] + [(500, 500), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(7)) and got[500] == 500 and got[201] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 9 mixing


def fill(sizes, weights, cap):
    done, total = {}, sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in done]
        left, weight = total - sum(done.values()), sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / weight > cap * sizes[s]]
        if not over:
            return done | {s: left * weights[s] / weight for s in free}
        done |= {s: cap * sizes[s] for s in over}


def test_mixing(spark, documents):
    skewed = documents.withColumn("source", F.when(F.col("doc_id") < 4, "tiny").otherwise(F.col("source")))
    mixed = mixing.mix(skewed, mixing.cycle_weights(5, 2, 1), keep=["doc_id", "source", "text"])
    out = mixed.collect()
    assert len(out) == documents.count() and all(r["size"] == len(WORD.findall(r.text or "")) for r in out)
    sizes, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in out:
        sizes[r.source] += r["size"]
        taken[r.source] += r["size"] * r.times
        largest[r.source] = max(largest[r.source], r["size"])
        assert 0 <= r.times <= 3
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = fill({s: sizes[s] for s in order}, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    for r in out:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9) and r.source_size == sizes[r.source]
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    again = mixing.mix(skewed.repartition(5), mixing.cycle_weights(5, 2, 1), keep=["doc_id", "source", "text"]).collect()
    assert collections.Counter((r.doc_id, r.times) for r in out) == collections.Counter((r.doc_id, r.times) for r in again)
    assert mixing.repeated(skewed, mixing.cycle_weights(5, 2, 1)).count() == sum(r.times for r in out)
    assert empty_and_wide(documents, lambda d: mixing.repeated(d, mixing.cycle_weights(5, 2, 1))).columns[-1] == "component_id"


# --- 10 licenses


def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT-text"].replace("Software", "Work").replace("merge, ", "")
    rows = [(1, f"foo bar {mit} baz. Released under the MIT License."), (2, "All Rights  reserved! Licensed under CC BY-NC 4.0."), (3, "the license of the version"), (4, None), (5, "license " * 5000), (6, "é Licensed under the Apache License, Version 2.0."), (6, "é Licensed under the Apache License, Version 2.0.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [x.license for x in r.licenses] for r in licenses.scan(df).collect()}
    assert got == {1: ["MIT-text", "MIT"], 2: ["All-rights-reserved", "CC-BY-NC-4.0"], 3: [], 4: [], 5: [], 6: ["Apache-2.0"]}
    best = {r.doc_id: r for r in licenses.digests(df).collect()}
    assert best[6].spans == "Apache-2.0:2:48" and best[6].best_coverage == 1.0 and best[4].best_license is None and 0.8 < best[1].best_coverage < 1
    assert licenses.scan(df.limit(0)).count() == 0


def whole_text_finds(text, known):
    """Names of the long templates that patience alignment with the whole text covers."""
    words = licenses.words_of(text.encode().lower())
    return {t.name for t in known if len(t.words) >= licenses.SHORT and len(licenses.patience(t.words, words)) >= t.need}


def test_no_license_is_lost_to_inserted_words():
    known = licenses.templates()
    rng = np.random.default_rng(10)
    for name in ("MIT-text", "MIT-full", "BSD-3-Clause", "ISC-text", "Zlib", "GPL-3.0-preamble"):
        words = licenses.TEMPLATES[name].split()
        for n in (0, 10, 87, 174, 1000):
            other = ["".join(rng.choice(list("abcdefgh"), 7)) for _ in range(n)]
            for at in (len(words) // 3, len(words) // 2):
                text = " ".join(["lead", *words[:at], *other, *words[at:], "trail"])
                got = licenses.find(licenses.words_of(text.encode().lower()), known)
                mine = [x for x in got if x[2] == name]
                assert len(mine) == 1 and mine[0][4] == 1.0, (name, n)
    twice = " ".join([*licenses.TEMPLATES["MIT-full"].split(), "between", *["x"] * 300, *licenses.TEMPLATES["MIT-full"].split()])
    assert [x[2] for x in licenses.find(licenses.words_of(twice.encode().lower()), known)] == ["MIT-full"] * 2


def test_licenses_hold_all_that_whole_texts_align(documents):
    known = licenses.templates()
    odd = [licenses.TEMPLATES["MIT-full"] + " " + licenses.TEMPLATES["Zlib"], "free software " * 200 + licenses.TEMPLATES["GPL-text"]]
    for text in [t for _, t in texts(documents) if len(t) < 50_000] + odd:
        words = licenses.words_of(text.encode().lower())
        got = licenses.find(words, known)
        by_name = {t.name: t for t in known if len(t.words) >= licenses.SHORT}
        for name in whole_text_finds(text, known) - {x[2] for x in got}:
            # a find gives way only to one of more words at the same place
            span = [j for _, j in licenses.patience(by_name[name].words, words)]
            assert any(x[0] <= span[-1] and span[0] <= x[1] and x[3] >= len(span) for x in got)


@pytest.mark.parametrize("text,name", [("MIT licensed", "MIT"), ("see GPLv3.", "GPL-3.0"), ("under the Apache License 2.0", "Apache-2.0"), ("licensed under the MIT License", "MIT"), ("BSD 3-Clause License", "BSD-3-Clause")])
def test_wordings(text, name):
    assert [x[2] for x in licenses.find(licenses.words_of(text.encode().lower()), licenses.templates())] == [name]


def test_ties_and_clashing_columns_of_licenses(spark):
    df = spark.createDataFrame([(1, "MIT licensed. GPLv3", "given"), (1, "MIT licensed. GPLv3", "given")], "doc_id long, text string, licenses string")
    out = licenses.scan(df).collect()
    assert [[x.license for x in r.licenses] for r in out] == [["MIT", "GPL-3.0"]] * 2
    assert {r.best_license for r in licenses.digests(df).collect()} == {"MIT"}


def test_licenses_stand_odd_rows(documents):
    assert licenses.digests(documents).count() == documents.count()
    assert empty_and_wide(documents, licenses.scan).count() == 30


def test_patience_alignment():
    a, b = b"a b c d e f g".split(), b"x a b q c d e y g".split()
    assert [a[i] for i, _ in licenses.patience(a, b)] == b"a b c d e g".split()
    assert licenses.longest_increasing([(0, 5), (1, 1), (2, 2), (3, 9), (4, 3)]) == [(1, 1), (2, 2), (4, 3)]
    assert licenses.patience([], b) == [] and licenses.patience(a, a) == [(i, i) for i in range(7)]


def test_mixer_runs_a_thousand_blocks_side_by_side(monkeypatch):
    runs, run = [], mixer._run
    monkeypatch.setattr(mixer, "_run", lambda *a: runs.append(len(a[3])) or run(*a))
    texts = [b"text %d" % i for i in range(1000)]
    form = mixer.shape(np.bincount(np.frombuffer(b"".join(texts), np.uint8), minlength=256), 1000)
    table = np.zeros(form.total, np.int8)
    whole = mixer.code(table, form, texts)
    assert runs == [1000]
    monkeypatch.setattr(mixer, "LANES", 7)
    assert np.array_equal(mixer.code(table, form, texts), whole)


def test_units_of_a_kind_are_looked_up_once(monkeypatch):
    """Equal units behind equal bytes and word starts share a kind, and units are what they are one step at a time."""
    texts = [b"the river in the valley " * 300, b"", b"\0\0a\0", bytes(range(256)) * 2, b"the river in the valley " * 300, "zo\u00eb".encode()]
    form = mixer.shape(np.bincount(np.frombuffer(b"".join(texts), np.uint8), minlength=256), 4000)
    for piece, part in ((1 << 20, 1 << 19), (100, 150)):
        monkeypatch.setattr(mixer, "PIECE", piece)
        monkeypatch.setattr(mixer, "SLICE", part)
        u = mixer.units([p for t in texts for p in mixer.pieces(t)], form)
        want = [p for t in texts for p in brute_units(form, t)]
        assert u.sizes.tolist() == [len(p) for p in want]
        got = zip(*(x[u.kind].tolist() for x in (u.code, u.base, *u.contexts)), strict=True)
        assert [(c, b, tuple(h)) for c, b, *h in got] == [tuple(x) for p in want for x in p]
    assert len(mixer.units([p for t in texts[:1] for p in mixer.pieces(t)], form).code) < 200


def test_keys_that_share_a_slot_stay_apart():
    keys = np.random.default_rng(2).integers(0, 1 << 63, 500).astype(np.uint64)[np.random.default_rng(3).integers(0, 500, 4000)]
    alike = mixer._alike(keys)
    assert (keys[alike] == keys).all() and (alike[alike] == alike).all() and len(set(alike.tolist())) < 1500


def test_many_kinds_of_units_are_coded_in_parts(monkeypatch):
    texts = [b"text %d of several" % i for i in range(50)]
    form = mixer.shape(np.bincount(np.frombuffer(b"".join(texts), np.uint8), minlength=256), 1000)
    table = predictor(form, texts)
    whole, held, run = mixer.code(table, form, texts), [], mixer._run
    monkeypatch.setattr(mixer, "KINDS", 100)
    monkeypatch.setattr(mixer, "_run", lambda *a: held.append(len(a[0])) or run(*a))
    assert np.allclose(mixer.code(table, form, texts), whole, rtol=1e-5) and max(held) <= 100


def test_words_are_numbered_in_the_order_they_are_counted():
    texts, learnt = [b"b a b", b"c a", b"", b"a d a"], [True, False, True, True]
    counts = lm.counted(texts, learnt)
    ids, words = lm.numbered(texts, learnt)
    assert counts == {b"c": 0, b"a": 3, b"b": 2, b"d": 1} and words == list(counts)
    assert [[words[i] for i in x] for x in ids] == [t.split() for t in texts]
    assert sorted(i for x in lm.dealt(words, 3) for i in x.tolist()) == [0, 1, 2, 3]
