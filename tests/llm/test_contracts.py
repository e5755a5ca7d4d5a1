"""Every registered query over the smallest tables: its columns and types, against SQL or plain Python."""

import collections
import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest

from caloris.llm import queries
from tests.test_queries import rows

from .test_operators import WORD, brute_classes, brute_print, lower, personal

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op2_vectors": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op3_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op4_lm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op5_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op6_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op7_fertility": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op8_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op9_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op11_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    "op12_phrases": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op13_exact": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op10_licenses": "doc_id bigint, n_licenses bigint, spans string, best_license string, best_coverage double",
}


@pytest.fixture(scope="module")
def found(spark):
    held = {}

    def of(name):
        if name not in held:
            df = queries.queries()[name](spark, SMALL)
            assert {tuple(c.split()) for c in COLUMNS[name].split(", ")} <= set(df.dtypes)
            held[name] = df.collect()
        return held[name]

    return of


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = queries.queries()[name](spark, SMALL).toPandas(), duck.sql(queries.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", ["op3_secrets", "op5_bpe", "op6_pii", "op7_fertility", "op10_licenses"])
def test_a_row_for_each_document(found, docs, name):
    assert sorted(r.doc_id for r in found(name)) == sorted(docs)


def test_op1(found, docs):
    out = found("op1_language")
    assert sorted(r.doc_id for r in out) == sorted(docs) and all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in out)
    fair = [r for r in out if r.held_out and docs[r.doc_id].lang]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in fair) >= 0.95 * len(fair) > 10


def test_op4(found, docs):
    split = {i: [*WORD.findall(lower(r.text or "")), None] for i, r in docs.items()}
    counts = collections.Counter(w for i, words in split.items() if fold(i, 5) != 1 for w in words)
    n, v = sum(counts.values()), len(counts)
    for r in found("op4_lm"):
        want = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in split[r.doc_id])
        assert math.isclose(r.base_score, want, rel_tol=1e-9) and r.held_out == (fold(r.doc_id, 5) == 1) and r.score < 0
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(split[r.doc_id]), sum(counts[w] > 0 for w in split[r.doc_id]), n)


def test_op5(found, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in found("op5_bpe"):
        ids = tok.encode(docs[r.doc_id].text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_op6(found, docs):
    for r in found("op6_pii"):
        spans = personal(docs[r.doc_id].text or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans).encode()).hexdigest()


def test_op8(found, docs):
    prints = {i: brute_print(r.text or "") for i, r in docs.items()}
    classes = brute_classes(list(prints.items()))
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found("op8_simhash")} == {(i, f"{p:016x}", classes[i]) for i, p in prints.items()}


def test_whitening(spark, found):
    """Against numpy on the whole table: exact sums and deviations, eigenvectors of the covariance, to the sign."""
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()}
    sound = {i: v for i, v in vectors.items() if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    x = {i: [math.floor(64 * float(c)) + 1000000 for c in v] for i, v in sound.items()}
    n, sums = len(x), [sum(c) for c in zip(*x.values())]
    ids = sorted(x)
    centred = np.array([[(n * a - s) / n for a, s in zip(x[i], sums)] for i in ids])
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1][:32], components[:, ::-1][:, :32]
    want = centred @ components / np.sqrt(values)
    got = np.full((n, 32), np.nan)
    row = {i: k for k, i in enumerate(ids)}
    for r in found("op11_whitening"):
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x[r.vec_id], sums)) and 0 <= r.identity_error <= 1e-4
        assert abs(r.explained * (centred**2).sum() / n / values[r.component - 1] - 1) < 1e-9
        got[row[r.vec_id], r.component - 1] = r.whitened
    assert len(found("op11_whitening")) == 32 * n
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-6
