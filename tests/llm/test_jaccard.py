"""Near-duplicates by shingle sets against brute force."""

import random

import numpy as np
import pytest

import corpus_pipeline
from caloris.llm import blocks, jaccard, simhash

SMALL = "/root/testdata/sf0.001"


def brute_set(text, n=5):
    words = (text or "").lower().split()
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute_components(texts, similarity=0.8):
    """The smallest id that links reach from each id of texts."""
    sets = {k: brute_set(t) for k, t in texts.items()}
    of = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and (sets[a] == sets[b] or both / len(sets[a] | sets[b]) >= similarity) and of[a] != of[b]:
                low, high = sorted((of[a], of[b]))
                of = {k: low if v == high else v for k, v in of.items()}
    return of


def planted():
    """Texts of 100 words, with copies that have one word changed (0.90 alike), and with four changed far apart (0.66 alike)."""
    r = random.Random(1)
    texts = {}
    for k in range(30):
        words = ["".join(r.choices("abcdefghij", k=6)) for _ in range(100)]
        texts[10 * k] = " ".join(words)
        texts[10 * k + 1] = " ".join(["changed" if i == 50 else w for i, w in enumerate(words)])
        texts[10 * k + 2] = " ".join([f"other{i}" if i % 25 == 12 else w for i, w in enumerate(words)])
    return texts | {1000: "", 1001: "  ", 1002: "two words", 1003: "Two  words", 1004: "two others"}


def test_the_stage_drops_edited_copies(spark):
    texts = planted()
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()] + [(1005, None), (None, "two words")], "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()
    want = [k for k, c in brute_components(texts).items() if c == k]
    assert sorted((r.doc_id for r in got), key=lambda k: (k is None, k)) == [*sorted(want), None]
    assert not {1, 11, 21, 1001, 1003} & set(want) and {0, 2, 1000, 1002, 1004} <= set(want)


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    of = brute_components({r.doc_id: r.text for r in docs.collect()})
    assert sorted(r.doc_id for r in simhash.dedup(docs, shingle=5, similarity=0.8).collect()) == sorted(k for k, c in of.items() if c == k)


def test_large_components_are_cut(spark, monkeypatch):
    """A chain: each text is alike the next alone, and blocks of a few rows still find every link."""
    monkeypatch.setattr(jaccard, "dealt", lambda *a: blocks.dealt(*a, block=4))
    monkeypatch.setattr(jaccard, "HELD", 5)
    rows = [(1, k, np.arange(5 * k, 5 * k + 60, dtype="<u8").tobytes()) for k in range(40)] + [(2, 100, np.arange(9, dtype="<u8").tobytes()), (2, 101, np.arange(4, 20, dtype="<u8").tobytes())]
    found = jaccard.links(spark.createDataFrame(rows, "component long, id long, shingles binary"))
    assert {(r.node, r.component) for r in jaccard.components(found.distinct()).collect()} == {(k, 0) for k in range(40)}


def test_the_bound_itself_is_alike():
    sets = [np.arange(5, dtype="<u8"), np.arange(4, dtype="<u8"), np.arange(3, dtype="<u8")]
    assert [x.tolist() for x in jaccard.similar(sets, 0, 0.8)] == [[0], [1]]
    assert [x.tolist() for x in jaccard.similar(sets, 1, 0.8)] == [[0], [1]]


@pytest.mark.parametrize("similarity,least", [(0.8, 0.99), (0.9, 0.999)])
def test_keys_meet_the_stated_recall(similarity, least):
    r = np.random.default_rng(3)
    n, met, far = 1800, 0, 0
    common = round(similarity * n)
    for _ in range(300):
        a = r.integers(0, 1 << 63, n, dtype=np.uint64)
        rest = (n - common) // 2
        b = np.r_[a[:common], a[common + rest :]]
        met += bool(set(jaccard.keys(a[: common + rest])) & set(jaccard.keys(b)))
        far += (simhash.fingerprint_of(a[: common + rest]) ^ simhash.fingerprint_of(b)).bit_count() > simhash.radius_of(similarity)
    assert met >= least * 300 and not far


def test_fingerprints_of_small_sets_stay_near():
    """Sets of few shingles have ties, which move bits more often: even so nearly all pairs at 0.8 are within the radius."""
    r = np.random.default_rng(5)
    a = r.integers(0, 1 << 63, (2000, 10), dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, (2000, 10), dtype=np.uint64)
    for n in (5, 10):
        off = [(simhash.fingerprint_of(x[:n]) ^ simhash.fingerprint_of(x[: n * 4 // 5])).bit_count() for x in a]
        assert np.mean(np.array(off) > simhash.radius_of(0.8)) < 0.005
