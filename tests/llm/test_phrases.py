"""Collocations against plain counting."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from caloris.llm import phrases
from caloris.llm.phrases import PhraseOptions

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(docs):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f["und" if lang is None else lang, tuple(words[i : i + k])] += 1
    return f, n


def brute(docs, o):
    f, n = brute_counts(docs)
    found = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= o.least:
            score, cut = min((2000000 * a // (f[lang, p[:c]] + f[lang, p[c:]]), c) for c in range(1, len(p)))
            found[lang, p] = (score, a, f[lang, p[:cut]], f[lang, p[cut:]])
    inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
    by_lang = collections.defaultdict(list)
    for (lang, p), v in found.items():
        by_lang[lang].append((p, *v))
    out = []
    for lang, rows in by_lang.items():
        longer = collections.defaultdict(list)
        for q, _, b, *_ in rows:
            for w in set(q):
                longer[w].append((q, b))
        kept = [(p, s, a, left, r) for p, s, a, left, r in rows if not any(len(q) > len(p) and 100 * b >= o.cover * a and inside(p, q) for q, b in longer[p[0]])]
        kept.sort(key=lambda x: (-x[1], -x[2], " ".join(x[0]).encode()))
        out += [(lang, i, " ".join(p), a, left, r, n[lang], s) for i, (p, s, a, left, r) in enumerate(kept[: o.top], 1)]
    return sorted(out)


def pairs(documents):
    return [(r.lang, r.text) for r in documents.collect()]


@pytest.mark.parametrize("options", [PhraseOptions(), PhraseOptions(least=3, bits=10), PhraseOptions(least=2, top=50, cover=50, bits=20)])
def test_mined(spark, documents, options):
    """Also where the sets are so small that nearly every bit is shared."""
    found = phrases.mine(documents, options=options)
    assert sorted(map(tuple, found.collect())) == brute(pairs(documents), options)


@pytest.mark.parametrize("size", [7, 60, 1000])
def test_long_texts_in_parts(spark, documents, size):
    """Texts cut every few bytes give the counts of whole ones: phrases cross cuts, none is counted twice."""
    some = documents.filter("length(text) < 3000 OR doc_id = 9005").limit(60)
    o = PhraseOptions(least=2, bits=16)
    f, n = brute_counts(pairs(some))
    table, totals = phrases.counts(some, options=o, size=size)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in table.collect()} == {k: v for k, v in f.items() if v >= 2}
    assert {r.lang: r.n for r in totals.collect() if r.n} == {k: v for k, v in n.items() if v}


def test_pieces_overlaps_and_clashing_columns(spark):
    rows = [("en", "A b. c D, a a a a\nb\ta  b"), ("en", None), (None, "x y! x y"), ("de", ""), ("", "q r q r"), ("und", "x y")]
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit(1)).withColumn("bucket", F.lit("x")).withColumn("n", F.lit(None).cast("int"))
    o = PhraseOptions(least=1, bits=12)
    assert sorted(map(tuple, phrases.mine(df, options=o).collect())) == brute(rows, o)
    assert phrases.mine(df.limit(0)).count() == 0


def test_ranks_among_equal_scores(spark):
    """More equal scores than places: the order goes by occurrences and bytes, across the shares in which places are dealt."""
    rows = [("en", f"w{i} é{i}") for i in range(3000) for _ in range(2 + i % 2)] + [("en", "Z😀 a"), ("en", "Z😀 a")]
    o = PhraseOptions(least=2, top=1700)
    assert sorted(map(tuple, phrases.mine(spark.createDataFrame(rows, "lang string, text string"), options=o).collect())) == brute(rows, o)
