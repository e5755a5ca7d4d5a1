"""The pipeline against a brute-force version of its stages."""

import collections
import re

import numpy as np
import public_tokenizers

import corpus_pipeline
from caloris.llm import langid, mixing

from .test_jaccard import brute_components
from .test_operators import _ASSIGN

SMALL = "/root/testdata/sf0.001"


def redacted(text):
    """Spans in order; one that starts inside an earlier one adds its length alone."""
    spans = [(m.start(), 0, m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    out, at = [], 0
    for a, _, b, kind in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[SECRET:{kind}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def test_pipeline_equals_brute_force(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    langs, scores = langid.Scorer(langid.fit(docs)).predict([r.text for r in rows.values()])
    rows = {k: r for (k, r), lang, s in zip(rows.items(), langs, scores) if lang != "und" and s >= 0.5}
    classes = brute_components({k: r.text for k, r in rows.items()})
    kept = {k: redacted(r.text) for k, r in rows.items() if classes[k] == k}
    table = spark.createDataFrame([(k, rows[k].source, t) for k, t in kept.items()], "doc_id long, source string, text string")
    times = {r.doc_id: r.times for r in mixing.mix(table, mixing.cycle_weights(5, 2, 1)).collect()}
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for k, t in kept.items():
        want[k, tuple(tok.encode(t, add_special_tokens=False).ids)] += times[k]
    got = collections.Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert got == +want and np.all([len(ids) > 0 for _, ids in got])


def test_stages_keep_columns_and_stand_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        assert out.count() == 0
        assert i == len(corpus_pipeline.STAGES) - 1 or out.columns == docs.columns
