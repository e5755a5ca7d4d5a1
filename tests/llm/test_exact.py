"""Exact duplicates against a dictionary of whole texts."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from caloris.llm import exact

BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def brute(rows):
    """By (id, text): the id that stays, the group's size."""
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[BLANKS.sub(" ", t or "")].append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return {(i, t): (least[k := BLANKS.sub(" ", t or "")], len(groups[k])) for i, t in rows}, len(groups)


@pytest.mark.parametrize(("prefix", "bits"), [(256, 24), (1, 7), (8, 24)])
def test_groups(spark, documents, prefix, bits):
    """Also with a prefix that tells little and sets so small that most classes share a bit."""
    want, n = brute([(r.doc_id, r.text) for r in documents.collect()])
    found = exact.groups(documents, keep=["doc_id", "text"], prefix=prefix, bits=bits).collect()
    assert len(found) == documents.count() and sum(r.kept for r in found) == n
    assert all(want[r.doc_id, r.text] == (r.keep_id, r.group_size) for r in found)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_blanks_and_near_misses(spark):
    texts = ["a b", "a  b", "a\tb", "a \n\x0b\x0c\r b", "a\x0b\x0bb", " a b", "a b ", "a b", "A b", "ab", "", None, " ", "\n\n", "x" * 300 + "1", "x" * 300 + "2", "x" * 300 + "1", "é", "é"]
    rows = list(enumerate(texts))
    want, _ = brute(rows)
    found = exact.groups(spark.createDataFrame(rows, "doc_id long, text string"), keep=["doc_id", "text"]).collect()
    assert {(r.doc_id, r.text): (r.keep_id, r.group_size) for r in found} == want
    assert {r.doc_id for r in found if r.kept} == {keep for keep, _ in want.values()}


def test_one_group_holds_a_third(spark):
    rows = spark.range(30_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'the same  text', concat('text ', id % 20000)) AS text")
    found = exact.groups(rows.repartition(8))
    assert found.filter("group_size = 10000").agg(F.count("*"), F.min("keep_id"), F.max("keep_id"), F.count_if("kept")).first() == (10_000, 0, 0, 1)
    assert found.filter("kept").count() == rows.selectExpr("regexp_replace(text, ' +', ' ') AS t").distinct().count()


def test_rows_that_stay(spark, documents):
    wide = documents.withColumn("full", F.lit("x")).withColumn("kept", F.lit(1)).withColumn("c0", F.lit(2)).withColumn("count", F.lit(3))
    out = exact.dedup(wide)
    assert out.columns == wide.columns and out.count() == len({BLANKS.sub(" ", r.text or "") for r in documents.collect()})
    assert exact.groups(documents.limit(0)).count() == 0 and exact.dedup(documents.limit(0)).columns == documents.columns


def test_nothing_but_native_operators(spark, documents):
    plan = exact.groups(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan
