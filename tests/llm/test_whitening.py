"""Whitening against numpy, and the rows that it must stand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from caloris.llm import whitening

NAN, INF = float("nan"), float("inf")


def brute(vectors, most=32):
    """n, exact deviations, whitened rows, eigenvalues and the trace of the vectors of one length."""
    x = [[int(np.floor(64 * c)) + 1000000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    apart = [[n * a - s for a, s in zip(r, sums)] for r in x]
    centred = np.array(apart, float) / n
    values, v = np.linalg.eigh(centred.T @ centred / n)
    k = min(most, int((values > 1e-12 * values[-1]).sum()) if values[-1] > 0 else 0)
    values, v = values[::-1][:k], v[:, ::-1][:, :k]
    return n, [sum(a * a for a in r) for r in apart], centred @ v / np.sqrt(values), values, sum(a * a for r in apart for a in r) / n**3


def held_against(spark, vectors, most=32, partitions=3):
    rows = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(partitions)
    n, deviations, want, values, trace = brute(vectors, most)
    found = whitening.whiten(rows, keep=["vec_id"], components=most).collect()
    assert len(found) == want.size
    got = np.full(want.shape, np.nan)
    for r in found:
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == (deviations[r.vec_id] if deviations[r.vec_id] < 1 << 63 else None)
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-4) and r.identity_error < 1e-4
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-5


@pytest.mark.parametrize(("n", "d", "spread"), [(300, 8, 1.0), (500, 40, 0.1), (40, 64, 5.0), (200, 130, 1.0)])
def test_equals_numpy(spark, n, d, spread):
    """Also with fewer vectors than dimensions: directions without variance have no component."""
    rng = np.random.default_rng(n)
    held_against(spark, rng.normal(0, spread, (n, d)) * np.linspace(1, 20, d) + rng.normal(0, 3, d))


def test_deviations_beyond_a_long(spark):
    rng = np.random.default_rng(1)
    held_against(spark, np.vstack([rng.normal(0, 1, (50, 4)), rng.normal(0, 1, (3, 4)) * 1e9]), most=3)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [[float(c) for c in v] for v in rng.normal(0, 1, (60, 3))]
    rows = [(i, v) for i, v in enumerate(good)] + [(0, good[0]), (None, good[1])]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, NAN, 2.0]), (104, [INF, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [3.0, 1.0]), (107, [7.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("n", F.lit("x")).withColumn("c0", F.lit(5)).withColumn("v", F.lit(1))
    found = whitening.whiten(df).collect()
    assert found[0].__fields__ == ["vec_id", "c0", "v", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    of = lambda low, high: [r for r in found if (r.vec_id or 0) >= low and (r.vec_id or 0) < high]
    # repeated rows and null ids count; two vectors of two entries have a space of one component, a single vector none
    assert len(of(0, 100)) == 62 * 3 and {r.n for r in of(0, 100)} == {62}
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 6), r.n, round(r.explained, 6)) for r in of(100, 200)) == [(105, 1, 1.0, 2, 1.0), (106, 1, 1.0, 2, 1.0)]
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.filter("vec_id >= 100 AND vec_id < 105")).count() == 0


def test_fit_serves_other_tables(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(0, 1, (80, 5)))], "vec_id long, embedding array<double>")
    fits = whitening.fit(df)
    some = {(r.vec_id, r.component): r.whitened for r in whitening.whiten(df.filter("vec_id < 9"), fits).collect()}
    whole = {(r.vec_id, r.component): r.whitened for r in whitening.whiten(df, fits).collect()}
    assert len(some) == 45 and all(whole[k] == pytest.approx(v) for k, v in some.items())
