"""Joins by place, and quantiles of large groups, against plain Python."""

import math
import random

import numpy as np
import pytest

from caloris.operators import quantiles, spatial, statistics


def test_intervals(spark):
    rng = random.Random(1)
    values = [(i, rng.choice("ab"), rng.choice([None, float("nan")]) if i % 40 == 0 else round(rng.uniform(-300, 300), 1)) for i in range(400)] + [(900, None, 1.0), (901, "a", -16.0), (902, "a", 32.0)]
    spans = [(i, rng.choice("ab"), low := round(rng.uniform(-300, 300), 1), low + rng.choice([0.0, 0.3, 5.0, 40.0, 700.0, -1.0])) for i in range(200)] + [(900, None, 0.0, 5.0), (901, "a", None, 5.0), (902, "b", -1e6, 1e6), (903, "a", 32.0, 32.0), (904, "a", -16.0, 0.0)]
    left, right = spark.createDataFrame(values, "id int, k string, at double"), spark.createDataFrame(spans, "span int, k string, low double, high double")
    found = spatial.interval_join(left, right, ["k"], "at", "low", "high")
    want = sorted((i, s) for i, k, v in values for s, q, a, b in spans if k is not None and k == q and v is not None and a is not None and a <= v <= b)
    assert sorted((r.id, r.span) for r in found.collect()) == want and len(want) > 500
    assert spatial.interval_join(left, right.limit(0), ["k"], "at", "low", "high").count() == 0


def inside(points, x, y):
    """By angles of exact fractions: even-odd with the edge included."""
    odd = False
    for (ax, ay), (bx, by) in zip(points, points[1:] + points[:1]):
        if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return True
        if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
            odd = not odd
    return odd


def test_polygons(spark):
    rng = random.Random(2)
    shapes = []
    for i in range(60):
        cx, cy, size = rng.randint(-200, 200), rng.randint(-200, 200), rng.choice([2, 8, 64, 512])
        shapes.append((i, [(float(cx + rng.randint(-size, size)), float(cy + rng.randint(-size, size))) for _ in range(rng.randint(3, 7))]))
    shapes += [(100, []), (101, None), (102, [(5.0, 5.0)]), (103, [(0.0, 0.0), (64.0, 0.0), (64.0, 64.0), (0.0, 64.0)])]
    points = [(i, float(rng.randint(-220, 220)), float(rng.randint(-220, 220))) for i in range(500)] + [(900, None, 1.0), (901, 5.0, 5.0), (902, 64.0, 64.0), (903, 0.0, 32.0)]
    polygons = spark.createDataFrame([(i, None if s is None else [{"x": x, "y": y} for x, y in s]) for i, s in shapes], "shape int, pts array<struct<x:double,y:double>>")
    places = spark.createDataFrame(points, "id int, x double, y double")
    joined = spatial.points_in_polygons(places, polygons, [], "x", "y", "pts")
    want = sorted((i, n) for i, x, y in points for n, s in shapes if s and x is not None and inside(s, x, y))
    assert sorted((r.id, r.shape) for r in joined.collect()) == want and len(want) > 200
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("kind", ["mixed", "ties", "extremes"])
def test_quantiles(spark, kind):
    rng = np.random.default_rng(3)
    draws = {"mixed": lambda n: rng.normal(0, 100, n), "ties": lambda n: rng.integers(0, 5, n).astype(float), "extremes": lambda n: rng.choice([-0.0, 0.0, 5e-324, -1e308, 1e308, 1.5, -2.5, math.inf, 1 / 3], n)}
    groups = {("a", 1): 1000, ("a", None): 37, (None, 2): 2, ("b", 2): 1}
    held = {k: draws[kind](n) for k, n in groups.items()}
    rows = [(*k, float(v)) for k, values in held.items() for v in values] + [("a", 1, None), ("a", 1, math.nan), ("c", 1, None)]
    df = spark.createDataFrame(rows, "g string, h int, v double").repartition(5)
    shares = [0.0, 0.5, 0.95, 0.99, 1.0]
    found = {(r.g, r.h): r for r in quantiles.group_quantiles(df, ["g", "h"], "v", shares).collect()}
    assert set(found) == set(groups)
    for k, values in held.items():
        assert found[k].n == len(values)
        ordered = np.sort(values)
        for s, got in zip(shares, found[k].quantiles):
            low, high = ordered[math.floor(s * (len(values) - 1))], ordered[math.ceil(s * (len(values) - 1))]
            want = low + (high - low) * (s * (len(values) - 1) % 1) if low != high else low
            assert got == pytest.approx(want, rel=1e-12, abs=0) or (math.isinf(low) or math.isinf(high))
    if kind != "extremes":
        ours = {(r.g, r.h): r for r in statistics.large_region_statistics(df, ["g", "h"], "v").collect()}
        for r in statistics.region_statistics(df, ["g", "h"], "v").collect():
            assert all(ours[r.g, r.h][c] == pytest.approx(r[c]) for c in ("min_temp", "avg_temp", "max_temp", "median_temp", "p95_temp", "p99_temp", "valid_pixel_count"))
    assert quantiles.group_quantiles(df.limit(0), ["g", "h"], "v", shares).count() == 0
