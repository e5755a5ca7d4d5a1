import math

import pytest
from pyspark.sql import functions as F

from caloris.functions import geometry as G
from caloris.functions import text as X

PARSED = [
    ("15.6", 15.6), ("156", 15.6), ("469", 46.9), ("1", None), ("8", None), ("15", None), ("4 6.9", 46.9), (".5", None), ("12-3", None), ("46.", None), ("29.20", 29.2), ("67.38", 67.38),
    ("-156", -15.6), ("--15.6", -15.6), ("15.6C", 15.6), ("1.2.3", 1.2), ("abc", None), ("", None), (None, None),
]


def test_parse_temperature(spark):
    df = spark.createDataFrame(PARSED, "t string, v double").select("t", "v", X.parse_temperature(F.col("t")).alias("p"))
    for r in df.collect():
        assert r.p == r.v or abs(r.p - r.v) < 1e-9, r


def test_interval_and_times(spark):
    df = spark.createDataFrame([(24.31192660550459,), (24.679603433683955,), (1.0,), (7.5,)], "fps double")
    assert [r[0] for r in df.select(X.ocr_interval(F.col("fps"), F.lit(3.0))).collect()] == [8, 8, 1, 2]
    one = spark.range(1)
    assert one.select(X.human_time(F.lit(125.5))).first()[0] == "02:05.50"
    assert one.select(X.safe_name(F.lit("  95.fur incin / AB "))).first()[0] == "95_fur_incin_AB"
    assert one.select(X.mirrored(F.lit("/data/Raw-Videos/a/b/c.mp4"), "raw-videos")).first()[0] == "a/b/c"
    assert one.select(X.mirrored(F.lit("/data/c.mp4"), "raw-videos")).first()[0] == "c"
    assert one.select(X.redact_url(F.lit("rtsp://u:p@h/x"))).first()[0] == "rtsp://h/x"


def test_login():
    assert X.with_login("rtsp://h:554/x", "a b", "p@ss") == "rtsp://a%20b:p%40ss@h:554/x"
    assert X.with_login("rtsp://u@h/x", "a", "b") == "rtsp://u@h/x"
    with pytest.raises(ValueError):
        X.with_login("http://h", "a", "b")


def test_transform_round_trip(spark):
    h = G.similarity(F.lit(20.0), F.lit(-10.0), F.lit(1.0), F.lit(1.0), F.lit(640.0), F.lit(480.0))
    m = spark.range(1).select(G.metrics(h, F.lit(640.0), F.lit(480.0)).alias("m")).select("m.*").first()
    assert math.isclose(m.dx, 20) and math.isclose(m.dy, -10) and math.isclose(m.scale, 1)
    assert math.isclose(abs(m.rotation_deg), 1)
    same = spark.range(1).select(G.compose(G.identity(), h).alias("a"), h.alias("b")).first()
    assert all(math.isclose(x, y) for x, y in zip(same.a, same.b))


def test_polygons(spark):
    p = G.rectangle(F.lit(10), F.lit(20), F.lit(4), F.lit(6))
    r = spark.range(1).select(G.area(p).alias("a"), G.bounding_box(p).alias("b"), G.fits(p, F.lit(30), F.lit(30)).alias("f"), G.fits(p, F.lit(12), F.lit(30)).alias("g")).first()
    assert r.a == 84 and r.b == [4, 6, 6, 14] and r.f and not r.g
    assert spark.range(1).select(G.area(F.slice(p, 1, 2))).first()[0] == 0


def test_ramp(spark):
    got = [r[0] for r in spark.range(6).select(G.ramp(F.col("id"), F.lit(2), F.lit(4))).collect()]
    assert got == [0, 0, 0.25, 0.5, 0.75, 1.0]
