"""Rules and set-up: staleness, splits, recipes, remembered readings, bars of the trackers, settings."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caloris.functions.scale import ScaleOptions
from caloris.operators import candidates, dataset, matching, provenance, readings, statistics
from caloris.operators.kernels import motion
from caloris.sources import discovery
from caloris.sources import readings as source


def test_stale_causes_in_circles_and_diamonds(spark):
    rng = random.Random(1)
    for n, extra in ((1, []), (30, []), (12, [(0, 11), (5, 5)])):
        edges = [(rng.randint(1, n), rng.randint(0, n)) for _ in range(2 * n)] + extra
        edges = edges if extra else [(max(e), min(e)) for e in edges if e[0] != e[1]]
        own = {0, n // 2}
        want = {}
        for c in own:
            want[c, c], layer, hops = 0, {c}, 0
            while layer:
                hops += 1
                layer = {s for s, u in edges if u in layer and (s, c) not in want}
                want |= {(s, c): hops for s in layer}
        found = provenance.stale_causes(spark.createDataFrame(edges or [(1, 0)], "stage int, upstream int"), spark.createDataFrame([(o,) for o in own], "stage int"))
        assert {(r.stage, r.cause): r.hops for r in found.collect()} == want or not edges
    empty = spark.createDataFrame([], "stage int")
    assert provenance.stale_causes(spark.createDataFrame([(1, 0)], "stage int, upstream int"), empty).count() == 0


def test_each_stage_has_its_rules(spark):
    """A changed region makes temperature and motion stale, not the scale; an edited output only set-ups; another video motion not."""
    kinds = ["annotation", "scale", "temperature", "motion", "scene", "dataset"]
    held = {"video": "v", "regions": "r", "scale": "s", "motion_video": "m"}
    manifests = spark.createDataFrame([(k, k, held, {"hz": "3"}, {"own": "o"}) for k in kinds], "stage string, kind string, inputs map<string,string>, settings map<string,string>, outputs map<string,string>")
    settings = spark.createDataFrame([(k, "hz", "3") for k in kinds], "stage string, setting string, value string")

    def stale(changed=(), gone=(), outputs=()):
        current = spark.createDataFrame([(k, n, "new" if n in changed else h) for k in kinds for n, h in held.items() if n not in gone], "stage string, name string, sha256 string")
        made = spark.createDataFrame([(k, "own", "edited" if k in outputs else "o") for k in kinds], "stage string, name string, sha256 string")
        return {(r.stage, r.reason) for r in provenance.stage_reasons(manifests, current, settings, made).collect()}

    assert stale() == set()
    assert stale(changed={"regions"}) == {("temperature", "INPUT_CHANGED"), ("motion", "INPUT_CHANGED")}
    assert stale(changed={"video"}) == {(k, "INPUT_CHANGED") for k in ("annotation", "scale", "temperature", "scene")}
    assert stale(gone={"scale"}) == {("temperature", "INPUT_MISSING")}
    assert stale(outputs=kinds) == {("annotation", "OUTPUT_EDITED"), ("scale", "OUTPUT_EDITED")}


def test_splits_keep_groups_together(spark):
    shares = {"train": 7, "valid": 2, "test": 1}
    rows = spark.range(20_000).select("id", (F.col("id") / 4).cast("int").alias("g")).withColumn("part", dataset.split(F.col("g"), shares))
    assert rows.groupBy("g").agg(F.countDistinct("part").alias("n")).filter("n > 1").count() == 0
    n = {r.part: r["count"] for r in rows.groupBy("part").count().collect()}
    assert all(abs(n[k] / 20_000 - v / 10) < 0.02 for k, v in shares.items())
    more = spark.range(30_000).select((F.col("id") / 4).cast("int").alias("g")).withColumn("again", dataset.split(F.col("g"), shares)).distinct()
    assert rows.join(more, "g").filter("part <> again").count() == 0
    other = rows.withColumn("other", dataset.split(F.col("g"), shares, seed=1))
    assert other.filter("part <> other").count() > 1000
    assert spark.range(1).select(dataset.split(F.lit(None).cast("int"), {"only": 1.0})).first()[0] == "only"


def test_a_recipe_fails_rather_than_guesses(spark):
    rows = [(g, label, i, v, str(v), "m", 7, i == 0) for g, low, high in (("a", 10.0, 40.0), ("b", 50.0, 40.0)) for i, (label, v) in enumerate((("MIN", low), ("MAX", high)))]
    df = spark.createDataFrame(rows, "g string, label string, ord int, value double, text string, method string, psm int, is_primary boolean")
    assert [r.g for r in candidates.recipe_pair(df.filter("g = 'a'"), ["g"], ScaleOptions()).collect()] == ["a"]
    assert [r.g for r in candidates.recipe_pair(df, ["g"], ScaleOptions(), strict=False).collect()] == ["a"]
    with pytest.raises(Exception, match="no plausible pair"):
        candidates.recipe_pair(df, ["g"], ScaleOptions()).collect()


def test_readings_are_remembered_with_their_errors(spark):
    looks = [(1, "a", 5, 20.0, None), (2, "a", 5, 99.0, None), (3, "a", 7, None, "unreadable"), (4, "a", 7, 30.0, None), (5, None, 7, 40.0, None), (6, None, 7, 50.0, None), (7, "b", 1, 60.0, None)]
    df = spark.createDataFrame(looks, "at int, video string, frame int, scale double, error string")
    found, cache = readings.memoised(df, ["video", "frame"], "at", ["scale", "error"])
    assert sorted((r["at"], r.scale, r.error, r.remembered) for r in found.collect()) == [
        (1, 20.0, None, False), (2, 20.0, None, True), (3, None, "unreadable", False), (4, None, "unreadable", True), (5, 40.0, None, False), (6, 40.0, None, True), (7, 60.0, None, False),
    ]
    assert cache.count() == 4
    later = spark.createDataFrame([(8, "a", 7, 31.0, None), (9, None, 7, 1.0, None), (10, "c", 0, 2.0, None), (11, "c", 0, 3.0, None)], df.schema)
    found, cache = readings.memoised(later, ["video", "frame"], "at", ["scale", "error"], cache)
    assert sorted((r["at"], r.scale, r.error, r.remembered) for r in found.collect()) == [(8, None, "unreadable", True), (9, 40.0, None, True), (10, 2.0, None, False), (11, 2.0, None, True)]
    assert cache.count() == 5


def test_bars_of_the_two_trackers(monkeypatch):
    """Errors of 65 pass for scenes alone; seven points are enough for camera tracking alone."""
    a, b = matching.TrackingOptions(), matching.SceneOptions()
    assert (a.worst_error, a.least_points, b.worst_error, b.least_points) == (60.0, 6, 70.0, 8)
    gray = np.zeros((50, 50), np.uint8)

    def seen(n, error, o):
        points = np.random.default_rng(1).uniform(5, 40, (n, 2))
        monkeypatch.setattr(motion, "corners", lambda *x: points)
        monkeypatch.setattr(motion, "track", lambda *x: (points + 1.0, np.full(n, error)))
        return motion.estimate(gray, gray, None, o.corners, o.worst_error, o.least_points)

    assert seen(20, 65.0, a).transform is None and seen(20, 65.0, b).transform is not None
    assert seen(20, 60.0, a).transform is None and seen(20, 59.9, a).transform is not None
    assert seen(20, 70.0, b).transform is None and seen(20, 69.9, b).transform is not None
    assert seen(6, 1.0, a).transform is not None and seen(5, 1.0, a).transform is None
    assert seen(8, 1.0, b).transform is not None and seen(7, 1.0, b).transform is None


def test_empty_regions_stay_in_the_log(spark):
    stats = statistics.region_statistics(spark.createDataFrame([(0, 1, 5.0), (0, 1, 7.0), (1, 2, None)], "frame int, region int, temperature double"), ["frame", "region"])
    skeleton = spark.createDataFrame([(f, r) for f in (0, 1) for r in (1, 2)], "frame int, region int")
    found = {(r.frame, r.region): r for r in statistics.with_empty_regions(stats, skeleton, ["frame", "region"]).collect()}
    assert len(found) == 4 and found[0, 1].valid_pixel_count == 2 and found[0, 1].avg_temp == 6.0
    assert all(found[k].valid_pixel_count == 0 and found[k].min_temp is None for k in ((0, 2), (1, 1), (1, 2)))


def test_stage_files_by_rank(spark):
    rows = [(1, "x", "s1", "s2", "f", 1), (2, None, None, "s2", "f", 1), (3, None, None, None, "f", 1), (4, None, None, None, "f", 2), (5, None, None, None, None, 0)]
    df = spark.createDataFrame(rows, "i int, e string, a string, b string, f string, n int")
    found = df.select("i", discovery.stage_file(F.col("e"), [F.col("a"), F.col("b")], F.col("f"), F.col("n")).alias("r")).select("i", "r.*").orderBy("i").collect()
    assert [(r.path, r.source) for r in found] == [("x", "explicit"), ("s2", "standard"), ("f", "unique"), (None, "none"), (None, "none")]


def test_scale_settings_and_checks(spark, tmp_path):
    whole = {"video": {"filename": "v.mp4"}, "scale": {"bar_roi": [1, 2, 3, 4], "max_text_roi": [5, 6, 7, 8], "min_text_roi": [9, 10, 11, 12], "min_ocr_method": "gray_otsu", "min_ocr_psm": 8, "min_scale_span_c": 2.5}}
    (tmp_path / "a.json").write_text(json.dumps(whole))
    (tmp_path / "b.json").write_text("no json")
    found = source.scale_settings(spark, str(tmp_path)).orderBy(F.col("filename").desc_nulls_last()).collect()
    assert found[0].bar.asDict() == {"x": 1, "y": 2, "w": 3, "h": 4} and (found[0].decimals, found[0].padding, found[0].inner_fraction, found[0].min_span, found[0].min_ocr_psm) == (1, 6, 0.2, 2.5, 8)
    assert found[1].filename is None
    rows = spark.createDataFrame([(1, 5), (2, None)], "i int, v int")
    assert source.checked(rows.filter("i = 1"), F.col("v") > 0, "bad").count() == 1
    with pytest.raises(Exception, match="bad value"):
        source.checked(rows, F.col("v") > 0, "bad value").collect()


def test_image_names(spark):
    assert spark.range(1).select(dataset.image_name(F.lit("clip"), F.lit(42), F.lit("aug_01"))).first()[0] == "clip__frame_000042__aug_01.jpg"


@pytest.mark.parametrize(("block", "others", "words"), [(7, False, 4), (4096, True, 1), (1, True, 2), (30, True, 4)])
def test_two_nearest_of_large_keys(spark, block, others, words):
    """Against all pairs; bits so few that distances are often equal, ids on both sides, nulls, keys of one side alone."""
    rng = random.Random(block)
    draw = lambda: [rng.choice([0, 1, 3, -1, 1 << 40]) for _ in range(words)]
    left = [(rng.choice("ab"), i, draw()) for i in range(60)] + [("c", 900, draw()), (None, 901, draw()), ("a", None, draw()), ("a", 902, None)]
    right = [(rng.choice("ab"), i, draw()) for i in range(50)] + [("d", 903, draw()), (None, 904, draw()), ("a", 905, None), ("e", 60, draw())]
    left.append(("e", 60, draw()))
    found = matching.two_nearest(spark.createDataFrame(left, "k string, q int, bits array<bigint>"), spark.createDataFrame(right, "k string, t int, bits array<bigint>"), ["k"], "q", "t", "bits", block, others)
    far = lambda a, b: sum(((x ^ y) & ((1 << 64) - 1)).bit_count() for x, y in zip(a, b))
    want = []
    for k, q, a in left:
        near = sorted((far(a, b), t) for j, t, b in right if k is not None and a is not None and b is not None and j == k and not (others and t == q)) if q is not None else []
        if near:
            want.append((k, q, near[0][1], near[0][0], near[1][0] if len(near) > 1 else None))
    assert sorted((r.k, r.q, r.t, r.d1, r.d2) for r in found.collect()) == sorted(want)
