import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caloris.operators import dataset as D
from caloris.operators import fold
from caloris.operators import provenance as P
from caloris.operators import windows as W
from caloris.operators.kernels import motion, pixels
from caloris.operators.thermal import polygon_spans, temperature_log
from caloris.sources import frames as S
from caloris.sources import readings as R
from caloris.sources import store


def replay(step, rows):
    state, out = None, []
    for r in rows:
        state, made = step(state, r)
        out.append(made)
    return out


def pairs(*values):
    return [{"low": a, "high": b} for a, b in values]


SPIKE = pairs((15.6, 46.9), (15.6, 467.7), (15.7, 47.0), (23.7, 55.0), (23.7, 55.0), (23.7, 55.1))


def test_hold_keeps_the_old_level():
    got = [s for *_, s in replay(fold.hold_step(fold.ScaleGate()), SPIKE)]
    assert got == ["ACCEPT_PRIMARY", "HOLD_PREVIOUS", "ACCEPT_PRIMARY"] + ["HOLD_PREVIOUS"] * 3
    assert replay(fold.hold_step(fold.ScaleGate(max_jump=0)), pairs((1, 10), (1, 10), (2, 11)))[-1][2] == "HOLD_PREVIOUS"
    assert replay(fold.hold_step(fold.ScaleGate(max_jump=0), clip=False), pairs((1, 10), (2, 90)))[-1][2] == "ACCEPT_PRIMARY"
    assert replay(fold.hold_step(fold.ScaleGate()), pairs((None, 3), (1, 3)))[-1] == (None, None, "HOLD_PREVIOUS")


def test_jump_is_confirmed_by_the_next_reading():
    got = [s for *_, s in replay(fold.confirm_step(fold.ScaleGate()), SPIKE)]
    assert got == ["ACCEPT_PRIMARY", "PENDING_JUMP", "ACCEPT_PRIMARY", "PENDING_JUMP", "ACCEPT_CONFIRMED", "ACCEPT_PRIMARY"]
    failed = pairs((15.6, 46.9), (30, 60), (None, None), (30, 60), (30, 60))
    assert [s for *_, s in replay(fold.confirm_step(fold.ScaleGate()), failed)] == ["ACCEPT_PRIMARY", "PENDING_JUMP", "HOLD_PREVIOUS", "PENDING_JUMP", "ACCEPT_CONFIRMED"]


@pytest.mark.parametrize("events, total, counts", [((100, 137, 226, 263), 349, (245, 74, 30)), ((102, 140, 231, 269), 357, (251, 76, 30))])
def test_scene_replay(spark, events, total, counts):
    """Moves and settles at these frames; the banner shows for the new view alone."""
    first, settled, second, back = events
    # evidence that makes the states change at these frames: the third moving and the twelfth still frame in a row decide
    moving = F.col("frame").between(first - 2, settled - 12) | F.col("frame").between(second - 2, back - 12)
    judged = spark.range(total).select(F.lit("v").alias("video"), F.col("id").cast("int").alias("frame")).withColumn("moving", moving).withColumn("stable", ~moving)
    states = fold.ordered_fold(judged, "video", ["frame"], ["moving", "stable"], fold.scene_step(fold.SceneRules()), fold.SCENE_FIELDS)
    assert [(r.frame, r.event) for r in states.filter("event IS NOT NULL").orderBy("frame").collect()] == list(zip(events, ("MOVEMENT_STARTED", "SETTLED") * 2))
    replayed = states.select(W.banner(states, "video", "frame", F.col("frame") == settled, 30, "state", "NEW_STABLE_VIEW").alias("s")).groupBy("s").count()
    assert {r["s"]: r["count"] for r in replayed.collect()} == dict(zip(("STABLE", "MOVING", "NEW_STABLE_VIEW"), counts))
    state = F.when(F.col("frame").between(first, settled - 1) | F.col("frame").between(second, back - 1), "MOVING").otherwise("STABLE")
    rows = spark.range(total).select(F.lit("v").alias("video"), F.col("id").cast("int").alias("frame")).withColumn("state", state)
    shown = rows.select(W.banner(rows, "video", "frame", F.col("frame") == settled, 30, "state", "NEW_STABLE_VIEW").alias("s")).groupBy("s").count()
    assert {r["s"]: r["count"] for r in shown.collect()} == dict(zip(("STABLE", "MOVING", "NEW_STABLE_VIEW"), counts))


def test_scene_step_resets_on_change():
    rules = fold.SceneRules(moving_frames=3, stable_frames=2)
    flags = [(1, 0), (1, 0), (0, 0), (1, 0), (1, 0), (1, 0), (0, 1), (1, 0), (0, 1), (0, 1)]
    got = replay(fold.scene_step(rules), [{"moving": bool(a), "stable": bool(b)} for a, b in flags])
    assert [g[3] for g in got] == [None] * 5 + ["MOVEMENT_STARTED", None, None, None, "SETTLED"]


def test_tracking_holds_and_suspects():
    move = [1.0, 0, 2.0, 0, 1.0, 0]
    rows = [{"frame": 0, "accepted": False, "delta": None}] + [{"frame": i, "accepted": ok, "delta": move} for i, ok in enumerate([True, False, False, True], 1)]
    got = replay(fold.track_step(warn_after=2), rows)
    assert [g[0] for g in got] == ["REFERENCE", "TRACKED", "HOLD_LAST_GOOD", "SCENE_CHANGE_SUSPECTED", "TRACKED"]
    assert got[-1][3][2] == 4.0 and got[2][1] == 1


def test_views_are_told_apart():
    rows = [{"scores": None}, {"scores": [5.0]}, {"scores": [50.0, 50.0]}, {"scores": [1.0, 60.0]}]
    assert replay(fold.identify_views(40.0), rows) == [(1, "INITIAL_VIEW"), (2, "NEW_STABLE_VIEW"), (1, "RETURN_TO_KNOWN_VIEW"), (2, "RETURN_TO_KNOWN_VIEW")]


def test_fold_orders_rows_and_parts_keys(spark):
    rows = [("b", 1, 1.0, 9.0), ("a", 2, None, 9.0), ("a", 0, 1.0, 10.0), ("b", 0, None, None), ("a", 1, 1.5, 10.5)]
    df = spark.createDataFrame(rows, "video string, frame int, low double, high double")
    got = fold.ordered_fold(df, "video", ["frame"], ["low", "high"], fold.hold_step(fold.ScaleGate()), fold.SCALE_FIELDS)
    assert sorted((r.video, r.frame, r.scale_min, r.status[:4]) for r in got.collect()) == [("a", 0, 1.0, "ACCE"), ("a", 1, 1.5, "ACCE"), ("a", 2, 1.5, "HOLD"), ("b", 0, None, "HOLD"), ("b", 1, 1.0, "ACCE")]
    assert fold.ordered_fold(df.limit(0), "video", ["frame"], ["low", "high"], fold.hold_step(fold.ScaleGate()), fold.SCALE_FIELDS).count() == 0


# --- pixels


def test_level_table_takes_the_hottest_row_on_ties():
    bar = np.repeat(np.array([200, 200, 100, 0], np.uint8)[:, None], 6, 1)
    t = pixels.level_table(bar, 0.0, 30.0, 0.2)
    assert t[200] == 30 and t[255] == 30 and t[100] == 10 and t[150] == 30 and t[0] == 0


def test_polygons_fill_their_edges():
    mask = pixels.fill_polygon([(2, 2), (6, 2), (6, 5), (2, 5)], 10, 10)
    assert mask.sum() == 20 and mask[2:6, 2:7].all()
    assert pixels.erode(mask, 1).sum() == 6
    assert pixels.erode(np.ones((4, 4), bool), 1).all()
    spans = polygon_spans([(2, 2), (6, 2), (6, 5), (2, 5)], 10, 10)
    assert spans == [(y, 2, 6) for y in range(2, 6)]
    assert pixels.dilate_disc(mask, 1).sum() > mask.sum()


def test_gray_and_neutral_agree_with_columns(spark):
    from caloris.operators.thermal import gray_level, is_neutral

    rng = np.random.default_rng(0)
    bgr = rng.integers(0, 256, (20, 1, 3)).astype(np.uint8)
    df = spark.createDataFrame([tuple(map(int, p[0])) for p in bgr], "b int, g int, r int")
    got = df.select(gray_level(*(F.col(c) for c in "bgr")).alias("y"), is_neutral(*(F.col(c) for c in "bgr"), 60).alias("n")).collect()
    assert [r.y for r in got] == pixels.gray(bgr)[:, 0].tolist() and [r.n for r in got] == pixels.neutral(bgr, 60)[:, 0].tolist()


def test_otsu_parts_two_levels():
    image = np.r_[np.full(50, 40), np.full(50, 200)].astype(np.uint8).reshape(10, 10)
    assert 40 <= pixels.otsu(image) < 200


@pytest.mark.parametrize("method", ["green_difference", "hsv_green", "green_channel_otsu", "gray_otsu", "gray_adaptive"])
def test_preparation_gives_dark_on_bright(method):
    crop = np.zeros((16, 30, 3), np.uint8)
    crop[5:11, 8:20, 1] = 200
    out = pixels.prepare(crop, method)
    assert out.shape == (16 * 5 + 48, 30 * 5 + 48) and out.mean() > 127
    with pytest.raises(ValueError):
        pixels.prepare(crop, "none")


def test_resizing_keeps_flat_pictures():
    flat = np.full((30, 50), 77, np.uint8)
    assert (pixels.shrink(flat, 20) == 77).all() and pixels.shrink(flat, 20).shape == (12, 20)
    assert (pixels.resize_cubic(flat, 60, 100) == 77).all()
    assert (pixels.equalise(flat) == pixels.equalise(flat)[0, 0]).all()
    assert not pixels.edges(flat).any() and pixels.edge_change(flat > 1, flat > 1, flat < 1) == 1.0
    assert (pixels.pan(flat, flat + 1, 0.5)[:, 25:] == 78).all()


def texture(height=120, width=160):
    rng = np.random.default_rng(5)
    return np.clip(pixels.gaussian(rng.integers(0, 256, (height, width)).astype(np.uint8), 7) * 2 - 128, 0, 255).astype(np.uint8)


def test_motion_is_recovered():
    image = texture()
    c, s = np.cos(np.radians(1.0)), np.sin(np.radians(1.0))
    cx, cy = 80, 60
    h = np.array([[c, s, (1 - c) * cx - s * cy + 4], [-s, c, s * cx + (1 - c) * cy - 3]])
    found = motion.estimate(image, pixels.warp(image, h))
    assert found.ratio > 0.6 and np.allclose(found.transform @ [cx, cy, 1], [cx + 4, cy - 3], atol=0.3)
    assert motion.estimate(np.zeros((60, 60), np.uint8), np.zeros((60, 60), np.uint8)).transform is None


def test_frames_to_temperatures(spark):
    S.register(spark)
    frames = spark.read.format("frames").option("frames", 5).option("frames_per_partition", 2).load()
    assert frames.rdd.getNumPartitions() == 3 and frames.count() == 5
    scaled = frames.withColumn("scale_min_temp", F.when(F.col("frame") != 3, F.lit(10.0))).withColumn("scale_max_temp", F.lit(50.0))
    regions = [{"id": 1, "name": "scene", "points": [(0, 0), (50, 0), (50, 47), (0, 47)]}]
    log = temperature_log(scaled, regions, {"x": 56, "y": 0, "w": 8, "h": 48}).orderBy("frame").collect()
    assert [r.valid_pixel_count > 0 for r in log] == [True, True, True, False, True]
    assert all(10 <= r.min_temp <= r.median_temp <= r.p95_temp <= r.p99_temp <= r.max_temp <= 50 for r in log if r.frame != 3)
    assert log[0].hotspot_x == 10 and log[2].hotspot_x == 12 and log[3].min_temp is None


def test_frame_stream(spark, tmp_path):
    S.register(spark)
    stream = spark.readStream.format("frames").option("frames", 9).option("frames_per_partition", 4).load().select("video_id", "frame")
    q = stream.writeStream.format("memory").queryName("frames_seen").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.frame for r in spark.table("frames_seen").collect()) == list(range(9))


def test_frame_ranges():
    assert S.frame_range(-3, None, None, 10) == (0, 9) and S.frame_range(2, 50, 3, 10) == (2, 4)
    for bad in ((10, None, None, 10), (5, 4, None, 10), (0, None, 0, 10)):
        with pytest.raises(ValueError):
            S.frame_range(*bad)


# --- datasets, provenance, files


def test_augmentations_fit_and_repeat(spark):
    from caloris.functions import geometry as G

    p = F.array(G.rectangle(F.lit(30), F.lit(30), F.lit(60), F.lit(50)))
    frames = spark.range(4).select(F.format_string("g%d", "id").alias("source_group"), F.lit(120).alias("width"), F.lit(100).alias("height"), p.alias("polygons"))
    made = D.augmentations(frames, D.DatasetOptions())
    assert made.count() == 12 and made.filter(~F.forall("polygons", lambda q: G.fits(q, F.lit(120), F.lit(100)))).count() == 0
    key = lambda d: sorted((r.source_group, r.augmentation, r.dx_pixels) for r in d.collect())
    assert key(made) == key(D.augmentations(frames.repartition(3), D.DatasetOptions()))
    edge = frames.withColumn("polygons", F.array(G.rectangle(F.lit(0), F.lit(0), F.lit(119), F.lit(99))))
    assert D.augmentations(edge, D.DatasetOptions()).count() == 4


def test_numbers_are_dense(spark):
    got = D.numbered(spark.range(100).repartition(7), ["id"], "n").orderBy("id").collect()
    assert [r.n for r in got] == list(range(1, 101))
    assert D.numbered(spark.range(0), ["id"], "n").count() == 0


def test_pan_lengths():
    assert sum(n for _, n in D.pan_timeline(24.31192660550459)) == 349
    assert sum(n for _, n in D.pan_timeline(24.679603433683955)) == 357


def test_canonical_hash_ignores_order():
    assert P.canonical_hash({"b": 1, "a": [1.5, "é"]}) == P.canonical_hash(json.loads('{"a":[1.5,"é"],"b":1}'))
    assert len(P.signature({})) == 16
    with pytest.raises(ValueError):
        P.canonical_hash(float("nan"))


def test_missing_files_and_settings(spark):
    required = spark.createDataFrame([("v", "a"), ("v", "b"), ("v", "c")], "video string, name string")
    present = spark.createDataFrame([("v", "a", 3), ("v", "b", 0)], "video string, name string, size_bytes int")
    assert sorted(r.name for r in P.missing_files(required, present, ["video"]).collect()) == ["b", "c"]
    own = spark.createDataFrame([("v", {"x": "2"}), ("w", None)], "video string, settings map<string,string>")
    got = {r.video: r.settings for r in P.resolved_settings({"x": "1", "y": "1"}, own, "video").collect()}
    assert got == {"v": {"x": "2", "y": "1"}, "w": {"x": "1", "y": "1"}}


def test_cached_scale_skips_bad_rows(spark, tmp_path):
    text = "frame,clean_min_temp_used,clean_max_temp_used,status\n0,1.0,9.0,A\n1,nan,9.0,A\n2,9.0,1.0,A\nx,1,2,A\n99,1,2,A\n0,2.0,8.0,A\n3,,4,A\n"
    (tmp_path / "r.csv").write_text(text)
    got = R.cached_scale(spark, str(tmp_path / "r.csv"), 10).collect()
    assert [(r.frame, r.scale_min, r.scale_max) for r in got] == [(0, 2.0, 8.0)]
    (tmp_path / "s.csv").write_text("frame\n1\n")
    with pytest.raises(ValueError):
        R.cached_scale(spark, str(tmp_path / "s.csv"), 10)


def test_regions_from_json(spark, tmp_path):
    doc = {"video": {"filename": "a.mp4", "width": 10, "height": 8}, "regions": [{"id": 1, "name": "R", "shape_type": "polygon", "pixel_points": [[1, 2], [3, 4], [5, 6]]}]}
    (tmp_path / "regions.json").write_text(json.dumps(doc))
    row = R.regions(spark, str(tmp_path / "regions.json")).first()
    assert row.region_name == "R" and [(p.x, p.y) for p in row.pixel_points] == [(1, 2), (3, 4), (5, 6)]


def test_sinks(spark, tmp_path):
    store.write_json(spark, {"a": 1}, str(tmp_path / "x.json"))
    store.write_json(spark, {"a": 2}, str(tmp_path / "x.json"))
    assert store.read_json(spark, str(tmp_path / "x.json")) == {"a": 2} and store.read_json(spark, str(tmp_path / "y.json")) is None
    store.write_json(spark, {"a": 1}, str(tmp_path / "x.json"))
    (tmp_path / "empty").write_text("")
    with pytest.raises(ValueError):
        store.replace_file(spark, str(tmp_path / "empty"), str(tmp_path / "x.json"))
    assert json.loads((tmp_path / "x.json").read_text()) == {"a": 1}
    for name in ("made", "target"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f").write_text(name)
    store.promote(spark, str(tmp_path / "made"), str(tmp_path / "target"))
    assert (tmp_path / "target/f").read_text() == "made" and not (tmp_path / "target.old").exists()
    with pytest.raises(ValueError):
        store.promote(spark, str(tmp_path / "none"), str(tmp_path / "target"))
    videos = spark.createDataFrame([("v", 10.0, 3)], "video_id string, fps double, total_frames int")
    log = spark.createDataFrame([("v", 1, "TRACKED", 1.0, 0.0, 2.0, 0.0, 1.0, 0.0)], "video_id string, frame int, status string, h00 double, h01 double, h02 double, h10 double, h11 double, h12 double")
    got = store.complete_log(videos, log).orderBy("frame").collect()
    assert [r.status for r in got] == ["MISSING", "TRACKED", "MISSING"] and got[0].h00 == 1 and got[1].h02 == 2 and got[2].timestamp_seconds == 0.2
    store.write_csv(spark.createDataFrame([(1, True, None)], "a int, b boolean, c string").coalesce(1), str(tmp_path / "csv"))
    assert [r.value for r in spark.read.text(str(tmp_path / "csv")).collect()] == ["a,b,c", "1,1,"]


def test_discovery(spark, tmp_path):
    from caloris.sources import discovery

    for name in ("b.MP4", "A.mp4", "x.txt"):
        (tmp_path / name).write_text("x")
    found = discovery.files(spark, str(tmp_path))
    assert [r.filename for r in found.collect()] == ["A.mp4", "b.MP4"]
    got = discovery.by_name(spark.createDataFrame([("a.MP4",), ("z.mp4",)], "filename string"), found).collect()
    assert {r.filename: r.matches for r in got} == {"a.MP4": 1, "z.mp4": None}


def test_schema_types_of_fold_fields():
    assert all(isinstance(f, T.StructField) for f in fold.SCALE_FIELDS + fold.SCENE_FIELDS + fold.TRACK_FIELDS + fold.VIEW_FIELDS)


def test_canonical_hashes_of_a_column(spark):
    df = spark.createDataFrame([('{"b":1,"a":2}',), ('{"a":2, "b":1}',), ("{",), (None,)], "j string")
    got = [r.h for r in df.select(P.canonical_hashes(F.col("j")).alias("h")).collect()]
    assert got == [P.canonical_hash({"a": 2, "b": 1})] * 2 + [None, None]


def test_upstream_warnings(spark):
    used = spark.createDataFrame([("s3", "a", "1"), ("s3", "b", "2"), ("s3", "c", "3")], "stage string, input string, sha256 string")
    current = spark.createDataFrame([("a", "1"), ("b", "9")], "input string, sha256 string")
    assert sorted((r.input, r.warning) for r in P.upstream_warnings(used, current).collect()) == [("b", "CHANGED"), ("c", "MISSING")]


def test_latest_and_rate_limited(spark, tmp_path):
    from caloris.streaming.fold import latest_only, rate_limited

    rows = spark.createDataFrame([("v", i, i / 10) for i in range(10)] + [("w", 3, 0.3)], "video_id string, frame int, s double")
    seen = []
    latest_only(lambda df, n: seen.extend((r.video_id, r.frame) for r in df.collect()))(rows, 0)
    assert sorted(seen) == [("v", 9), ("w", 3)]
    rows.withColumn("at", F.timestamp_seconds("s")).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("video_id string, frame int, s double, at timestamp").parquet(str(tmp_path / "in"))
    q = rate_limited(stream, "at", 2.0, "video_id").writeStream.format("memory").queryName("limited").option("checkpointLocation", str(tmp_path / "ck")).outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.video_id, r.frame) for r in spark.table("limited").collect()) == [("v", 4), ("v", 9), ("w", 3)]
