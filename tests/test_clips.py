"""Whole chains over pictures: tracking, scenes, scale labels, live cameras; and pixel kernels on pictures with structure."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from caloris.functions import text as X
from caloris.operators import dataset as D
from caloris.operators import fold
from caloris.operators import matching as M
from caloris.operators import motion as log
from caloris.operators import readings as R
from caloris.operators import provenance as P
from caloris.operators import statistics as S
from caloris.operators.kernels import features, motion, pixels
from caloris.operators.simulate import moved, seen, switched, turned
from caloris.sources import frames as source
from caloris.sources import readers, store
from caloris.sources import readings as files


def clip(spark, **options):
    source.register(spark)
    return spark.read.format("frames").options(**{"width": "160", "height": "120", "texture": "5", "frames_per_partition": "1000", **{k: str(v) for k, v in options.items()}}).load()


# --- tracking


def test_a_bumped_camera_is_tracked(spark):
    frames = moved(clip(spark, frames=7), 6.0, -3.0, 1.0, 1.0, 2, 3)
    rows = log.motion_log(frames, [], grouped=True).orderBy("frame").collect()
    assert len(rows[0]) == 20 and [r.status for r in rows] == ["REFERENCE"] + ["TRACKED"] * 6
    assert all(r.method == "LK_OPTICAL_FLOW" and r.reason == "LK_ACCEPTED" and r.inlier_ratio > 0.45 for r in rows[1:])
    end = rows[-1]
    assert abs(end.camera_dx_pixels - 6) < 0.5 and abs(end.camera_dy_pixels + 3) < 0.5 and abs(abs(end.camera_rotation_deg) - 1) < 0.3 and abs(rows[1].camera_translation_pixels) < 0.2
    again = log.motion_log(frames.repartition(3), [], grouped=False).orderBy("frame").collect()
    assert [r.status for r in again] == [r.status for r in rows]
    late = log.motion_log(frames, [], reference_frame=3, grouped=True).orderBy("frame").collect()
    assert [r.status for r in late][:4] == ["BEFORE_REFERENCE"] * 3 + ["REFERENCE"] and late[0].camera_scale == 1


def test_borders_do_not_scale_a_shifted_frame():
    scene = np.kron(np.random.default_rng(3).normal(110, 45, (46, 56)), np.ones((4, 4))).clip(0, 255).astype(np.uint8)
    for x, y in ((6, 0), (0, -5), (-6, 4), (3, 3)):
        a, b = (pixels.equalise(scene[32 + v : 152 + v, 32 + u : 192 + u]) for u, v in ((0, 0), (x, y)))
        found = motion.metrics(motion.estimate(a, b).transform, 160, 120)
        assert abs(found["scale"] - 1) < 4e-4 and abs(found["dx"] + x) < 0.02 and abs(found["dy"] + y) < 0.02 and abs(found["rotation_deg"]) < 0.02


def test_points_without_a_counterpart_have_no_small_error():
    a = np.kron(np.random.default_rng(4).normal(110, 45, (30, 40)), np.ones((4, 4))).clip(0, 255)
    points = motion.corners(a, None, 200)
    _, error = motion.track(a, np.full_like(a, 250), points)
    assert len(points) > 100 and (error > 20).all()
    none, error = motion.track(a, a, np.zeros((0, 2)))
    assert none.shape == (0, 2) and error.shape == (0,)


def test_places_are_seen(spark):
    rows = [("v", 0, 3, 0, 0, False), ("v", 1, 3, 5, 0, False), ("v", 2, 3, 99, 0, True), ("v", 3, 3, None, 0, False), ("w", 0, 4, -40, 40, False), (None, 0, 4, 0, 0, False)]
    places = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "video_id string, frame int, scene int, x int, y int, dark boolean, bgr int")
    got = {(r.video_id, r.frame): np.frombuffer(r.bgr, np.uint8).reshape(r.height, r.width, 3) for r in seen(places, 48, 32, 10.0).collect()}
    assert set(got) == {("v", 0), ("v", 1), ("v", 2), ("w", 0)}
    assert (got["v", 0][:, 5:] == got["v", 1][:, :-5]).all() and got["v", 2].max() == 0 and got["w", 0].std() > 10
    assert seen(places.limit(0)).count() == 0


def test_a_lost_camera_holds_and_is_suspected(spark):
    frames = clip(spark, frames=8).withColumn("bgr", F.when(F.col("frame") < 4, F.col("bgr")).otherwise(F.lit(b"\xff" * (160 * 120 * 3))))
    options = M.TrackingOptions(warn_after=3)
    rows = log.motion_log(frames, [{"points": [{"x": 40, "y": 30}, {"x": 120, "y": 30}, {"x": 80, "y": 90}]}], options=options).orderBy("frame").collect()
    assert [r.status for r in rows[4:]] == ["HOLD_LAST_GOOD"] * 2 + ["SCENE_CHANGE_SUSPECTED"] * 2
    assert all(r.reason.startswith("TRACKING_FAILED:LK=") and ";ORB=" in r.reason and r.matched_points == 0 for r in rows[4:])


def test_rejections_are_those_of_the_column(spark):
    o = M.TrackingOptions()
    still = {"translation": 0.0, "rotation_deg": 0.0, "scale": 1.0}
    rows = [(True, 20, 15, 0.75, still, still), (False, 0, 0, 0.0, still, still), (True, 0, 0, 0.0, still, still), (True, 20, 11, 0.55, still, still), (True, 50, 15, 0.3, still, still)]
    rows += [(True, 20, 15, 0.75, {**still, k: v}, still) for k, v in (("translation", 101.0), ("rotation_deg", -6.0), ("scale", 0.9))]
    rows += [(True, 20, 15, 0.75, still, {**still, k: v}) for k, v in (("translation", 221.0), ("rotation_deg", 11.0), ("scale", 1.2))]
    shape = "struct<translation double, rotation_deg double, scale double>".replace(" double", ":double")
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, found boolean, matches int, inliers int, ratio double, delta {shape}, total {shape}")
    want = [r.v for r in df.select("i", M.verdict(o).alias("v")).orderBy("i").collect()]
    assert want == [M.rejection(m, n, r, d if f else None, t if f else None, o) for f, m, n, r, d, t in rows] and want[0] == "OK" and len(set(want)) == 11


def test_features_find_a_turned_picture():
    picture = np.clip(pixels.gaussian(np.random.default_rng(5).integers(0, 256, (160, 200)).astype(np.uint8), 7) * 2 - 128, 0, 255).astype(np.uint8)
    h = turned(9, -5, 4, 1.0, 200, 160)
    m = features.matched_motion(features.describe(picture, None, 600), features.describe(pixels.warp(picture, h), None, 600))
    assert m.ratio > 0.5 and np.allclose(m.transform @ [100, 80, 1], h @ [100, 80, 1], atol=1.0)
    other = np.random.default_rng(9).integers(0, 256, (160, 200)).astype(np.uint8)
    assert features.matched_motion(features.describe(picture, None, 600), features.describe(other, None, 600)).inliers < 12
    assert features.describe(np.zeros((60, 60), np.uint8), None, 100)[1].shape == (0, 4)


def test_robust_fit_passes_over_wrong_pairs():
    rng = np.random.default_rng(1)
    a = rng.uniform(0, 100, (60, 2))
    h = turned(3, 4, 2, 1.05, 100, 100)
    b = a @ h[:, :2].T + h[:, 2]
    b[:25] = rng.uniform(0, 100, (25, 2))
    found, near = motion.robust_similarity(a, b)
    assert np.allclose(found, h, atol=1e-6) and near[25:].all()


# --- scenes


def test_a_camera_that_turns_away_and_back(spark):
    a, b = clip(spark, frames=60), clip(spark, frames=60, texture=6)
    states, events = log.scene_log(switched(a, b, D.pan_timeline(1.0, 26, 6), 25.0))
    rows = states.orderBy("frame").collect()
    assert len(rows) == 90 and len(rows[0]) == 15 and rows[0].event == "INITIAL_VIEW" and rows[0].state == "STABLE" and rows[0].view_name == "VIEW_001"
    found = [(r.event, r.previous_view, r.current_view) for r in events.orderBy("frame").collect()]
    assert found == [("MOVEMENT_STARTED", "VIEW_001", "VIEW_001"), ("NEW_STABLE_VIEW", "VIEW_001", "VIEW_002"), ("MOVEMENT_STARTED", "VIEW_002", "VIEW_002"), ("RETURN_TO_KNOWN_VIEW", "VIEW_002", "VIEW_001")]
    last = events.orderBy(F.desc("frame")).first()
    assert last.matched_known_view == "VIEW_001" and last.scene_score == pytest.approx(last.scene_inliers * last.scene_inlier_ratio)
    assert {r.state for r in rows} == {"STABLE", "MOVING", "NEW_STABLE_VIEW"} and rows[-1].view_id == 1


def test_evidence_without_a_transform(spark):
    df = spark.createDataFrame([(False, 0.0, 0.0, 0, 0.0, e) for e in (0.05, 0.08, 0.11)] + [(True, 9.0, 0.0, 3, 0.9, 0.11), (True, 0.1, 0.0, 30, 0.9, 0.01)], "found boolean, translation double, rotation_deg double, inliers int, ratio double, edge_change double")
    got = [(r.e.moving, r.e.stable) for r in df.select(M.frame_evidence(M.SceneOptions()).alias("e")).collect()]
    assert got == [(False, True), (False, False), (True, False), (False, False), (False, True)]


# --- scale labels


def test_labels_are_read_from_pictures(spark):
    frames = clip(spark, frames=3, low="15.6", high="-46.9", texture=3)
    boxes = {"MIN": {"x": 4, "y": 90, "w": 100, "h": 26}, "MAX": {"x": 4, "y": 4, "w": 100, "h": 26}}
    found = R.label_candidates(frames, boxes, [("green_difference", 7), ("gray_otsu", 7), ("green_difference", 7)], "glyphs").collect()
    assert len(found) == 3 * 2 * 2
    assert {(r.label, r.value) for r in found if r.is_primary} == {("MIN", 15.6), ("MAX", -46.9)}
    with pytest.raises(ValueError, match="unknown reader"):
        R.label_candidates(frames, boxes, [("hsv_green", 7)], "none")
    with pytest.raises(ValueError, match="unknown method"):
        R.label_candidates(frames, boxes, [("none", 7)], "glyphs")


def test_every_glyph_is_read_back():
    image = np.full((40, 400, 3), 20, np.uint8)
    readers.draw(image, 8, 8, "0123456789.-")
    assert readers.reader("glyphs").read(pixels.prepare(image, "green_difference"), 7)[0][0] == "0123456789.-"


def test_retries_are_asked_for_where_needed(spark):
    """Frame 2 reads a spike, its retry is right; from frame 4 on the level has moved and only retries reach it, one of which fails."""
    label = lambda f, name, value, k=0: ("v", f, name, k, f"m{k}", 7, str(value), 1.0, k == 0, value)
    own = {0: (10.0, 40.0), 2: (400.0, 40.0), 4: (None, 41.0), 6: (12.0, 42.0), 8: (99.0, 98.0)}
    schema = f"{R.CANDIDATE_SCHEMA}, value double"
    primary = spark.createDataFrame([label(f, n, v) for f, pair in own.items() for n, v in zip(("MIN", "MAX"), pair)], schema)
    asked = []

    def retry(needed):
        frames = sorted(r.frame for r in needed.collect())
        asked.append(frames)
        better = {2: 10.5, 4: 11.0}
        rows = [label(f, n, v) for f in frames for n, v in zip(("MIN", "MAX"), own[f])] + [label(f, "MIN", better[f], 1) for f in frames if f in better]
        return spark.createDataFrame(rows, schema)

    frames = spark.range(10).select(F.lit("v").alias("video_id"), F.col("id").cast("int").alias("frame"), (F.col("id") / 10.0).alias("timestamp_seconds"))
    rows = R.scale_readings(frames, primary, retry, fold.ScaleGate()).orderBy("frame").collect()
    assert len(rows[0]) == 18 and [r.status for r in rows[::2]] == ["ACCEPT_PRIMARY", "ACCEPT_RETRY", "ACCEPT_RETRY", "ACCEPT_PRIMARY", "HOLD_PREVIOUS"] and {r.status for r in rows[1::2]} == {"UNSAMPLED"}
    assert [r.clean_min_temp_used for r in rows] == [10.0, 10.0, 10.5, 10.5, 11.0, 11.0, 12.0, 12.0, 12.0, 12.0] and rows[2].accepted_min_method == "m1/PSM7"
    assert sorted(sum(asked, [])) == [2, 4, 8] and [r.retry_attempted for r in rows[::2]] == [0, 1, 1, 0, 1]
    lost = spark.createDataFrame([label(0, "MIN", None), label(0, "MAX", 5.0)], schema)
    with pytest.raises(Exception, match="no trustworthy scale"):
        R.scale_readings(frames.limit(1), lost, lambda needed: lost, fold.ScaleGate()).collect()


# --- streams


def test_a_frame_stream_goes_on_after_a_restart(spark, tmp_path):
    """A query that is stopped and started again reads what the video has grown by, and nothing twice."""
    source.register(spark)
    for frames in (7, 7, 23):
        stream = spark.readStream.format("frames").option("frames", frames).option("frames_per_partition", 5).load().select("frame")
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).start()
        q.processAllAvailable()
        q.stop()
        assert sorted(r.frame for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(frames))


def test_live_cameras_reconnect(spark, tmp_path):
    source.register(spark)
    stream = spark.readStream.format("cameras").options(cameras="one,two", down="two", fail_every="3", reconnect_seconds="0", ticks_per_second="1000").load()
    shown = stream.select("video_id", "frame", F.length("bgr").alias("size"), "status", source.frame_age(F.col("received_at")).alias("age"))
    q = shown.writeStream.format("memory").queryName("live").option("checkpointLocation", str(tmp_path / "ck")).start()
    while len([p for p in q.recentProgress if p.numInputRows]) < 8:
        pass
    q.stop()
    rows = spark.table("live").collect()
    assert {r.status for r in rows if r.video_id == "two"} == {"RECONNECTING"} and "CONNECTED" in {r.status for r in rows if r.video_id == "one"}
    assert all(r.age >= 0 and (r.size == 64 * 48 * 3) == (r.status == "CONNECTED") for r in rows)


# --- pictures with structure


def test_threshold_methods_smooth_first():
    """A single bright pixel in a dark crop: a 3 x 3 smoothing spreads it before the levels are parted."""
    crop = np.full((9, 9, 3), 10, np.uint8)
    crop[4, 4] = 250
    for method in ("gray_otsu", "green_channel_otsu"):
        out = pixels.prepare(crop, method)[24:-24, 24:-24]
        assert out[22, 22] < 128 and out[17, 22] < 128 and out[5, 5] > 128
    assert pixels._smooth(crop[..., 1])[4, 4] == round(10 + 240 * 0.25) and pixels._smooth(crop[..., 1])[3, 4] == round(10 + 240 * 0.125)


def test_shrinking_takes_means_and_cubic_goes_through_flat_parts():
    image = np.array([[0, 100, 200, 40], [20, 80, 240, 120]], np.uint8)
    assert pixels.shrink(image, 2).tolist() == [[50, 150]]
    step = np.repeat(np.array([[0, 0, 0, 200, 200, 200]], np.uint8), 4, 0)
    wide = pixels.resize_cubic(step, 4, 24)
    assert (wide[:, :4] == 0).all() and (wide[:, -4:] == 200).all() and (np.diff(wide[0, 8:16].astype(int)) >= 0).all() and wide[0, 12] > 100 > wide[0, 11]


def test_equalising_widens_a_narrow_range():
    image = (100 + np.arange(64)[None, :] % 8 + np.arange(64)[:, None] % 4).astype(np.uint8)
    out = pixels.equalise(image, clip=40.0)
    assert np.ptp(out) > 3 * np.ptp(image)
    order = np.argsort(image[:8, :8].ravel(), kind="stable")
    assert (np.diff(out[:8, :8].ravel()[order].astype(int)[image[:8, :8].ravel()[order].argsort(kind="stable")]) >= -1).all()


def test_edges_follow_a_square():
    image = np.zeros((40, 40), np.uint8)
    image[10:30, 10:30] = 200
    lines = pixels.edges(image)
    inner = np.zeros_like(lines)
    inner[13:27, 13:27] = True
    assert not lines[inner].any() and not lines[:7].any() and lines[9:12, 15:25].any(0).all() and lines[15:25, 28:31].any(1).all()
    shifted = pixels.edges(np.roll(image, 6, 1))
    assert pixels.edge_change(lines, lines, np.ones_like(lines)) == 0 and pixels.edge_change(lines, shifted, np.ones_like(lines)) > 0.05


def test_masks_for_tracking_and_analysis():
    mask = pixels.tracking_mask([[(10, 10), (20, 10), (20, 20), (10, 20)]], 40, 40, 5)
    assert mask[15, 5] and mask[15, 25] and not mask[15, 4] and not mask[5, 5] and mask[6, 12]
    bgr = np.full((40, 40, 3), 90, np.uint8)
    bgr[20:24, 20:24, 1] = 200
    found = pixels.analysis_mask(bgr, (0.1, 0.05, 0.05, 0.1), 25)
    assert not found[:4].any() and not found[38:].any() and not found[:, :2].any() and not found[:, 36:].any() and not found[21, 21] and found[10, 10]
    assert pixels.crop_padded(bgr, {"x": 1, "y": 2, "w": 5, "h": 5}, 3).shape == (10, 9, 3)


# --- small things


def test_times_probes_and_presets(spark, tmp_path):
    assert len(spark.range(1).select(X.now_utc().alias("t")).first().t) == 25
    df = spark.createDataFrame([(5, 5, 3), (-1, 5, 3), (50, 5, 3), (12, 12, 3), (5, 5, 0), (5, 5, None)], "x int, y int, n int")
    box = F.struct(F.lit(10).alias("x"), F.lit(10).alias("y"), F.lit(5).alias("w"), F.lit(5).alias("h"))
    got = [r.r for r in df.select(S.probe_reason(F.col("x"), F.col("y"), F.lit(50), F.lit(40), [box, F.lit(None).cast("struct<x:int,y:int,w:int,h:int>")], F.col("n")).alias("r")).collect()]
    assert got == [None, "OUTSIDE FRAME", "OUTSIDE FRAME", "THERMAL SCALE / UI", "NO VALID THERMAL PIXELS", "NO VALID THERMAL PIXELS"]
    built = []
    build = lambda: built.append(1) or {"scale": {"x": 1}}
    path = str(tmp_path / "preset.json")
    assert files.preset(spark, path, build) == files.preset(spark, path, build) == {"scale": {"x": 1}} and len(built) == 1
    names = spark.createDataFrame([("My  Cam #1",), ("..",)], "n string").select(X.preset_name(F.col("n")).alias("p"), X.frame_time(F.lit(50), F.lit(25.0)).alias("t")).collect()
    assert names[0].p == "My_Cam_1" and names[1].p == "preset" and names[0].t == 2.0


def test_manifests_and_ledgers(spark, tmp_path):
    made = P.manifest("motion", {"path": "v.mp4"}, {"regions": "abc"}, {"margin": "80"}, {"log": "motion_log.csv"}, "2024-01-01T00:00:00+00:00")
    store.write_json(spark, made, str(tmp_path / "m/stage.json"))
    row = P.load_manifests(spark, str(tmp_path / "m")).first()
    assert row.stage == "motion" and row.inputs == {"regions": "abc"} and row.status == "COMPLETE"
    current = spark.createDataFrame([("motion", "regions", "new")], "stage string, name string, sha256 string")
    asked = spark.createDataFrame([("motion", "margin", "80"), ("motion", "corners", "900")], "stage string, setting string, value string")
    got = {(r.reason, r.name) for r in P.stale_reasons(P.load_manifests(spark, str(tmp_path / "m")), current, asked).collect()}
    assert got == {("INPUT_CHANGED", "regions"), ("SETTING_CHANGED", "corners")}
    ledger = {"manifest_version": 1, "generator": "g", "variants": [{"id": 1, "signature": "s", "output_filename": "o.mp4", "parameters": {"dx": "20"}}]}
    store.write_json(spark, ledger, str(tmp_path / "l/transformations.json"))
    assert P.load_ledger(spark, str(tmp_path / "l")).first().parameters == {"dx": "20"}
    (tmp_path / "a.bin").write_bytes(b"abc")
    prints = P.fingerprints(spark.read.format("binaryFile").load(str(tmp_path / "a.bin")))
    both = prints.select(P.same_content(F.struct("sha256", "size_bytes", "mtime_us"), F.struct("sha256", "size_bytes", "mtime_us")).alias("same"), "filename", "size_bytes").first()
    assert both.same and both.filename == "a.bin" and both.size_bytes == 3


# --- long videos in many tasks


def test_scenes_of_a_table_of_videos(spark):
    """Ranges of seven frames, each read with the frame before it, give the logs of frames taken in order; no picture is shuffled."""
    source.register(spark)
    options = {"width": "160", "height": "120", "texture": "5", "frames": "20"}
    videos = spark.createDataFrame([("one", "x", 20), ("two", "y", 9), ("none", "z", 0)], "video_id string, path string, total_frames int")
    frames = source.frames_of(videos, options, 1000)
    rules = M.SceneOptions(moving_frames=1, stable_frames=4)
    want, want_events = log.scene_log(frames, rules)
    got, events = log.scene_log_of(videos, rules, options, 7)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 29
    assert sorted(map(tuple, events.collect())) == sorted(map(tuple, want_events.collect()))
    moved_in_ranges = log.frame_motion_of(videos, rules, options, 7)
    assert moved_in_ranges.filter("first").select("video_id", "frame").collect() != [] and moved_in_ranges.filter("first").count() == 2
    assert "bgr" not in moved_in_ranges._jdf.queryExecution().executedPlan().toString()


def test_retry_rounds_are_bounded(spark):
    """A clip in which each accepted retry puts the next frame in doubt: as many rounds as allowed, then one for the rest; the same log."""
    asked = []

    def label(f, n, v, k=0):
        return ("v", f, n, k, "m", 7 + k, "1.0", 0.9, k == 0, v)

    schema = "video_id string, frame int, label string, ord int, method string, psm int, text string, confidence double, is_primary boolean, value double"
    own = {f: (10.0 + 2 * max(0, f - 1) - (6.0 if f > 1 else 0.0), 60.0) for f in range(12)}
    better = {f: 10.0 + 2 * (f - 1) for f in range(2, 12)}
    primary = spark.createDataFrame([label(f, n, v) for f, pair in own.items() for n, v in zip(("MIN", "MAX"), pair)], schema)

    def retry(needed):
        frames = sorted(r.frame for r in needed.collect())
        asked.append(frames)
        return spark.createDataFrame([label(f, n, v) for f in frames for n, v in zip(("MIN", "MAX"), own[f])] + [label(f, "MIN", better[f], 1) for f in frames if f in better], schema)

    frames = spark.range(12).select(F.lit("v").alias("video_id"), F.col("id").cast("int").alias("frame"), (F.col("id") / 10.0).alias("timestamp_seconds"))
    gate = fold.ScaleGate(max_jump=3.0)
    free = R.scale_readings(frames, primary, retry, gate, rounds=100).orderBy("frame").collect()
    exact, asked[:] = list(asked), []
    bounded = R.scale_readings(frames, primary, retry, gate, rounds=1).orderBy("frame").collect()
    assert bounded == free and len(asked) <= 2 and len(exact) >= len(asked)


def test_rounds_run_over_open_videos_only(spark, monkeypatch):
    """Of three videos one asks twice, one once and one never: the fold's runs see three, two and one of them; the texts are flat."""
    seen, run = [], fold.ordered_fold

    def counted(df, *args, **kwargs):
        seen.append((sorted(r.video_id for r in df.select("video_id").distinct().collect()), "own" in df.columns))
        return run(df, *args, **kwargs)

    monkeypatch.setattr(fold, "ordered_fold", counted)
    label = lambda v, f, name, value, k=0: (v, f, name, k, f"m{k}", 7, str(value), 1.0, k == 0, value)
    own = {("a", 0): (10.0, 40.0), ("a", 2): (None, 40.0), ("a", 4): (12.0, 40.0), ("b", 0): (10.0, 40.0), ("b", 2): (None, 40.0), ("c", 0): (20.0, 50.0), ("c", 2): (21.0, 50.0)}
    schema = f"{R.CANDIDATE_SCHEMA}, value double"
    labels = lambda keys: [label(v, f, n, x) for v, f in keys for n, x in zip(("MIN", "MAX"), own[v, f])]
    better = {("a", 2): 8.0, ("a", 4): 9.0}

    def retry(needed):
        keys = [(r.video_id, r.frame) for r in needed.collect()]
        return spark.createDataFrame(labels(keys) + [label(v, f, "MIN", better[v, f], 1) for v, f in keys if (v, f) in better], schema)

    frames = spark.createDataFrame([(v, f, f / 10.0) for v, f in own], "video_id string, frame int, timestamp_seconds double")
    rows = R.scale_readings(frames, spark.createDataFrame(labels(own), schema), retry, fold.ScaleGate()).orderBy("video_id", "frame").collect()
    assert [(r.video_id, r.frame, r.status, r.clean_min_temp_used, r.accepted_min_text, r.accepted_min_method) for r in rows] == [
        ("a", 0, "ACCEPT_PRIMARY", 10.0, "10.0", "m0/PSM7"), ("a", 2, "ACCEPT_RETRY", 8.0, "8.0", "m1/PSM7"), ("a", 4, "ACCEPT_RETRY", 9.0, "9.0", "m1/PSM7"),
        ("b", 0, "ACCEPT_PRIMARY", 10.0, "10.0", "m0/PSM7"), ("b", 2, "HOLD_PREVIOUS", 10.0, None, None),
        ("c", 0, "ACCEPT_PRIMARY", 20.0, "20.0", "m0/PSM7"), ("c", 2, "ACCEPT_PRIMARY", 21.0, "21.0", "m0/PSM7"),
    ]
    assert seen == [(["a", "b", "c"], False), (["a", "b"], False), (["a"], False)]
