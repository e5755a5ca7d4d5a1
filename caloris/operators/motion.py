"""Camera motion and scene states over frames: the logs that recorded video gives.

A frame is compared with the one before it (scenes), or with the last one that could be trusted (camera motion). Scenes of a table of
videos (`scene_log_of`) are made in ranges of frames, each read with the frame before it where it is needed, so one long video is the work
of many tasks and no pixel is moved. Of frames that come as a table (`frame_motion`, `motion_log`) a video's are taken in order by one
task that keeps a gray picture or two, as camera motion must be: give them with one partition a video (option frames_per_partition) and
grouped=True; otherwise Spark moves the pictures to bring a video together. Only numbers and corner descriptions leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caloris.sources import frames as source
from caloris.sources.store import stored

from . import fold
from .kernels import features, motion
from .kernels import pixels as K
from .matching import SceneOptions, TrackingOptions, frame_evidence, rejection
from .scan import SceneScan, ViewScan, block_fold

IMAGE = ["timestamp_seconds", "width", "height", "bgr"]
_long, _double, _int, _string, _bool = T.LongType(), T.DoubleType(), T.IntegerType(), T.StringType(), T.BooleanType()
MOTION_FIELDS = [
    T.StructField(name, kind)
    for name, kind in (
        ("status", _string), ("method", _string), ("matched_points", _int), ("inlier_count", _int), ("inlier_ratio", _double), ("reason", _string),
        ("camera_dx_pixels", _double), ("camera_dy_pixels", _double), ("camera_translation_pixels", _double), ("camera_rotation_deg", _double),
        ("camera_scale", _double), ("H00", _double), ("H01", _double), ("H02", _double), ("H10", _double), ("H11", _double), ("H12", _double),
    )
]
FRAME_FIELDS = [
    T.StructField(name, kind)
    for name, kind in (("first", _bool), ("found", _bool), ("translation", _double), ("rotation_deg", _double), ("scale", _double), ("inliers", _int), ("ratio", _double), ("edge_change", _double))
]
VIEW_FIELDS = [
    T.StructField(name, kind)
    for name, kind in (("view_id", _int), ("view_event", _string), ("scene_good_matches", _int), ("scene_inliers", _int), ("scene_inlier_ratio", _double), ("scene_score", _double))
]
_STILL = np.eye(2, 3)


def _image(row: dict) -> np.ndarray:
    return np.frombuffer(row["bgr"], np.uint8).reshape(row["height"], row["width"], 3)


def _product(outer: np.ndarray, inner: np.ndarray) -> np.ndarray:
    return np.c_[outer[:, :2] @ inner[:, :2], outer[:, :2] @ inner[:, 2] + outer[:, 2]]


def motion_step(regions: list[dict], reference_frame: int, o: TrackingOptions):
    """Track the camera from the reference frame on: corners first, binary features where their transform is rejected; a frame that is
    accepted becomes the next anchor, others hold the last transform."""

    def logged(row: dict, status: str, method: str, m: motion.Motion | None, ratio: float, reason: str, h: np.ndarray) -> tuple:
        x = motion.metrics(h, row["width"], row["height"])
        return (status, method, m.matches if m else 0, m.inliers if m else 0, ratio, reason, x["dx"], x["dy"], x["translation"], x["rotation_deg"], x["scale"], *map(float, h.ravel()))

    def step(state: tuple | None, row: dict) -> tuple[tuple | None, tuple]:
        if row["frame"] < reference_frame:
            return None, logged(row, "BEFORE_REFERENCE", "NONE", None, 0.0, "BEFORE_REFERENCE", _STILL)
        now = K.equalise(K.gray(_image(row)))
        if state is None:
            return (now, _STILL, 0), logged(row, "REFERENCE", "REFERENCE", None, 1.0, "REFERENCE", _STILL)
        anchor, held, failures = state
        corners = np.array([[p["x"], p["y"]] for r in regions for p in r["points"]], float).reshape(-1, 2) @ held[:, :2].T + held[:, 2]
        sizes = np.cumsum([0, *(len(r["points"]) for r in regions)])
        mask = K.tracking_mask([corners[a:b].tolist() for a, b in zip(sizes, sizes[1:])], row["height"], row["width"], o.margin) if regions else None
        reasons = []
        for method in ("LK_OPTICAL_FLOW", "ORB_FALLBACK"):
            if method == "LK_OPTICAL_FLOW":
                m = motion.estimate(anchor, now, mask, o.corners, o.worst_error, o.least_points)
            else:
                mine = features.describe(now, mask, o.features)
                m = features.matched_motion(features.describe(anchor, mask, o.features), mine) if len(mine[0]) else motion.Motion(None, 0, 0)
            h = None if m.transform is None else _product(m.transform, held)
            size = (row["width"], row["height"])
            why = rejection(m.matches, m.inliers, m.ratio, None if h is None else motion.metrics(m.transform, *size), None if h is None else motion.metrics(h, *size), o)
            reasons.append(why)
            if why == "OK":
                reason = "LK_ACCEPTED" if len(reasons) == 1 else f"ORB_RECOVERY_AFTER_{reasons[0]}"
                return (now, h, 0), logged(row, "TRACKED", method, m, m.ratio, reason, h)
        failures += 1
        status = "SCENE_CHANGE_SUSPECTED" if failures >= o.warn_after else "HOLD_LAST_GOOD"
        return (anchor, held, failures), logged(row, status, "NONE", None, 0.0, "TRACKING_FAILED:LK={};ORB={}".format(*reasons), held)

    return step


def motion_log(frames: DataFrame, regions: list[dict], reference_frame: int = 0, options: TrackingOptions | None = None, grouped: bool = False) -> DataFrame:
    """video_id and the 19 columns of a motion log, a row a frame: what moved the camera since the reference frame.

    regions: the points around which motion is looked for, of one video; none: the whole picture.
    """
    step = motion_step(regions, reference_frame, options or TrackingOptions())
    return fold.ordered_fold(frames, "video_id", ["frame"], ["frame", *IMAGE], step, MOTION_FIELDS, keep=["timestamp_seconds"], grouped=grouped)


def _analysed(row: dict, o: SceneOptions) -> tuple[np.ndarray, np.ndarray, float]:
    """A gray picture of the analysis width, smoothed, its mask, and its scale."""
    small = K.shrink(_image(row), o.width)
    gray = np.rint(K.gaussian(K.equalise(K.gray(small)), 5)).astype(np.uint8)
    return gray, K.analysis_mask(small, o.ignore, o.channel_difference), small.shape[1] / row["width"]


def _frame_step(o: SceneOptions):
    """State: gray picture, mask and lines of the frame before, the frame itself, and what a frame like it gives (None: not known yet)."""

    def step(state: tuple | None, row: dict) -> tuple[tuple, tuple]:
        size = (row["width"], row["height"])
        if state is None or state[3] != (size, row["bgr"]):
            (gray, mask, scale), own = _analysed(row, o), (size, row["bgr"])
            made, values = compared(None if state is None else state[:3], gray, mask, K.edges(gray, mask), scale)
            return (*made, own, None), values
        # a picture that is repeated is compared with itself once, however often it comes
        values = state[4] or compared(state[:3], *state[:3], 1.0)[1]
        return (*state[:4], values), values

    def compared(state: tuple | None, gray: np.ndarray, mask: np.ndarray, lines: np.ndarray, scale: float) -> tuple[tuple, tuple]:
        if state is None:
            return (gray, mask, lines), (True, True, 0.0, 0.0, 1.0, 0, 1.0, 0.0)
        common = state[1] & mask
        m = motion.estimate(state[0], gray, common, o.corners, o.worst_error, o.least_points)
        change = K.edge_change(state[2], lines, common)
        if m.transform is None:
            return (gray, mask, lines), (False, False, 0.0, 0.0, 1.0, 0, 0.0, change)
        x = motion.metrics(m.transform, gray.shape[1], gray.shape[0])
        return (gray, mask, lines), (False, True, x["translation"] / scale, x["rotation_deg"], x["scale"], m.inliers, m.ratio, change)

    return step


def frame_motion(frames: DataFrame, options: SceneOptions | None = None, grouped: bool = False) -> DataFrame:
    """Motion and edge change of each frame against the one before: video_id, frame, timestamp_seconds and FRAME_FIELDS."""
    return fold.ordered_fold(frames, "video_id", ["frame"], IMAGE, _frame_step(options or SceneOptions()), FRAME_FIELDS, keep=["timestamp_seconds"], grouped=grouped)


def frame_motion_of(videos: DataFrame, options: SceneOptions | None = None, source_options: dict[str, str] | None = None, frames_per_task: int = 256) -> DataFrame:
    """frame_motion for a table of videos (as frames_of takes it), in ranges of frames: each task reads the frame before its range too."""
    step, given = _frame_step(options or SceneOptions()), dict(source_options or {})
    schema = T.StructType([T.StructField("video_id", _string), T.StructField("frame", _int), T.StructField("timestamp_seconds", _double), *FRAME_FIELDS])
    last = F.col("total_frames") - 1
    rows = videos.filter("video_id IS NOT NULL AND path IS NOT NULL AND total_frames > 0").select("video_id", "path", last.cast("int").alias("end"))
    rows = rows.withColumn("first", F.explode(F.sequence(F.lit(0), F.col("end"), F.lit(frames_per_task))))
    rows = rows.select("video_id", "path", "first", F.least("end", F.col("first") + frames_per_task - 1).alias("last")).repartition("video_id", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        for batch in batches:
            for r in batch.to_pylist():
                state, out = None, []
                for part in source.read_range({**given, "video_id": r["video_id"], "path": r["path"]}, max(0, r["first"] - 1), r["last"]):
                    for row in part.to_pylist():
                        if row["bgr"] is not None:
                            state, values = step(state, row)
                            if row["frame"] >= r["first"]:
                                out.append((row["video_id"], row["frame"], row["timestamp_seconds"], *values))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k.type) for c, k in zip(zip(*out), kinds)], schema=kinds)

    return rows.mapInArrow(run, schema)


_VIEW_SCHEMA = "video_id string, frame int, points binary, bits binary"


def described(frames: DataFrame, options: SceneOptions | None = None) -> DataFrame:
    """Corners of each frame and their bits, as a view is recognised by: described where the frame is, so the picture stays there."""
    o = options or SceneOptions()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                gray, mask, _ = _analysed(row, o)
                points, bits = features.describe(gray, mask, o.features)
                out.append((row["video_id"], row["frame"], np.asarray(points, np.float64).tobytes(), bits.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), (pa.string(), pa.int32(), pa.binary(), pa.binary()))], names=["video_id", "frame", "points", "bits"])

    return frames.filter("bgr IS NOT NULL").select("video_id", "frame", *IMAGE).mapInArrow(run, _VIEW_SCHEMA)


def _view_step(o: SceneOptions):
    """Hold a settled frame's description against the known views of its video."""

    def step(state: tuple | None, row: dict) -> tuple[tuple, tuple]:
        mine = np.frombuffer(row["points"], np.float64).reshape(-1, 2), np.frombuffer(row["bits"], np.uint64).reshape(-1, 4)
        if state is None:
            return ([mine], 1), (1, "INITIAL_VIEW", None, None, None, None)
        views, now = state
        best: tuple | None = None
        for i, view in enumerate(views, 1):
            m = features.matched_motion(view, mine)
            if m.matches >= o.view_matches and m.inliers >= o.view_inliers and m.ratio >= o.view_ratio and (best is None or m.inliers * m.ratio > best[1]):
                best = (i, m.inliers * m.ratio, m)
        if best is None:
            return ([*views, mine], len(views) + 1), (len(views) + 1, "NEW_STABLE_VIEW", None, None, None, None)
        i, score, m = best
        return (views, i), (i, "SAME_VIEW_RESTABILIZED" if i == now else "RETURN_TO_KNOWN_VIEW", m.matches, m.inliers, m.ratio, score)

    return step


def scene_states(moved: DataFrame, options: SceneOptions | None = None) -> DataFrame:
    """moved (as frame_motion gives it) with moving, stable, state and event (MOVEMENT_STARTED, SETTLED); a first frame is stable."""
    o = options or SceneOptions()
    rules = SceneScan(fold.SceneRules(o.moving_frames, o.stable_frames, o.banner_frames))
    judged = moved.withColumn("e", frame_evidence(o)).select("*", "e.moving", "e.stable").drop("e")
    judged = judged.withColumn("moving", F.col("moving") & ~F.col("first"))
    numbers = [f.name for f in FRAME_FIELDS]
    return block_fold(judged, "video_id", "frame", rules, fold.SCENE_FIELDS, keep=["timestamp_seconds", *numbers])


#: Settled frames that are looked up in frames at a time: their numbers are broadcast, some hundred bytes each.
SETTLED = 100_000


def scene_log(frames: DataFrame, options: SceneOptions | None = None, grouped: bool = False) -> tuple[DataFrame, DataFrame]:
    """The scene state log (14 columns beside video_id), a row a frame, and the scene events (12), a row a change.

    frames is read once for all frames, and once for each SETTLED of the frames in which a camera has settled, whose numbers are broadcast
    so that no picture is moved for them.
    """
    o = options or SceneOptions()
    states = stored(scene_states(frame_motion(frames, o, grouped), o))
    settled = stored(states.filter((F.col("event") == "SETTLED") | F.col("first")).select("video_id", "frame"))
    parts = -(-settled.count() // SETTLED) or 1
    some = lambda k: settled.filter(F.pmod(F.xxhash64("video_id", "frame"), F.lit(parts)) == k) if parts > 1 else settled
    found = None
    for k in range(parts):
        part = described(frames.join(F.broadcast(some(k)), ["video_id", "frame"], "left_semi"), o)
        found = part if found is None else found.union(part)
    return _logs(states, found, o)


def scene_log_of(videos: DataFrame, options: SceneOptions | None = None, source_options: dict[str, str] | None = None, frames_per_task: int = 256) -> tuple[DataFrame, DataFrame]:
    """scene_log for a table of videos: any number of them, each of any length, in ranges of frames. Settled frames are read by seeking."""
    o = options or SceneOptions()
    states = stored(scene_states(frame_motion_of(videos, o, source_options, frames_per_task), o))
    settled = states.filter((F.col("event") == "SETTLED") | F.col("first")).select("video_id", F.col("frame").alias("first_frame"), F.col("frame").alias("last_frame"))
    wanted = videos.select("video_id", "path", "total_frames").join(settled, "video_id")
    return _logs(states, described(source.frames_of(wanted, source_options), o), o)


def _logs(states: DataFrame, settled: DataFrame, o: SceneOptions) -> tuple[DataFrame, DataFrame]:
    views = fold.ordered_fold(settled, "video_id", ["frame"], ["points", "bits"], _view_step(o), VIEW_FIELDS, keep=[])
    both = states.join(views, ["video_id", "frame"], "left").withColumn("event", F.coalesce("view_event", F.when(F.col("event") == "MOVEMENT_STARTED", F.col("event"))))
    both = both.withColumn("seen", F.col("view_id")).withColumn("new", F.coalesce(F.col("event") == "NEW_STABLE_VIEW", F.lit(False))).drop("view_id")
    held = [T.StructField("view_id", _int), T.StructField("before", _int), T.StructField("told", _long)]
    both = block_fold(both, "video_id", "frame", ViewScan(), held, keep=[c for c in both.columns if c not in ("video_id", "frame", "seen", "new")])
    shown = F.when(F.col("frame") - F.col("told") < o.banner_frames, F.lit("NEW_STABLE_VIEW")).otherwise(F.col("state"))
    name = lambda c: F.format_string("VIEW_%03d", c)
    log = both.select(
        "video_id", "frame", "timestamp_seconds", F.when(F.col("state") == "STABLE", shown).otherwise(F.col("state")).alias("state"), "view_id", name(F.col("view_id")).alias("view_name"),
        F.col("translation").alias("motion_translation_pixels"), F.col("rotation_deg").alias("motion_rotation_deg"), F.col("scale").alias("motion_scale"), F.col("inliers").alias("motion_inliers"),
        F.col("ratio").alias("motion_inlier_ratio"), F.col("edge_change").alias("edge_change_ratio"), F.col("moving").cast("int").alias("moving_evidence"), F.col("stable").cast("int").alias("stable_evidence"), "event",
    )
    changed = both.withColumn("before", F.coalesce("before", "view_id")).filter(F.col("event").isNotNull() & (F.col("event") != "INITIAL_VIEW"))
    started = F.col("event") == "MOVEMENT_STARTED"
    events = changed.select(
        "video_id", "frame", "timestamp_seconds", "event", F.when(started, "STABLE").otherwise("MOVING").alias("from_state"), F.when(started, "MOVING").otherwise("STABLE").alias("to_state"),
        name(F.col("before")).alias("previous_view"), name(F.col("view_id")).alias("current_view"), F.when(F.col("scene_score").isNotNull(), name(F.col("seen"))).alias("matched_known_view"),
        "scene_good_matches", "scene_inliers", "scene_inlier_ratio", "scene_score",
    )
    return log, events

