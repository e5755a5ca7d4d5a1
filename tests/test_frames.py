"""The frame sources: pushed filters, several videos, files that end early, reference frames."""

import json

import pytest
from pyspark.sql import functions as F

from caloris.sources import frames as S


@pytest.fixture(scope="module")
def source(spark):
    S.register(spark)
    return lambda **o: spark.read.format("frames").options(**{k: str(v) for k, v in o.items()}).load()


def numbers(df):
    return sorted((r.video_id, r.frame) for r in df.select("video_id", "frame").collect())


VIDEOS = json.dumps([{"video_id": "a", "frames": 100}, {"video_id": "b", "frames": 40, "texture": 3}, {"video_id": "c", "frames": 7}])


@pytest.mark.parametrize(
    ("filter", "partitions"),
    [
        ("frame = 73", 1), ("frame IN (3, 4, 5, 39)", 5), ("video_id = 'b'", 4), ("video_id = 'b' AND frame >= 25", 2), ("frame > 9 AND frame < 20", 2), ("frame BETWEEN 5 AND 14 AND video_id IN ('a', 'x')", 1),
        ("frame = 5 AND frame = 6", 0), ("video_id = 'none'", 0), ("frame < 0", 0), ("frame % 10 = 0 AND video_id = 'c'", 1), ("frame = 1 OR frame = 98", 15), ("width = 64 AND frame = 99", 1), ("frame > 1000", 0),
    ],
)
def test_filters_prune_partitions(source, filter, partitions):
    """Planned partitions of 10 frames; rows as without pushing."""
    whole = source(videos=VIDEOS, frames_per_partition=10)
    found = whole.filter(filter)
    assert numbers(found) == [x for x in numbers(whole.filter(F.expr(filter).cast("string") == "true"))]
    if "OR" not in filter:
        assert found.rdd.getNumPartitions() == partitions or partitions == 0 and found.rdd.getNumPartitions() <= 1


def test_one_frame_of_a_video_is_the_same_however_it_is_reached(source):
    by_seek, whole = source(frames=500, texture=4).filter("frame = 421").collect(), source(frames=500, texture=4).collect()
    assert len(by_seek) == 1 and by_seek[0].bgr == whole[421].bgr


def test_files_that_end_early(spark, source):
    assert source(frames=20, ends_at=13, frames_per_partition=8).count() == 13
    reported = source(frames=20, ends_at=13, frames_per_partition=8, missing="null")
    assert reported.count() == 20 and sorted(r.frame for r in reported.filter("bgr IS NULL").collect()) == list(range(13, 20))
    with pytest.raises(Exception, match="ends before frame 13"):
        source(frames=20, ends_at=13, missing="error").collect()
    videos = spark.createDataFrame([("video", 20), ("gone", 3), ("none", 0), ("whole", 2)], "video_id string, total_frames int")
    held = reported.select("video_id", "frame", "bgr").union(spark.createDataFrame([("whole", 0, b"x"), ("whole", 1, b"x")], "video_id string, frame int, bgr binary")).filter("frame <> 4")
    assert sorted(map(tuple, S.missing_frames(held, videos).collect())) == [("gone", 0, 2), ("video", 4, 4), ("video", 13, 19)]


def test_table_of_videos(spark, source):
    videos = spark.createDataFrame([("a", "x", 25, None, None), ("b", "y", 9, 4, 100), (None, "z", 9, None, None), ("d", None, 9, None, None), ("e", "w", 0, None, None), ("f", "v", 9, 5, 3)], "video_id string, path string, total_frames int, first_frame int, last_frame int")
    found = S.frames_of(videos, {"frames": "25", "texture": "4"}, 10)
    assert numbers(found) == [("a", k) for k in range(25)] + [("b", k) for k in range(4, 9)]
    same = {r.frame: r.bgr for r in source(frames=25, texture=4).collect()}
    assert all(r.bgr == same[r.frame] for r in found.collect())
    assert S.frames_of(videos.limit(0)).count() == 0


def test_reference_frame(spark):
    rows = spark.createDataFrame([(5, None, 10), (50, None, 10), (-1, None, 10), (None, None, 10), (5, 7, 10), (5, 70, 10), (5, None, 0)], "asked int, own int, total int")
    assert [r[0] for r in rows.select(S.reference_frame(F.col("asked"), F.col("own"), F.col("total"))).collect()] == [5, 9, 0, 0, 7, 9, None]


def test_a_camera_is_dropped_after_three_failed_reads(monkeypatch):
    reads = []

    class Flaky:
        def __init__(self, options):
            reads.append("open")

        def newest(self):
            import numpy as np

            reads.append("read")
            return np.zeros((2, 2, 3), np.uint8) if len([r for r in reads if r == "read"]) in (1, 4, 9) else None

    monkeypatch.setitem(S.CAMERAS, "flaky", Flaky)
    monkeypatch.setattr(S, "PAUSE", 0)
    monkeypatch.setattr(S, "_OPEN", {})
    clock = [0.0]
    monkeypatch.setattr(S.time, "time", lambda: clock[0])
    camera = S.CameraStream({"cameras": "c", "decoder": "flaky", "reconnect_seconds": "0.1"})
    status = lambda: next(iter(camera.read(S.Camera("c", 1))))[-1]
    # reads 1; 2, 3, 4: the third of them works; 5, 6, 7 fail
    assert [status(), status(), status()] == ["CONNECTED", "CONNECTED", "RECONNECTING"]
    clock[0] = 0.4  # half a second at least
    assert status() == "RECONNECTING" and reads.count("read") == 7 and reads.count("open") == 1
    clock[0] = 0.6
    assert status() == "CONNECTED" and reads.count("open") == 2 and reads.count("read") == 9
