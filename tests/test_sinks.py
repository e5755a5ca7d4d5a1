"""Sinks: pictures, view libraries, versions, labelled datasets."""

import json
import pathlib
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from caloris.sources import pictures as P
from caloris.sources import store, versions
from caloris.sources.frames import register

SHAPE = "name string, width int, height int, pixels binary"


def picture(seed, h, w, depth):
    return np.random.default_rng(seed).integers(0, 256, (h, w, depth)).astype(np.uint8).tobytes()


def kept(df):
    return sorted((r.name, r.width, r.height, bytes(r.pixels)) for r in df.collect())


def test_png_round_trip_and_errors():
    for h, w, depth in ((1, 1, 1), (5, 3, 3), (2, 300, 1)):
        data = picture(h, h, w, depth)
        made = P.png(data, w, h)
        assert P.unpng(made) == (w, h, data) and made[1:4] == b"PNG"
    with pytest.raises(ValueError):
        P.png(b"123", 2, 2)
    with pytest.raises(ValueError):
        P.png(b"", 0, 0)
    with pytest.raises(ValueError, match="damaged"):
        P.unpng(made[:40] + b"?" + made[41:])
    with pytest.raises(ValueError):
        P.unpng(b"text")


def test_pictures_are_read_back(spark, tmp_path):
    rows = [(f"v{i % 2}/frame_{i}", 4, 6, picture(i, 6, 4, 1 + 2 * (i % 2))) for i in range(20)]
    df = spark.createDataFrame(rows, SHAPE).repartition(3)
    P.write_pictures(df.filter("name < 'v1'"), str(tmp_path / "p"))
    P.write_pictures(df.filter("name >= 'v1'"), f"file://{tmp_path / 'p'}")
    assert kept(P.read_pictures(spark, str(tmp_path / "p"))) == sorted(rows)
    P.write_pictures(df.limit(3), str(tmp_path / "p"), "overwrite")
    assert P.read_pictures(spark, str(tmp_path / "p")).count() == 3
    P.write_pictures(df.limit(0), str(tmp_path / "p"), "overwrite")
    assert P.read_pictures(spark, str(tmp_path / "p")).count() == 0


@pytest.mark.parametrize("bad", [("a/../../b", 1, 1, b"x"), ("/a", 1, 1, b"x"), (None, 1, 1, b"x"), ("", 1, 1, b"x"), ("a", 2, 2, b"x"), ("b", 1, 1, None)])
def test_a_failed_job_leaves_nothing(spark, tmp_path, bad):
    good = [(f"p{i}", 1, 1, b"x") for i in range(40)]
    P.write_pictures(spark.createDataFrame(good[:2], SHAPE), str(tmp_path / "p"))
    before = sorted(str(f) for f in (tmp_path / "p").rglob("*"))
    with pytest.raises(Exception):
        P.write_pictures(spark.createDataFrame([*good, bad], SHAPE).coalesce(1), str(tmp_path / "p"))
    assert sorted(str(f) for f in (tmp_path / "p").rglob("*")) == before
    assert kept(P.read_pictures(spark, str(tmp_path / "p"))) == good[:2]


def test_view_library(spark, tmp_path):
    rows = [(2, "VIEW_002", 90, 3.6, 3, 2, picture(2, 2, 3, 3)), (1, "VIEW_001", 0, 0.0, 3, 2, picture(1, 2, 3, 3))]
    views = spark.createDataFrame(rows, "id int, name string, created_frame int, created_timestamp_seconds double, width int, height int, bgr binary")
    P.write_views(views, str(tmp_path / "lib"))
    assert json.loads((tmp_path / "lib/view_library.json").read_text()) == {"views": [
        {"id": i, "name": n, "created_frame": f, "created_timestamp_seconds": s, "reference_image": f"{n}_reference.png"} for i, n, f, s, *_ in sorted(rows)
    ]}
    assert kept(P.read_pictures(spark, str(tmp_path / "lib/views"))) == sorted((f"{r[1]}_reference", 3, 2, r[6]) for r in rows)
    from caloris.operators.provenance import missing_files, view_pictures

    needed = view_pictures(views.withColumn("video_id", F.lit("v"))).select("video_id", F.col("filename").alias("name"))
    present = spark.createDataFrame([("v", "VIEW_001_reference.png", 70)], "video_id string, name string, size_bytes long")
    assert [r.name for r in missing_files(needed, present, ["video_id"]).collect()] == ["VIEW_002_reference.png"]


def test_debug_crops(spark):
    register(spark)
    frames = spark.read.format("frames").options(frames="3", width="160", height="120", low="15.6", high="46.9").load()
    crops = {r.name: r for r in P.debug_crops(frames.filter("frame = 1"), {"MIN": {"x": 4, "y": 90, "w": 40, "h": 20}, "MAX": {"x": 4, "y": 4, "w": 40, "h": 20}}, {"MIN": "gray_otsu", "MAX": "green_difference"}).collect()}
    assert set(crops) == {f"video/frame_000001_{k}_{n}" for k in ("ORIGINAL", "PRIMARY") for n in ("MIN", "MAX")}
    frame = np.frombuffer(frames.filter("frame = 1").first().bgr, np.uint8).reshape(120, 160, 3)
    own = crops["video/frame_000001_ORIGINAL_MIN"]
    assert bytes(own.pixels) == frame[84:116, 0:50].tobytes() and (own.width, own.height) == (50, 32)


# --- versions


def test_versions(spark, tmp_path):
    target = str(tmp_path / "t")
    table = lambda n: spark.range(n).withColumn("n", F.lit(n))
    assert versions.current(spark, target) is None
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, target)
    first = versions.publish_table(table(3), target, expected=None)
    opened = versions.read_table(spark, target)
    second = versions.publish_table(table(4), target, expected=first)
    assert opened.count() == 3 and versions.read_table(spark, target).count() == 4 and versions.current(spark, target) == second
    with pytest.raises(versions.Superseded):
        versions.publish_table(table(5), target, expected=first)
    with pytest.raises(RuntimeError):
        versions.publish(spark, target, lambda folder: (_ for _ in ()).throw(RuntimeError("no")))
    with pytest.raises(ValueError):
        versions.publish(spark, target, lambda folder: None)
    assert versions.read_table(spark, target).count() == 4
    assert versions.forget(spark, target, keep=1) == 1 and not pathlib.Path(first).exists()
    assert versions.read_table(spark, target).count() == 4
    assert sorted(p.name for p in (tmp_path / "t/log").iterdir()) == [f"{k:020d}.json" for k in (1, 2)]


def test_two_writers_at_once(spark, tmp_path):
    """Each version is whole and has a place of its own in the log; readers see one of them at any time."""
    target, errors, seen = str(tmp_path / "t"), [], []
    versions.publish_table(spark.range(1).withColumn("w", F.lit(0)), target)

    def write(w):
        try:
            for k in range(3):
                versions.publish_table(spark.range(20).withColumn("w", F.lit(w * 10 + k)), target)
        except Exception as e:
            errors.append(e)

    writers = [threading.Thread(target=write, args=(w,)) for w in (1, 2)]
    for t in writers:
        t.start()
    while any(t.is_alive() for t in writers):
        seen.append(versions.read_table(spark, target).agg(F.count("*"), F.countDistinct("w")).first())
    assert not errors and set(map(tuple, seen)) <= {(1, 1), (20, 1)}
    assert sorted(p.name for p in (tmp_path / "t/log").iterdir()) == [f"{k:020d}.json" for k in range(1, 8)]
    folders = [json.loads((tmp_path / f"t/log/{k:020d}.json").read_text())["folder"] for k in range(1, 8)]
    assert len(set(folders)) == 7


def test_one_place_in_the_log_is_given_once(spark, tmp_path):
    path, won = str(tmp_path / "log/1.json"), []
    threads = [threading.Thread(target=lambda i=i: won.append(versions._put_if_absent(spark, path, f"{i}"))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False] * 7 + [True] and [p.name for p in (tmp_path / "log").iterdir()] == ["1.json"]


# --- labelled datasets and tracked regions


def test_coco_tables(spark, tmp_path):
    images = spark.createDataFrame([(1, "a.jpg"), (2, "b.jpg")], "id int, file_name string")
    annotations = spark.createDataFrame([(1, 1, [1.0, 2.0]), (2, 2, [3.0, 4.0])], "id int, image_id int, bbox array<double>")
    store.coco(images, annotations, ["motor", "pump"], str(tmp_path / "c"))
    read = lambda n: sorted((json.loads(line) for f in (tmp_path / "c" / n).glob("*.json") for line in f.read_text().splitlines()), key=lambda r: r["id"])
    assert read("images") == [{"id": 1, "file_name": "a.jpg"}, {"id": 2, "file_name": "b.jpg"}]
    assert read("annotations")[1] == {"id": 2, "image_id": 2, "bbox": [3.0, 4.0]}
    assert read("categories") == [{"id": 1, "name": "motor", "supercategory": "equipment"}, {"id": 2, "name": "pump", "supercategory": "equipment"}]


def test_tracked_regions_nest_in_order(spark):
    rows = [("v", f, f / 10, "TRACKED", r, f"r{r}", [(float(r), 0.0)], [(r / 10, 0.0)]) for f in (1, 0) for r in (2, 1)]
    point = "array<struct<x:double,y:double>>"
    log = spark.createDataFrame(rows, f"video_id string, frame int, timestamp_seconds double, status string, region_id int, region_name string, pixel_points {point}, normalized_points {point}")
    found = store.tracked_regions(log).orderBy("frame").collect()
    assert [(r.frame, [x.region_id for x in r.regions]) for r in found] == [(0, [1, 2]), (1, [1, 2])]
    assert found[0].regions[1].region_name == "r2" and found[0].regions[1].pixel_points[0].x == 2.0


def test_a_scope_removes_what_was_stored(spark):
    from caloris.plans.queries import QUERIES

    with store.scratch(spark) as folder:
        assert QUERIES["stale_causes"](spark, "/root/testdata/sf0.001").count() > 0
        path = pathlib.Path(folder.removeprefix("file:"))
        assert len(list(path.iterdir())) > 1
        with store.scratch(spark) as inner:
            held = store.stored(spark.range(3))
            assert held.count() == 3 and held.inputFiles()[0].find(inner.removeprefix("file:").lstrip("/")) > 0
    assert not path.exists() and not store._SCOPES
    assert [store.runs_here(m) for m in ("local", "local[4]", "local[*, 2]", "local-cluster[1,1,1]", "yarn", "spark://a:1")] == [True] * 3 + [False] * 3
