"""Stages that run when they have to."""

import json
import pathlib

import pytest

from caloris.operators import dataset, provenance
from caloris.operators.runner import Outcome, run_stage
from caloris.sources.frames import check_video

FILES = ("scale_readings.csv",)


def test_a_stage_runs_when_it_must(spark, tmp_path):
    target, runs = str(tmp_path / "out"), []

    def work(folder):
        runs.append(folder)
        pathlib.Path(folder, FILES[0]).write_text(f"run {len(runs)}")
        return {"rows": len(runs)}

    go = lambda hz="3", sha="a", inputs=None, **o: run_stage(spark, "scale_readings", target, work, {"sha256": sha}, inputs or {"regions": "r"}, {"hz": hz}, **o)
    assert go() == Outcome("NEW", "PROCESS", []) and go() == Outcome("CURRENT", "SKIP", [])
    assert json.loads((tmp_path / "out/stage_manifest.json").read_text())["outputs"] == {"files": list(FILES), "rows": 1}
    assert go(hz="4") == Outcome("STALE", "REPROCESS", ["settings.hz"]) and go(hz="4").action == "SKIP"
    assert go(hz="4", sha="b").reasons == ["source_video.sha256"] and go("5", "c", {"regions": "q"}).reasons == ["inputs.regions", "settings.hz", "source_video.sha256"]
    # a setting that only the record has is no reason
    assert run_stage(spark, "scale_readings", target, work, {"sha256": "c"}).action == "SKIP"
    assert go("5", "c", {"regions": "q"}, force=True).action == "REPROCESS" and len(runs) == 5
    (tmp_path / "out" / FILES[0]).write_text("")
    assert go("5", "c", {"regions": "q"}) == Outcome("PARTIAL", "RESTART", [])
    (tmp_path / "out/stage_manifest.json").unlink()
    assert go("6").status == provenance.STATUSES[2] and go("6").action == "SKIP"
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_failures_leave_the_old_results(spark, tmp_path):
    target = str(tmp_path / "out")
    write = lambda text: lambda folder: pathlib.Path(folder, FILES[0]).write_text(text) and None
    run_stage(spark, "scale_readings", target, write("old"), {"sha256": "a"})

    def fails(folder):
        pathlib.Path(folder, "part").write_text("x")
        raise RuntimeError("broken")

    def called_off(folder):
        raise KeyboardInterrupt

    with pytest.raises(RuntimeError, match="broken"):
        run_stage(spark, "scale_readings", target, fails, {"sha256": "b"})
    with pytest.raises(ValueError, match="lacks"):
        run_stage(spark, "scale_readings", target, lambda folder: None, {"sha256": "b"})
    kept = [p for p in tmp_path.iterdir() if p.name.endswith(".work")]
    assert len(kept) == 2 and any((p / "part").exists() for p in kept)
    with pytest.raises(KeyboardInterrupt):
        run_stage(spark, "scale_readings", target, called_off, {"sha256": "b"})
    assert (tmp_path / "out" / FILES[0]).read_text() == "old" and len([p for p in tmp_path.iterdir() if p.name.endswith(".work")]) == 2


def test_a_table_is_an_output_too(spark, tmp_path):
    work = lambda folder: spark.range(5).write.parquet(f"{folder}/log") or None
    assert run_stage(spark, "log", str(tmp_path / "t"), work, {"sha256": "a"}, files=("log",)).status == "NEW"
    assert spark.read.parquet(str(tmp_path / "t/log")).count() == 5 and run_stage(spark, "log", str(tmp_path / "t"), work, {"sha256": "a"}, files=("log",)).action == "SKIP"


def test_videos_without_size_rate_or_frames():
    check_video(1, 1, 0.5, 1)
    for bad in ((0, 1, 1.0, 1), (1, 0, 1.0, 1), (1, 1, 0.0, 1), (1, 1, float("nan"), 1), (1, 1, 1.0, 0), (1, 1, -1.0, 1)):
        with pytest.raises(ValueError):
            check_video(*bad)


def test_timelines_of_a_table_of_clips(spark):
    clips = spark.createDataFrame([("a", 24.31192660550459), ("b", 0.3), ("c", 10.0)], "clip string, fps double")
    for back in (True, False):
        found = dataset.pan_frames_of(clips, "clip", back=back).orderBy("clip", "frame").collect()
        for clip, fps in (("a", 24.31192660550459), ("b", 0.3), ("c", 10.0)):
            want = [(r.frame, r.segment, r.fraction) for r in dataset.pan_frames(spark, dataset.pan_timeline(fps, back=back)).orderBy("frame").collect()]
            assert [(r.frame, r.segment, r.fraction) for r in found if r.clip == clip] == want
