"""Machines over streams: order of arrival, late rows, restarts, seeds, metrics; and machines against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from caloris.operators import fold
from caloris.operators.machines import ReadingMachine, StatusMachine, StepMachine, ordered_machine
from caloris.streaming.event_time import sound_seeds, stream_machine
from caloris.streaming.metrics import FrameMetrics, frame_metrics, measured
from caloris.streaming.replay import arrivals, replayed

GATE = fold.ScaleGate(0.0, 1000.0, 5.0, 10.0, 4.0)
FIELDS = "camera string, frame long, ts timestamp, low double, high double, latency long, raised boolean, ok boolean"
INPUTS = ["low", "high", "latency", "raised"]


def made(spark, n=240, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        low = None if rng.random() < 0.1 else round(20 + rng.choice([0, 0, 0, 30]) + rng.random() * 8, 2)
        rows.append((f"c{i % 3}", i, i * 0.1 + rng.random() * 0.05, low, 60.0 + (low or 0), rng.choice([0, 150, 400, 2500]), rng.random() < 0.1, rng.random() < 0.6))
    return spark.createDataFrame(rows, "camera string, frame long, s double, low double, high double, latency long, raised boolean, ok boolean").selectExpr(
        "camera", "frame", "timestamp_micros(cast(s * 1000000 as bigint)) AS ts", "low", "high", "latency", "raised", "ok"
    )


def run(spark, folder, like, machine, inputs, delay, tmp_path, seeds=None):
    q = stream_machine(replayed(spark, folder, like), "camera", "ts", "frame", inputs, machine, delay, seeds)
    q = q.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def with_end(spark, df, last):
    end = spark.range(1).select(*(F.lit({"camera": "end", "ts": "2100-01-01 00:00:00"}.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema))
    return df.withColumn("batch", F.expr("int((unix_millis(ts) + crc32(cast(frame AS string)) % 3000) / 7000)")).union(end.withColumn("batch", F.lit(last)))


def plain(df):
    return sorted(map(tuple, df.filter("camera <> 'end'").drop("late").collect()), key=repr)


@pytest.mark.parametrize("machine", [ReadingMachine(GATE, 4.0), StatusMachine(2, 900, 1500)])
def test_any_order_and_a_restart_give_the_batch_result(spark, tmp_path, machine):
    """The stream stops after two batches and goes on with the rest from its checkpoint; nothing comes late."""
    df = made(spark)
    inputs = INPUTS if isinstance(machine, ReadingMachine) else ["ok"]
    rows = with_end(spark, df, 5)
    folder = arrivals(rows, F.col("batch"), 2)
    run(spark, folder, rows, machine, inputs, "4 seconds", tmp_path)
    arrivals(rows, F.col("batch"), 6, folder, first=2)
    found = run(spark, folder, rows, machine, inputs, "4 seconds", tmp_path)
    assert found.filter("late").count() == 0
    want = ordered_machine(df, "camera", "ts", "frame", inputs, machine)
    assert plain(found) == plain(want) and want.count() > 20


def test_late_rows_are_told_apart(spark, tmp_path):
    df = made(spark, 90)
    rows = with_end(spark, df, 5).withColumn("batch", F.when(F.col("frame") % 30 == 7, 4).otherwise(F.col("batch")))
    machine = StepMachine(fold.confirm_step(GATE), fold.SCALE_FIELDS)
    found = run(spark, arrivals(rows, F.col("batch"), 6), rows, machine, ["low", "high"], "4 seconds", tmp_path)
    late = found.filter("late").collect()
    assert {r.frame for r in late} == {7, 37} and all(r.status is None for r in late)  # 67 is in time
    assert plain(found.filter("NOT late")) == plain(ordered_machine(df.filter("frame NOT IN (7, 37)"), "camera", "ts", "frame", ["low", "high"], machine))


def test_seeds_of_other_engines_are_left_out(spark, tmp_path):
    df = made(spark, 60)
    seeds = spark.createDataFrame([("c0", 20.0, 80.0, "Own"), ("c1", 20.0, 80.0, "other"), ("c2", float("nan"), 80.0, "own"), ("c9", 1.0, 9.0, "own"), ("c8", None, 9.0, "own")], "camera string, low double, high double, engine string")
    sound = sound_seeds(seeds, "own")
    assert {r.camera for r in sound.collect()} == {"c0", "c9"}
    machine, rows = ReadingMachine(GATE, 4.0), with_end(spark, df, 5)
    found = run(spark, arrivals(rows, F.col("batch"), 6), rows, machine, INPUTS, "4 seconds", tmp_path, sound)
    want = ordered_machine(df, "camera", "ts", "frame", INPUTS, machine, {"c0": {"low": 20.0, "high": 80.0}})
    assert plain(found) == plain(want)
    first = {r.camera: r for r in want.orderBy("at").collect()[::-1] if r.frame is not None}
    assert first["c0"].status == "REFERENCE_SCALE" and first["c1"].status == "WAITING" and first["c1"].scale_min is None


def test_readings_hold_from_their_arrival_on(spark):
    """Against a list of requests: one at a time, no sooner than the interval, each result through the rule of jumps when it is due."""
    rows = [(r.frame, int(r.ts.timestamp() * 1000), r.low, r.high, r.latency, r.raised) for r in made(spark, 200, 3).filter("camera = 'c1'").orderBy("ts").collect()]
    step, trusted, waiting, status, busy_until, last, results, want = fold.confirm_step(GATE), None, None, "WAITING", None, None, [], []
    for frame, at, low, high, latency, raised in rows:
        def deliver():
            nonlocal trusted, waiting, status, busy_until
            _, a, b, failed = results[-1]
            busy_until = None
            if failed:
                status = "ERROR_HOLD_PREVIOUS"
            else:
                (trusted, waiting), out = step((trusted, waiting), {"low": a, "high": b})
                status = out[2]

        if busy_until is not None and busy_until <= at:
            deliver()
        submit = busy_until is None and (last is None or at - last >= 250)
        if submit:
            results.append((at + latency, low, high, raised))
            busy_until, last = at + latency, at
            if latency == 0:
                deliver()
        want.append((frame, *(trusted or (None, None)), status, submit))
    found = ordered_machine(made(spark, 200, 3).filter("camera = 'c1'"), "camera", "ts", "frame", INPUTS, ReadingMachine(GATE, 4.0))
    assert [(r.frame, r.scale_min, r.scale_max, r.status, r.submitted) for r in found.filter("frame IS NOT NULL").orderBy("at", "frame").collect()] == want
    # a row for each result that took time
    assert sorted(r.at for r in found.filter("frame IS NULL").collect()) == sorted(t for (t, *_), (_, at, *_) in zip(results, [r for r, w in zip(rows, want) if w[4]]) if t > at)


def test_status_golden(spark):
    rows = [(0, False), (400, True), (600, True), (700, False), (800, False), (900, True), (1000, False), (1100, False), (1200, False), (1300, True), (3300, True), (9000, True)]
    df = spark.createDataFrame([("c", i, t, ok) for i, (t, ok) in enumerate(rows)], "camera string, frame long, t long, ok boolean").selectExpr("camera", "frame", "timestamp_millis(t) AS ts", "ok")
    found = ordered_machine(df, "camera", "ts", "frame", ["ok"], StatusMachine(3, 100, 5000)).orderBy("at", F.expr("CASE reason WHEN 'OPENED' THEN 0 WHEN 'SILENT' THEN -1 ELSE 1 END")).collect()
    # a delay below half a second is half a second
    assert [(r.at, r.status, r.reason, r.reconnects) for r in found] == [
        (0, "CONNECTING", "OPENED", 0), (0, "RECONNECTING", "OPEN_FAILED", 0), (500, "CONNECTING", "DELAY_PASSED", 0), (600, "CONNECTED", "READ", 0), (1200, "RECONNECTING", "READ_FAILED", 1),
        (1700, "CONNECTING", "DELAY_PASSED", 1), (3300, "CONNECTED", "READ", 1), (8300, "STOPPED", "SILENT", 1), (9000, "CONNECTING", "OPENED", 1), (9000, "CONNECTED", "READ", 1), (14000, "STOPPED", "SILENT", 1),
    ]


def test_frame_metrics(spark, tmp_path):
    import time

    df = made(spark, 60).withColumn("batch", F.expr("int(frame / 20)"))
    listener = FrameMetrics(spark, str(tmp_path / "metrics"))
    spark.streams.addListener(listener)
    try:
        q = measured(replayed(spark, arrivals(df, F.col("batch"), 3), df), "camera", "ts").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination()
        for _ in range(50):
            if (tmp_path / "metrics").exists() and len(list((tmp_path / "metrics").glob("*.json"))) == 3:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    kept = frame_metrics(spark, str(tmp_path / "metrics")).orderBy("batch_id").collect()
    assert [(r.batch_id, r.frames, r.cameras) for r in kept] == [(0, 20, 3), (1, 20, 3), (2, 20, 3)]
    assert all(8 < r.receive_fps < 12 and r.frame_age_seconds > 1e9 for r in kept)
