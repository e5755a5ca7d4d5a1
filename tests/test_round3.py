"""What the reviewer of round 3 found: cases that only larger tables hold."""

import time

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from caloris.operators import spatial
from caloris.operators.dataset import DatasetOptions, augmentations
from caloris.operators.fold import SCALE_FIELDS, ScaleGate, confirm_step
from caloris.operators.kernels.pixels import percentiles
from caloris.operators.machines import StepMachine
from caloris.plans.queries import QUERIES, SQL
from caloris.streaming.event_time import EventTimeProcessor


def held_against_sql(spark, folder, name, **tables):
    """Rows of a query over the given tables and of its SQL, in some order."""
    con = duckdb.connect()
    for k, df in tables.items():
        df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{k}.parquet")
        con.execute(f"CREATE VIEW {k} AS SELECT * FROM '{folder}/{k}.parquet/*.parquet'")
    found = QUERIES[name](spark, str(folder))
    want = con.execute(SQL[name]).df()[found.columns].astype(object).where(lambda x: x.notna(), None)
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    return order(found.collect()), order(want.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", ["ocr_best_reading", "ocr_joined_text"])
def test_confidences_are_rounded_as_sql_does(spark, tmp_path, name):
    """142.5, 282.5 and 287.5 are 500ths a little below a half: rounded up, they would beat the readings beside them."""
    rows = [(i, u, "view", v) for i, (u, v) in enumerate((u, v) for u, vs in enumerate(((287.5, 291.0), (282.5, 280.1), (142.5, 141.0), (287.5, 287.5))) for v in vs)]
    events = spark.createDataFrame([(5 * i + k, u, e, v) for i, u, e, v in rows for k in (0, 1, 2)], "event_id long, user_id long, event_type string, value double")
    events = events.withColumns({"ts": F.timestamp_seconds("event_id").cast("timestamp_ntz"), "props": F.lit('{"k": 9}')})
    found, want = held_against_sql(spark, tmp_path, name, events=events)
    assert found == want and found


def test_percentiles_keep_to_the_decimals_of_sql(spark, tmp_path):
    """Two of 24 and one of 19 pixels are hot: 95 in a hundred lies between the lowest and the highest temperature, where SQL cuts to tenths."""
    cold, hot, overlay = 0.25, -0.25, 5 / 64 + 0.001
    frame = lambda n, of: [([hot] * of + [cold] * (n - of) + [overlay] * (32 - n))[y * 4 + x] if x < 4 else cold for y in range(8) for x in range(8)]
    rows = [(i, frame(n, of), 0) for i, (n, of) in enumerate(((24, 2), (19, 1), (19, 2), (3, 1), (32, 2), (7, 1)) * 3, 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for name in ("frame_temperatures", "video_summaries"):
        found, want = held_against_sql(spark, tmp_path, name, embeddings=vectors)
        assert found == want and found
    assert percentiles(np.array([10.0, 15.0, 10.0]), (0.95,), 1) == [14.4]
    assert percentiles(np.array([10.0, 15.0, 10.0]), (0.95,)) == pytest.approx([14.5])
    assert percentiles(np.array([7.5]), (0.5, 0.99), 1) == [7.5, 7.5]


def test_attempts_end_with_the_first_that_fits(spark):
    """However many are allowed: all of these fit at once."""
    points = "array(named_struct('x', 40D, 'y', 40D), named_struct('x', 80D, 'y', 40D), named_struct('x', 80D, 'y', 60D))"
    frames = spark.range(40).selectExpr("concat('v', id) AS source_group", "120 AS width", "100 AS height", f"array({points}) AS polygons")
    few = augmentations(frames, DatasetOptions(attempts=2)).drop("transform", "polygons")
    began = time.time()
    many = augmentations(frames, DatasetOptions(attempts=20_000)).drop("transform", "polygons")
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect())) and many.count() == 120
    assert time.time() - began < 30


def test_tiles_are_never_broadcast(spark):
    """Estimated sizes know neither of tiles nor of long shapes: of a million regions they filled the driver's memory."""
    shapes = spark.range(50).selectExpr("id AS region", "array(named_struct('x', id + 0D, 'y', 0D), named_struct('x', id + 9D, 'y', 0D), named_struct('x', id + 9D, 'y', 9D)) AS shape")
    places = spark.range(200).selectExpr("id", "id % 70 + 0D AS x", "id % 10 + 0D AS y")
    spans = spark.range(50).selectExpr("id AS span", "id + 0D AS low", "id + 5D AS high")
    for found in (spatial.points_in_polygons(places, shapes, [], "x", "y", "shape"), spatial.interval_join(places, spans, [], "x", "low", "high")):
        assert found.count() > 0
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_group_of_keys_shares_its_calls_to_the_state():
    """A hundred keys of a group: one timer, and calls by slots of time, not by keys and rows."""
    calls = []

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, v):
            calls.append("update")
            self.held = v

    class Map(dict):
        getValue = dict.__getitem__  # noqa: N815

        def updateValue(self, k, v):  # noqa: N802
            calls.append("slot")
            self[k] = v

        removeKey = dict.__delitem__  # noqa: N815

    class Handle:
        timers: set = set()
        registerTimer, deleteTimer = timers.add, timers.remove  # noqa: N815

        def getValueState(self, *_):  # noqa: N802
            return Value()

        def getMapState(self, *_):  # noqa: N802
            return Map()

    class Times:
        def __init__(self, at):
            self.getCurrentWatermarkInMs = lambda: at

    p = EventTimeProcessor("camera", "frame", ["low", "high"], StepMachine(confirm_step(ScaleGate(0.0, 1000.0, 5.0, 10.0, 4.0)), SCALE_FIELDS), 1000)
    p.init(Handle())
    rows = pd.DataFrame([(f"c{k}", at, at, 20.0 + k, 60.0 + k) for at in (2500, 1500, 1200) for k in range(100)], columns=["camera", "at", "frame", "low", "high"])
    assert not sum(len(d) for d in p.handleInputRows((0,), iter([rows]), Times(1000)))
    assert len(calls) == 3 and Handle.timers == {1200}
    Handle.timers.clear()
    made = pd.concat(p.handleExpiredTimer((0,), Times(2000), None))
    assert len(calls) == 4 and Handle.timers == {2500} and len(made) == 200
    assert [tuple(r) for r in made[made.camera == "c7"][["at", "scale_min", "status"]].values] == [(1200, 27.0, "ACCEPT_PRIMARY"), (1500, 27.0, "ACCEPT_PRIMARY")]


def test_pictures_without_news_are_not_searched(monkeypatch):
    """A picture of one level holds nothing to follow; one that comes again is where it was. Neither is tracked, repeats not even looked at."""
    from caloris.operators.kernels import features, motion
    from caloris.operators.matching import SceneOptions
    from caloris.operators.motion import _frame_step
    from caloris.operators.simulate import _scene

    tracked, looked = [], []
    follow, find = motion.track, motion.corners
    monkeypatch.setattr(motion, "track", lambda *a, **k: (tracked.append(1), follow(*a, **k))[1])
    monkeypatch.setattr(motion, "corners", lambda *a, **k: (looked.append(1), find(*a, **k))[1])
    gray = _scene(3, 160, 120)[32:152, 32:192]
    assert motion.estimate(gray, np.zeros_like(gray)) == motion.Motion(None, 0, 0)
    same = motion.estimate(gray, gray.copy())
    assert same.matches == same.inliers > 100 and (same.transform == np.eye(2, 3)).all() and not tracked
    row = {"width": 160, "height": 120, "bgr": np.repeat(gray[:, :, None], 3, 2).tobytes()}
    looked.clear()
    step, state, seen = _frame_step(SceneOptions()), None, []
    for _ in range(6):
        state, values = step(state, dict(row))
        seen.append(values)
    assert seen[0][0] and len(set(seen[1:])) == 1 and seen[1][:5] == (False, True, 0.0, 0.0, 1.0) and seen[1][5] > 100 and seen[1][7] == 0
    assert len(looked) == 1 and not tracked
    moved = np.roll(gray, 3, 1)
    m = motion.estimate(gray, moved)
    assert tracked and m.transform[0, 2] == pytest.approx(3, abs=0.05)
    assert len(features.describe(np.zeros_like(gray), None, 900)[0]) == 0
