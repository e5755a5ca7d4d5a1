"""Ordered folds: operators whose next row depends on their own last decision.

A step is a function (state, row) -> (state, outputs). Batches run it over each key's rows in order; streams run the same steps
with the state in Spark's store (caloris.streaming.fold). A key's rows are sorted by Spark, which spills, and pass through in Arrow
batches with only the state carried over, so a long video needs no more memory than a short one. Keys run in parallel.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Step = Callable[[Any, dict], tuple[Any, tuple]]


def ordered_fold(df: DataFrame, key: str, order: list[str], inputs: list[str], step: Step, fields: list[T.StructField], start: Any = None, keep: list[str] | None = None, grouped: bool = False) -> DataFrame:
    """key, order and inputs of df, and what step makes of each row. start: the state before a key's first row.

    keep: the columns that are returned in place of the inputs; the step sees inputs only. grouped: df's partitions hold whole keys in order already, as the frames source
    gives them with one partition a video, so nothing is moved.
    """
    held = list(dict.fromkeys([key, *order, *inputs, *(keep or [])]))
    columns = held if keep is None else list(dict.fromkeys([key, *order, *keep]))
    schema = T.StructType([*(df.schema[c] for c in columns), *fields])
    made = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(made)
        now, state, first = None, start, True
        for batch in batches:
            rows = {c: batch.column(c).to_pylist() for c in inputs}
            out = []
            for i, k in enumerate(batch.column(key).to_pylist()):
                if first or k != now:
                    now, state, first = k, start, False
                state, values = step(state, {c: v[i] for c, v in rows.items()})
                out.append(values)
            made_columns = [pa.array(list(v), type=f.type) for v, f in zip(zip(*out), kinds)] if out else [pa.array([], f.type) for f in kinds]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *made_columns], names=[*columns, *kinds.names])

    rows = df.select(*held)
    return (rows if grouped else rows.repartition(key).sortWithinPartitions(key, *order)).mapInArrow(run, schema)


@dataclass(frozen=True)
class ScaleGate:
    """Plausibility of a pair of scale labels."""

    min_allowed: float = -100.0
    max_allowed: float = 1000.0
    min_span: float = 5.0
    max_jump: float = 2.5
    confirm_tolerance: float = 1.0

    def valid(self, low: float | None, high: float | None) -> bool:
        if low is None or high is None or low != low or high != high:
            return False
        inside = self.min_allowed <= low <= self.max_allowed and self.min_allowed <= high <= self.max_allowed
        return inside and high > low and high - low >= self.min_span


SCALE_FIELDS = [T.StructField("scale_min", T.DoubleType()), T.StructField("scale_max", T.DoubleType()), T.StructField("status", T.StringType())]


def hold_step(gate: ScaleGate, clip: bool = True) -> Step:
    """A valid pair within the jump of the last accepted one is accepted; else the last accepted pair is held, however long.

    clip: the rule for recorded clips, where a jump limit of 0 admits no change. Without it, that of viewers: a limit of 0 or less
    admits every change, and a row whose `reseed` is true (after a seek) is accepted at any distance.
    """

    def step(state: tuple[float, float] | None, row: dict) -> tuple[tuple[float, float] | None, tuple]:
        low, high = row["low"], row["high"]
        free = state is None or (not clip and (gate.max_jump <= 0 or bool(row.get("reseed"))))
        if gate.valid(low, high) and (free or (abs(low - state[0]) <= gate.max_jump and abs(high - state[1]) <= gate.max_jump)):
            return (low, high), (low, high, "ACCEPT_PRIMARY")
        return state, (*(state or (None, None)), "HOLD_PREVIOUS")

    return step


def confirm_step(gate: ScaleGate) -> Step:
    """The rule for live streams: a jump waits until the next reading agrees with it, then it is accepted.

    State: trusted low and high, pending low and high. A reading that fails clears what waits; one that disagrees with it takes its
    place. A jump limit of 0 or less lets every valid pair through.
    """

    def step(state: tuple | None, row: dict) -> tuple[tuple, tuple]:
        low, high = row["low"], row["high"]
        trusted, waiting = state or (None, None)
        if not gate.valid(low, high):
            return (trusted, None), (*(trusted or (None, None)), "HOLD_PREVIOUS")
        near = lambda a, d: abs(low - a[0]) <= d and abs(high - a[1]) <= d
        if trusted is None or gate.max_jump <= 0 or near(trusted, gate.max_jump):
            return ((low, high), None), (low, high, "ACCEPT_PRIMARY")
        if waiting is not None and near(waiting, gate.confirm_tolerance):
            return ((low, high), None), (low, high, "ACCEPT_CONFIRMED")
        return (trusted, (low, high)), (*trusted, "PENDING_JUMP")

    return step


@dataclass(frozen=True)
class SceneRules:
    """Frames in a row that start or end a motion, and how long the banner of a new view stays."""

    moving_frames: int = 3
    stable_frames: int = 12
    banner_frames: int = 30


SCENE_FIELDS = [T.StructField("state", T.StringType()), T.StructField("moving_evidence", T.IntegerType()), T.StructField("stable_evidence", T.IntegerType()), T.StructField("event", T.StringType())]


def scene_step(rules: SceneRules) -> Step:
    """STABLE until enough frames in a row show motion, MOVING until enough in a row show none.

    Only the counter of the current state runs; a frame without its kind of evidence sets it to zero, and so does a change of
    state. event: MOVEMENT_STARTED or SETTLED on the frame of the change, else null. What view a camera settles in is told by
    identify_views.
    """

    def step(state: tuple[str, int] | None, row: dict) -> tuple[tuple[str, int], tuple]:
        name, run = state or ("STABLE", 0)
        seen = row["moving"] if name == "STABLE" else row["stable"]
        run = run + 1 if seen else 0
        counters = (run, 0) if name == "STABLE" else (0, run)
        need = rules.moving_frames if name == "STABLE" else rules.stable_frames
        if run >= need:
            after = "MOVING" if name == "STABLE" else "STABLE"
            return (after, 0), (after, *counters, "MOVEMENT_STARTED" if after == "MOVING" else "SETTLED")
        return (name, run), (name, *counters, None)

    return step


TRACK_FIELDS = [T.StructField("status", T.StringType()), T.StructField("anchor_frame", T.LongType()), T.StructField("failures", T.IntegerType()), T.StructField("transform", T.ArrayType(T.DoubleType()))]


def track_step(reference_frame: int = 0, warn_after: int = 20) -> Step:
    """Accumulate camera transforms: a trusted frame becomes the anchor, its transform is its delta after the anchor's.

    row: frame, accepted, delta (six doubles, from the anchor to this frame). A failed frame holds the last transform; after
    warn_after failures in a row a scene change is suspected.
    """
    still = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0]

    def product(a: list[float], b: list[float]) -> list[float]:
        return [a[r] * b[c] + a[r + 1] * b[c + 3] + (a[r + 2] if c == 2 else 0.0) for r in (0, 3) for c in range(3)]

    def step(state: tuple | None, row: dict) -> tuple[tuple | None, tuple]:
        frame = row["frame"]
        if frame < reference_frame:
            return None, ("BEFORE_REFERENCE", None, 0, still)
        if frame == reference_frame or state is None:
            return (frame, still, 0), ("REFERENCE", frame, 0, still)
        anchor, h, failures = state
        if row["accepted"]:
            h = product(row["delta"], h)
            return (frame, h, 0), ("TRACKED", frame, 0, h)
        failures += 1
        return (anchor, h, failures), ("SCENE_CHANGE_SUSPECTED" if failures >= warn_after else "HOLD_LAST_GOOD", anchor, failures, h)

    return step


VIEW_FIELDS = [T.StructField("view_id", T.IntegerType()), T.StructField("view_event", T.StringType())]


def identify_views(least_score: float) -> Step:
    """Assign each settled frame the best known view, or a new one.

    row: scores, an array of this frame's match scores with the views known so far, in their order (shorter or null: no match).
    The highest score of at least least_score wins, the earliest view on ties. State: number of views and the current one.
    """

    def step(state: tuple[int, int] | None, row: dict) -> tuple[tuple[int, int], tuple]:
        if state is None:
            return (1, 1), (1, "INITIAL_VIEW")
        n, now = state
        best, view = None, None
        for i, s in enumerate((row["scores"] or [])[:n], 1):
            if s is not None and s >= least_score and (best is None or s > best):
                best, view = s, i
        if view is None:
            return (n + 1, n + 1), (n + 1, "NEW_STABLE_VIEW")
        return (n, view), (view, "SAME_VIEW_RESTABILIZED" if view == now else "RETURN_TO_KNOWN_VIEW")

    return step
