"""State machines over a key's rows in the order of their times: steps that know the time, and deadlines that pass without a row.

A machine's state is made of lists, numbers, texts, booleans and None, so that it can be kept as JSON. Batches run a machine over sorted
rows (`ordered_machine`), streams over a buffer that the watermark releases (caloris.streaming.event_time); both through `advance`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fold import SCALE_FIELDS, ScaleGate, Step, confirm_step

Made = tuple[Any, list[tuple]]


class Machine:
    """row() and due() return the state after, and the values of `fields` for each row that they give out."""

    fields: list[T.StructField]

    def seeded(self, seed: dict) -> Any:
        """The state of a key that starts with a seed."""
        raise NotImplementedError

    def row(self, state: Any, at: int, row: dict) -> Made:
        raise NotImplementedError

    def deadline(self, state: Any) -> int | None:
        """When due() is to be called if nothing comes first."""
        return None

    def due(self, state: Any, at: int) -> Made:
        raise NotImplementedError


def advance(machine: Machine, state: Any, rows: Iterable[tuple[int, Any, dict]], until: int | None) -> Iterator[tuple[Any, int, Any, tuple | None, tuple]]:
    """(state, at, order, row, values) for rows in order, and for the deadlines up to `until` (None: all): those without order or row.

    A deadline at the time of a row comes before it.
    """

    def passed(state: Any, limit: int | None) -> Iterator[tuple[Any, int, list[tuple]]]:
        while (d := machine.deadline(state)) is not None and (limit is None or d <= limit):
            state, out = machine.due(state, d)
            yield state, d, out

    for at, order, row in rows:
        for state, d, out in passed(state, at):
            yield from ((state, d, None, None, v) for v in out or [None])
        state, out = machine.row(state, at, row)
        yield from ((state, at, order, row, v) for v in out or [None])
    for state, d, out in passed(state, until):
        yield from ((state, d, None, None, v) for v in out or [None])


@dataclass
class StepMachine(Machine):
    """A step of caloris.operators.fold, which needs no time."""

    step: Step
    fields: list[T.StructField]
    start: Any = None

    def row(self, state: Any, at: int, row: dict) -> Made:
        state, made = self.step(self.start if state is None else state, row)
        return state, [made]


READING_FIELDS = [*SCALE_FIELDS, T.StructField("submitted", T.BooleanType())]
# What a live scale is before its first reading, and after a reader failed.
SEEDED, WAITING, RAISED = "REFERENCE_SCALE", "WAITING", "ERROR_HOLD_PREVIOUS"


class ReadingMachine(Machine):
    """Scales from a reader that takes its time: at most one reading in flight, at most one begun in each interval.

    row: low, high, latency (milliseconds the reading takes), raised (it ended in an error). A row is given to the reader if none is
    busy and the interval since the last has passed; its result goes through the rule of confirmed jumps when it is due and holds for
    the rows from then on, never for those before. A failed reading clears a waiting jump, an error does not. Each result that arrives is
    a row of its own, without an order; submitted is null there.
    """

    fields = READING_FIELDS

    def __init__(self, gate: ScaleGate, hz: float = 3.0):
        self.step, self.interval = confirm_step(gate), 1000.0 / hz

    def seeded(self, seed: dict) -> Any:
        return [[seed["low"], seed["high"]], None, SEEDED, None, None]

    def row(self, state: Any, at: int, row: dict) -> Made:
        trusted, waiting, status, flight, last = state or [None, None, WAITING, None, None]
        submit = flight is None and (last is None or at - last >= self.interval)
        if submit:
            flight, last = [at + int(row["latency"] or 0), row["low"], row["high"], bool(row["raised"])], at
        state = [trusted, waiting, status, flight, last]
        if submit and flight[0] <= at:
            state = self._received(state)
        return state, [(*(state[0] or (None, None)), state[2], submit)]

    def deadline(self, state: Any) -> int | None:
        return state[3][0] if state and state[3] else None

    def due(self, state: Any, at: int) -> Made:
        state = self._received(state)
        return state, [(*(state[0] or (None, None)), state[2], None)]

    def _received(self, state: Any) -> Any:
        trusted, waiting, _, flight, last = state
        if flight[3]:
            return [trusted, waiting, RAISED, None, last]
        (trusted, waiting), made = self.step((trusted, waiting), {"low": flight[1], "high": flight[2]})
        return [trusted, waiting, made[2], None, last]


STATUS_FIELDS = [T.StructField("status", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("reconnects", T.IntegerType())]


@dataclass
class StatusMachine(Machine):
    """IDLE, CONNECTING, CONNECTED, RECONNECTING, STOPPED: a camera's state from its reads.

    row: ok. The first row opens the camera: read, it is CONNECTED, failed, it is RECONNECTING. `failures` failed reads in a row drop a
    connection. A camera that is RECONNECTING reads nothing; once `delay` ms (500 at least) have passed it is CONNECTING, without a row,
    and the next row tells whether it opens. `silence` ms without a row stop it (None: never); a row after that opens it anew. A row is
    given out for each change of state. IDLE is the state before the first row, never given out.
    """

    failures: int = 3
    delay: int = 2000
    silence: int | None = None
    fields = STATUS_FIELDS

    def __post_init__(self):
        self.delay = max(500, self.delay)

    # state: status, failed reads in a row, reconnects, when it was entered or the last row came
    def row(self, state: Any, at: int, row: dict) -> Made:
        status, failed, count, since = state or ["IDLE", 0, 0, at]
        ok = bool(row["ok"])
        if status == "RECONNECTING":
            return [status, failed, count, since], []
        out = []
        if status in ("IDLE", "STOPPED"):
            out.append(("CONNECTING", "OPENED", count))
            status = "CONNECTING"
        if status == "CONNECTED":
            failed = 0 if ok else failed + 1
            if failed >= self.failures:
                return ["RECONNECTING", 0, count + 1, at], [("RECONNECTING", "READ_FAILED", count + 1)]
            return [status, failed, count, at], []
        made = ("CONNECTED", "READ", count) if ok else ("RECONNECTING", "OPEN_FAILED", count)
        return [made[0], 0, count, at], [*out, made]

    def deadline(self, state: Any) -> int | None:
        if not state or state[0] == "STOPPED":
            return None
        if state[0] == "RECONNECTING":
            return state[3] + self.delay
        return None if self.silence is None else state[3] + self.silence

    def due(self, state: Any, at: int) -> Made:
        status, _, count, _ = state
        made = ("CONNECTING", "DELAY_PASSED", count) if status == "RECONNECTING" else ("STOPPED", "SILENT", count)
        return [made[0], 0, count, at], [made]


def ordered_machine(df: DataFrame, key: str, time: str, order: str, inputs: list[str], machine: Machine, seeds: dict | None = None) -> DataFrame:
    """key, at (milliseconds), order, inputs and the machine's fields: what a stream of the same rows gives in the end, none of them late.

    time: a timestamp; equal times go by order, a long. Deadlines after a key's last row pass too. seeds: by key, for a few keys.
    """
    rows = df.select(key, (F.unix_millis(F.col(time).cast("timestamp"))).alias("at"), F.col(order).cast("long").alias(order), *inputs)
    fields = [*rows.schema.fields, *machine.fields]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        blank = [None] * len(inputs)

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), k.type) for c, k in zip(zip(*out), kinds)], schema=kinds)

        out: list[tuple] = []
        now, state, begun = None, None, False

        def put(made) -> Any:
            after = state
            for after, at, place, row, values in made:
                if values is not None:
                    out.append((now, at, place, *(blank if row is None else row.values()), *values))
            return after

        for batch in batches:
            for k, at, place, *values in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or k != now:
                    state = put(advance(machine, state, [], None)) if begun else None
                    now, begun, state = k, True, machine.seeded(seeds[k]) if seeds and k in seeds else None
                state = put(advance(machine, state, [(at, place, dict(zip(inputs, values)))], at))
            if out:
                yield batch_of(out)
                out.clear()
        if begun:
            put(advance(machine, state, [], None))
            if out:
                yield batch_of(out)

    return rows.repartition(key).sortWithinPartitions(key, "at", order).mapInArrow(run, schema)
