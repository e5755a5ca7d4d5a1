"""Machines over streams whose rows arrive late or out of order.

Rows wait in a buffer of Spark's state until the watermark has passed them, then go through the machine in the order of their times; a
timer at the next row or deadline releases them. A row behind the watermark comes too late for its place: it is given out at once with
late = true and changes no state. Results depend on rows and watermarks, not on how rows fall into batches.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from caloris.operators import fold, machines
from caloris.operators.machines import Machine, advance

#: The buffer's rows lie in slots of this many milliseconds at least, so that a release reads and rewrites few of them.
SLOT = 60_000
#: Keys share so many groups. Spark's calls to and from a state cost far more than a row, so they are made for a group, not for a key.
GROUPS = 512


def _plain(v: Any) -> Any:
    return None if v is None or (isinstance(v, float) and v != v) or v is pd.NaT else v.item() if hasattr(v, "item") else v


class EventTimeProcessor(StatefulProcessor):
    """State of a group of keys: their machines', the timer that is set and the earliest time in each slot as JSON; the buffer by slots,
    each a JSON list of [key, at, order, inputs...]."""

    def __init__(self, key: str, order: str, inputs: list[str], machine: Machine, slot: int):
        self.key, self.order, self.inputs, self.machine, self.slot = key, order, inputs, machine, slot
        self.columns = [key, "at", order, *inputs, *(f.name for f in machine.fields), "late"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("machines", T.StructType([T.StructField("held", T.StringType())]))
        self.buffer = handle.getMapState("buffer", T.StructType([T.StructField("slot", T.LongType())]), T.StructType([T.StructField("rows", T.StringType())]))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        states, timer, slots = self._read()
        for row in initialState.itertuples(index=False, name=None):
            seed = {c: _plain(v) for c, v in zip(initialState.columns, row)}
            states[seed.pop("__name")] = self.machine.seeded(seed)
        self._keep(states, timer, timer, slots)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        late, arrived = [], {}
        blank = [None] * len(self.machine.fields)
        for batch in rows:
            for name, at, *values in zip(*(batch[c].tolist() for c in (self.key, "at", self.order, *self.inputs))):
                name, at, values = _plain(name), int(at), [_plain(v) for v in values]
                if at <= watermark:
                    late.append((name, at, *values, *blank, True))
                else:
                    arrived.setdefault(at // self.slot, []).append([name, at, *values])
        if arrived:
            states, timer, slots = self._read()
            for slot, more in arrived.items():
                old = json.loads(self.buffer.getValue((slot,))[0]) if slot in slots else []
                self.buffer.updateValue((slot,), (json.dumps(old + more),))
                slots[slot] = min([r[1] for r in more] + ([slots[slot]] if slot in slots else []))
            earliest = min(slots[slot] for slot in arrived)
            self._keep(states, timer, earliest if timer is None else min(timer, earliest), slots)
        yield self._table(late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        states, timer, slots = self._read()
        ready: dict[Any, list] = {}
        for slot in [k for k, first in slots.items() if first <= watermark]:
            wait = []
            for r in json.loads(self.buffer.getValue((slot,))[0]):
                if r[1] > watermark:
                    wait.append(r)
                else:
                    ready.setdefault(r[0], []).append(r)
            if wait:
                self.buffer.updateValue((slot,), (json.dumps(wait),))
                slots[slot] = min(r[1] for r in wait)
            else:
                self.buffer.removeKey((slot,))
                del slots[slot]
        following, out = list(slots.values()), []
        blank = [None] * len(self.inputs)
        for name in {**states, **dict.fromkeys(ready)}:
            state, mine = states.get(name), ready.get(name, [])
            deadline = self.machine.deadline(state)
            if mine or (deadline is not None and deadline <= watermark):
                mine.sort(key=lambda r: (r[1], r[2] is None, r[2]))
                rows = ((r[1], r[2], dict(zip(self.inputs, r[3:]))) for r in mine)
                for state, at, order, row, values in advance(self.machine, state, rows, watermark):
                    if values is not None:
                        out.append((name, at, order, *(blank if row is None else row.values()), *values, False))
                states[name], deadline = state, self.machine.deadline(state)
            if deadline is not None:
                following.append(deadline)
        # the timer that has expired is gone already
        self._keep(states, None, min(following, default=None), slots)
        yield self._table(out)

    def _table(self, rows: list[tuple]) -> pd.DataFrame:
        # objects, as a column of whole numbers and None would become one of floats
        return pd.DataFrame(rows, columns=self.columns, dtype=object)

    def _read(self) -> tuple[dict, int | None, dict[int, int]]:
        """States by key, the timer, the earliest time by slot."""
        if not self.held.exists():
            return {}, None, {}
        states, timer, slots = json.loads(self.held.get()[0])
        return {k: v for k, v in states}, timer, {k: v for k, v in slots}

    def _keep(self, states: dict, old: int | None, timer: int | None, slots: dict[int, int]) -> None:
        if timer != old:
            if old is not None:
                self.handle.deleteTimer(old)
            if timer is not None:
                self.handle.registerTimer(timer)
        self.held.update((json.dumps([list(states.items()), timer, list(slots.items())]),))

    def close(self) -> None:
        pass


def stream_machine(
    df: DataFrame, key: str, time: str, order: str, inputs: list[str], machine: Machine, delay: str, seeds: DataFrame | None = None, slot: int = SLOT, groups: int = GROUPS
) -> DataFrame:
    """key, at (milliseconds), order, inputs, the machine's fields and late, of a stream with a timestamp `time`.

    delay: how far the watermark stays behind the latest time. Equal times go by order, a long. inputs: booleans, numbers and texts. seeds:
    a table of key and the columns of machine.seeded(), one row a key; keys start from it. Rows still before the watermark wait for later
    rows of any key to move it. Needs the RocksDB state store (streaming_session). A null time is late at once. The processor travels
    whole, as Spark starts it on the driver in a process that files added to the session don't reach.

    Neither slot nor groups changes a result. slot: a few of them should cover the delay. groups: of keys that keep their state together, to
    be raised where a group would have many thousands of keys; a checkpoint goes on with the number it began with.
    """
    for module in (sys.modules[__name__], machines, fold):
        cloudpickle.register_pickle_by_value(module)
    # the time as a plain number: with the watermark's own column Spark would drop late rows before they could be counted
    millis = F.coalesce(F.unix_millis(F.col(time).cast("timestamp")), F.lit(-1))
    # as text, which stays as it is beside nulls
    kind = df.schema[key].dataType
    name = F.col(key).cast(kind).cast("string")
    group = F.pmod(F.xxhash64(name), F.lit(groups)).cast("int").alias("__group")
    rows = df.withWatermark(time, delay).select(group, name.alias(key), millis.alias("at"), F.col(order).cast("long").alias(order), *inputs)
    kinds = [*rows.schema.fields[1:], *machine.fields, T.StructField("late", T.BooleanType())]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in kinds])
    processor = EventTimeProcessor(key, order, inputs, machine, slot)
    start = None if seeds is None else seeds.select(group, name.alias("__name"), *(c for c in seeds.columns if c != key)).groupBy("__group")
    found = rows.groupBy("__group").transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime", initialState=start)
    return found.select(F.col(key).cast(kind).alias(key), *(c for c in found.columns if c != key))


def sound_seeds(seeds: DataFrame, engine: str) -> DataFrame:
    """key columns, low and high of the seeds that this engine may start from: made by itself, both labels finite.

    Seeds of another engine may rest on its mistakes; such keys wait for a reading of their own.
    """
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return seeds.filter((F.lower("engine") == engine.lower()) & finite("low") & finite("high")).drop("engine")


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session with the RocksDB state store beside the given one, whose settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(k, spark.conf.get(k))
    return own
