"""Ordered folds over one long key in many tasks: blocks are summed up, the sums scanned, and the blocks run again from where each starts.

`ordered_fold` runs a key in one task. Where a step's effect on its state can be summed up without knowing the state it starts from, a
recording of any length is cut into blocks of frames that are handled side by side. Sums meet in blocks of sums, and those again, so no task
ever holds more than a block of either.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caloris.sources.store import stored

from .fold import SceneRules, Step, scene_step, track_step


class Scannable:
    """A step whose blocks can be summed up. Sums and states are kept as JSON."""

    inputs: list[str]
    step: Step

    def total(self, rows: Iterable[dict]) -> Any:
        """The sum of a block of rows."""
        raise NotImplementedError

    def joined(self, a: Any, b: Any) -> Any:
        """The sum of two blocks, b after a."""
        raise NotImplementedError

    def after(self, total: Any, state: Any) -> Any:
        """The state after a block that begins in `state`."""
        raise NotImplementedError


class SceneScan(Scannable):
    """Scene states: a state and its counter are one of few, so a block is a table of where each of them leads.

    A counter never passes its threshold, as the state changes there.
    """

    inputs = ["moving", "stable"]

    def __init__(self, rules: SceneRules):
        self.step = scene_step(rules)
        self.states = [("STABLE", k) for k in range(rules.moving_frames)] + [("MOVING", k) for k in range(rules.stable_frames)]
        number = {s: i for i, s in enumerate(self.states)}
        self.moves = {(m, s): [number[tuple(self.step(state, {"moving": m, "stable": s})[0])] for state in self.states] for m in (False, True) for s in (False, True)}

    def total(self, rows: Iterable[dict]) -> list[int]:
        table = list(range(len(self.states)))
        for r in rows:
            move = self.moves[bool(r["moving"]), bool(r["stable"])]
            table = [move[i] for i in table]
        return table

    def joined(self, a: list[int], b: list[int]) -> list[int]:
        return [b[i] for i in a]

    def after(self, total: list[int], state: Any) -> Any:
        return self.states[total[self.states.index(tuple(state or ("STABLE", 0)))]]


class TrackScan(Scannable):
    """Camera transforms: a block is the product of its accepted deltas, and what it does to failures and anchor.

    A sum is [state after a block that begins before any reference; whether its start counts at all; the last accepted frame, the product,
    rows since]. Products are taken block by block, so entries may differ from a fold's in their last bits.
    """

    inputs = ["frame", "accepted", "delta"]

    def __init__(self, reference_frame: int = 0, warn_after: int = 20):
        self.step, self.reference = track_step(reference_frame, warn_after), reference_frame

    def total(self, rows: Iterable[dict]) -> list:
        first, fixed, anchor, product, since = None, False, None, None, 0
        for r in rows:
            first, _ = self.step(first, r)
            if r["frame"] <= self.reference:
                fixed = True
            elif r["accepted"]:
                anchor, since = r["frame"], 0
                product = list(r["delta"]) if product is None else _product(r["delta"], product)
            else:
                since += 1
        return [first, fixed, anchor, product, since]

    def joined(self, a: list, b: list) -> list:
        first, fixed = self.after(b, a[0]), a[1] or b[1]
        if b[2] is None:
            return [first, fixed, a[2], a[3], a[4] + b[4]]
        return [first, fixed, b[2], b[3] if a[3] is None else _product(b[3], a[3]), b[4]]

    def after(self, total: list, state: Any) -> Any:
        first, fixed, anchor, product, since = total
        if fixed or state is None:
            return first
        if anchor is None:
            return [state[0], state[1], state[2] + since]
        return [anchor, _product(product, state[1]), since]


def _product(a: list[float], b: list[float]) -> list[float]:
    return [a[r] * b[c] + a[r + 1] * b[c + 3] + (a[r + 2] if c == 2 else 0.0) for r in (0, 3) for c in range(3)]


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of sorted batches by their first `keys` columns; a run's rows must be read before the next run."""
    from itertools import groupby

    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    for k, own in groupby(rows, lambda r: r[:keys]):
        yield k, (r[keys:] for r in own)


def _written(rows: Iterator[tuple], schema: T.StructType, size: int = 4096) -> Iterator[pa.RecordBatch]:
    from itertools import islice

    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema)
    while part := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*part), kinds)], schema=kinds)


def _starts(sums: DataFrame, key: str, scan: Scannable, fan: int, start: Any) -> DataFrame:
    """(key, block, start) from (key, block, total): the state in which each block begins."""
    schema = T.StructType([T.StructField(key, sums.schema[key].dataType), T.StructField("block", T.LongType()), T.StructField("start", T.StringType())])
    low, high = sums.agg(F.min("block"), F.max("block")).first()
    if low is not None and high // fan > low // fan:
        # blocks of blocks: their sums, their starts, then the blocks in each
        upper = sums.withColumn("upper", F.expr(f"block div {fan}")).repartition(key, "upper").sortWithinPartitions(key, "upper", "block").select(key, "upper", "block", "total")

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def made() -> Iterator[tuple]:
                for (k, block), rows in _runs(batches, 2):
                    total = None
                    for _, t in rows:
                        total = json.loads(t) if total is None else scan.joined(total, json.loads(t))
                    yield k, block, json.dumps(total)

            yield from _written(made(), T.StructType([schema[0], schema[1], T.StructField("total", T.StringType())]))

        above = stored(upper.mapInArrow(join, T.StructType([schema[0], schema[1], T.StructField("total", T.StringType())])))
        begun = _starts(above, key, scan, fan, start).select(F.col(key).alias("its_key"), F.col("block").alias("its_block"), "start")
        rows = upper.join(begun, upper[key].eqNullSafe(begun["its_key"]) & (upper["upper"] == begun["its_block"]))
    else:
        rows = sums.withColumn("upper", F.lit(0).cast("long")).withColumn("start", F.lit(json.dumps(start)))
    rows = rows.repartition(key, "upper").sortWithinPartitions(key, "upper", "block").select(key, "upper", "start", "block", "total")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            for (k, _, begin), blocks in _runs(batches, 3):
                state = json.loads(begin)
                for block, total in blocks:
                    yield k, block, json.dumps(state)
                    state = scan.after(json.loads(total), state)

        yield from _written(made(), schema)

    return stored(rows.mapInArrow(run, schema))


class ViewScan(Scannable):
    """The view that is seen: the last one told, the one before this row, and the last frame in which a new one was told.

    inputs: frame, seen (a view's number or null), new. State: the last view, the frame of the last new one.
    """

    inputs = ["frame", "seen", "new"]

    def step(self, state: Any, row: dict) -> tuple[Any, tuple]:
        before, told = state or (None, None)
        view, told = before if row["seen"] is None else row["seen"], row["frame"] if row["new"] else told
        return [view, told], (view, before, told)

    def total(self, rows: Iterable[dict]) -> list:
        state = None
        for r in rows:
            state, _ = self.step(state, r)
        return state

    def joined(self, a: list, b: list) -> list:
        return [x if y is None else y for x, y in zip(a, b)]

    def after(self, total: list, state: Any) -> list:
        return self.joined(state or [None, None], total)


def block_fold(df: DataFrame, key: str, order: str, scan: Scannable, fields: list[T.StructField], size: int = 1 << 16, fan: int = 1 << 12, start: Any = None, keep: list[str] | None = None) -> DataFrame:
    """key, order, the scan's inputs, the columns `keep` and what its step makes of each row: as ordered_fold gives, with no task that
    holds more than blocks.

    order: a whole number, such as a frame; a block is a range of `size` of them. Equal places of a key are in no defined order. fan: how
    many blocks' sums are scanned in one place. Null keys are one key.
    """
    rest = [c for c in dict.fromkeys([*scan.inputs, *(keep or [])]) if c not in (key, order)]
    rows = df.select(key, F.expr(f"CAST(floor(`{order}` / {size}) AS BIGINT)").alias("block"), order, *rest).repartition(key, "block").sortWithinPartitions(key, "block", order)
    names = [order, *rest]
    sums_schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("block", T.LongType()), T.StructField("total", T.StringType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = ((k, block, json.dumps(scan.total(dict(zip(names, r)) for r in own))) for (k, block), own in _runs(batches, 2))
        yield from _written(made, sums_schema)

    sums = stored(rows.mapInArrow(add, sums_schema))
    starts = _starts(sums, key, scan, fan, start).select(F.col(key).alias("its_key"), F.col("block").alias("its_block"), "start")
    begun = rows.join(starts, rows[key].eqNullSafe(starts["its_key"]) & (rows["block"] == starts["its_block"]))
    begun = begun.select(key, "block", "start", order, *rest).repartition(key, "block").sortWithinPartitions(key, "block", order)
    schema = T.StructType([df.schema[key], df.schema[order], *(df.schema[c] for c in rest), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple]:
            for (k, _, begin), own in _runs(batches, 3):
                state = json.loads(begin)
                for r in own:
                    state, values = scan.step(state, dict(zip(names, r)))
                    yield k, *r, *values

        yield from _written(made(), schema)

    return begun.mapInArrow(run, schema).select(key, order, *rest, *(f.name for f in fields))

