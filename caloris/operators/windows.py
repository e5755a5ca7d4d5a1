"""Operators over a video's frames in order that need no memory of their own decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def _so_far(key: str, order: str) -> WindowSpec:
    return Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def sampled(frame: Column, first: Column, last: Column, every: int) -> Column:
    """Every n-th frame from the first, and the last."""
    return ((frame - first) % every == 0) | (frame == last)


def carry_forward(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Each column's last value so far that is not null."""
    return df.withColumns({c: F.last(c, ignorenulls=True).over(_so_far(key, order)) for c in columns})


def streak(df: DataFrame, key: str, order: str, flag: Column, name: str) -> DataFrame:
    """How many rows in a row, up to this one, have the flag."""
    on = flag.cast("int")
    islands = df.withColumn("__on", F.coalesce(on, F.lit(0))).withColumn("__island", F.sum(1 - F.col("__on")).over(_so_far(key, order)))
    run = Window.partitionBy(key, "__island").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return islands.withColumn(name, F.sum("__on").over(run)).drop("__on", "__island")


def changes(df: DataFrame, key: str, order: str, state: str) -> DataFrame:
    """The rows whose state differs from the row before, with that state as from_state; a key's first row is no change."""
    before = F.lag(state).over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("from_state", before).filter(F.col("from_state").isNotNull() & (F.col("from_state") != F.col(state)))


def banner(df: DataFrame, key: str, order: str, event: Column, frames: int, state: str, shown: str) -> Column:
    """The state shown: `shown` for so many frames from an event on, else the state."""
    last = F.last(F.when(event, F.col(order)), ignorenulls=True).over(_so_far(key, order))
    return F.when(F.col(order) - last < frames, F.lit(shown)).otherwise(F.col(state))
