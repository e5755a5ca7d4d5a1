"""Consumers of live frames that are slower than their source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_only(write):
    """For foreachBatch: hand write(batch, id) the newest row of each camera, as a consumer slower than its source would see them."""

    def each(batch: DataFrame, batch_id: int, key: str = "video_id", order: str = "frame") -> None:
        rest = [c for c in batch.columns if c != key]
        write(batch.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("r")).select(key, "r.*"), batch_id)

    return each


def rate_limited(df: DataFrame, time: str, hz: float, key: str, delay: str = "10 seconds") -> DataFrame:
    """At most one row in each interval of 1 / hz seconds and key, where readings are made elsewhere. Late rows go by the watermark.

    caloris.operators.machines.ReadingMachine limits the rate and brings the results back to the rows after them.
    """
    interval = f"{max(1, round(1e6 / hz))} microseconds"
    stamped = df.withWatermark(time, delay)
    return stamped.groupBy(F.window(time, interval), key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), F.col(time)).alias("r")).select(key, "r.*")
