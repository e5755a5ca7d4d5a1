"""Frame age and receive rate of running streams, kept as a table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from caloris.sources.store import write_json

NAME = "caloris_frames"
SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType()), T.StructField("frames", T.LongType()), T.StructField("cameras", T.LongType()), T.StructField("newest", T.StringType()),
    T.StructField("frame_age_seconds", T.DoubleType()), T.StructField("receive_fps", T.DoubleType()),
])


def measured(stream: DataFrame, key: str, time: str) -> DataFrame:
    """The stream, with what FrameMetrics keeps measured on its way: no pass of its own."""
    t = F.col(time).cast("timestamp")
    return stream.observe(
        NAME, F.count("*").alias("frames"), F.approx_count_distinct(key).alias("cameras"), F.max(t).cast("string").alias("newest"),
        F.max(F.unix_micros(t)).alias("newest_us"), (F.max(F.unix_micros(t)) - F.min(F.unix_micros(t))).alias("span"),
    )


class FrameMetrics(StreamingQueryListener):
    """A row of SCHEMA for each micro-batch with frames, in a small file of its own; a batch that runs again replaces its row.

    frame_age_seconds: from the newest frame's time to the batch; receive_fps: frames a second over the batch's times, 0 with fewer than two.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(NAME)
        if seen is None or not seen["frames"]:
            return
        span = seen["span"] / 1e6
        began = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")).timestamp()
        row = {
            "run_id": str(progress.runId), "batch_id": progress.batchId, "frames": seen["frames"], "cameras": seen["cameras"], "newest": seen["newest"],
            "frame_age_seconds": began - seen["newest_us"] / 1e6, "receive_fps": (seen["frames"] - 1) / span if span > 0 else 0.0,
        }
        write_json(self.spark, row, f"{self.folder}/{progress.runId}-{progress.batchId}.json")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def frame_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """What FrameMetrics has kept in a folder."""
    return spark.read.schema(SCHEMA).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder)
