"""Recorded rows as a stream that arrives in a given order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from caloris.sources.store import own_folder


def arrivals(df: DataFrame, batch: Column, batches: int, folder: str | None = None, first: int = 0, files: int = 1) -> str:
    """Write rows in the order in which they are to arrive, `files` files for each number of `batch` (from first to batches - 1); the folder."""
    folder = folder or own_folder(df.sparkSession, "arrivals")
    for k in range(first, batches):
        df.filter(batch == k).repartition(files).write.mode("append").parquet(folder)
    return folder


def replayed(spark: SparkSession, folder: str, like: DataFrame, files: int = 1) -> DataFrame:
    """The stream of what arrivals() wrote, a batch of it in each micro-batch."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).parquet(folder)
