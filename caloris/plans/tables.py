"""The driver's tables in the roles of the engine's: events as a sensor log, orders and line items as settings and frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as readings: a region for each user, its events in time order as frames, value as temperature, props.k as gray level."""
    events = table(spark, sf_dir, "events")
    frame = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    gray = F.get_json_object("props", "$.k").try_cast("int")
    return events.select("event_id", F.col("user_id").alias("region"), frame.cast("int").alias("frame"), "ts", F.col("event_type").alias("kind"), F.col("value").alias("temperature"), gray.alias("gray"))


#: The same in SQL.
READINGS = """readings AS (
  SELECT event_id, user_id AS region, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS frame, ts,
         event_type AS kind, value AS temperature, CAST(json_extract_string(props, '$.k') AS INTEGER) AS gray
  FROM events)"""
