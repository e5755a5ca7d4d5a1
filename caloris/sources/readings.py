"""Readers of scale readings, regions and scale settings, with fixed schemas."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caloris.functions.text import finite

from .store import read_json, write_json

REGIONS = "video struct<filename:string,width:int,height:int,fps:double,total_frames:int,reference_frame_number:int>, regions array<struct<id:int,name:string,shape_type:string,pixel_points:array<array<int>>,normalized_points:array<array<double>>>>"
SCALE = (
    "video struct<filename:string,width:int,height:int,fps:double,total_frames:int>, scale struct<bar_roi:array<int>,max_text_roi:array<int>,min_text_roi:array<int>,"
    "bar_horizontal_inner_fraction:double,display_decimal_places:int,ocr_padding_pixels:int,min_ocr_method:string,min_ocr_psm:int,max_ocr_method:string,max_ocr_psm:int,"
    "reference_ocr_min_temp:double,reference_ocr_max_temp:double,min_scale_span_c:double>"
)


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key: the last by order."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("r")).select(*keys, "r.*")


def json_objects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row for each file; absent keys are null, files that are no JSON give nulls alone."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def regions(spark: SparkSession, path: str) -> DataFrame:
    rows = json_objects(spark, path, REGIONS).select("video.filename", "video.width", "video.height", F.inline("regions"))
    points = F.transform("pixel_points", lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return rows.select("filename", "width", "height", F.col("id").alias("region_id"), F.col("name").alias("region_name"), "shape_type", points.alias("pixel_points"))


def scale_settings(spark: SparkSession, path: str) -> DataFrame:
    box = lambda c, n: F.struct(*(F.col(f"scale.{c}")[i].alias(k) for i, k in enumerate("xywh"))).alias(n)
    rows = json_objects(spark, path, SCALE)
    return rows.select("video.filename", box("bar_roi", "bar"), box("max_text_roi", "max_box"), box("min_text_roi", "min_box"), F.coalesce("scale.bar_horizontal_inner_fraction", F.lit(0.2)).alias("inner_fraction"), F.coalesce("scale.display_decimal_places", F.lit(1)).alias("decimals"), F.coalesce("scale.ocr_padding_pixels", F.lit(6)).alias("padding"), "scale.min_ocr_method", "scale.min_ocr_psm", "scale.max_ocr_method", "scale.max_ocr_psm", "scale.reference_ocr_min_temp", "scale.reference_ocr_max_temp", F.coalesce("scale.min_scale_span_c", F.lit(5.0)).alias("min_span"))


def cached_scale(spark: SparkSession, path: str, total_frames: int) -> DataFrame:
    """frame, scale_min, scale_max of scale readings in CSV. Rows that don't parse, lie outside the video, or whose maximum isn't
    above the minimum are skipped; of repeated frames the last row counts."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in ("frame", "clean_min_temp_used", "clean_max_temp_used")])
    header = spark.read.option("header", True).csv(path)
    missing = [f.name for f in text if f.name not in header.columns]
    if missing:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    rows = header.withColumn("ord", F.monotonically_increasing_id()).select(F.col("frame").try_cast("int").alias("frame"), finite(F.col("clean_min_temp_used")).alias("scale_min"), finite(F.col("clean_max_temp_used")).alias("scale_max"), "ord")
    rows = rows.filter(F.col("frame").between(0, total_frames - 1) & (F.col("scale_max") > F.col("scale_min")))
    return last_wins(rows, ["frame"], "ord").select("frame", "scale_min", "scale_max")


def preset(spark: SparkSession, path: str, build: Callable[[], dict]) -> dict:
    """The scale settings held at a path, or those that build gives, which are then held there."""
    found = read_json(spark, path)
    if found is None:
        found = build()
        write_json(spark, found, path)
    return found


def checked(df: DataFrame, ok: Column, message: str) -> DataFrame:
    """df; its evaluation fails with the message where ok doesn't hold."""
    first = df.columns[0]
    return df.withColumn(first, F.when(F.coalesce(ok, F.lit(False)), F.col(first)).otherwise(F.raise_error(F.lit(message))))
