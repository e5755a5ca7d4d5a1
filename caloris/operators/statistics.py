"""Temperature statistics of regions, video summaries, counters and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def region_statistics(values: DataFrame, keys: list[str], value: str = "temperature") -> DataFrame:
    """min, mean, max, median, p95, p99 (exact, linear between neighbours) and count of the valid values of each group."""
    v = F.col(value)
    sound = values.filter(v.isNotNull() & ~F.isnan(v))
    spread = F.percentile(v, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    found = sound.groupBy(*keys).agg(F.min(v).alias("min_temp"), F.avg(v).alias("avg_temp"), F.max(v).alias("max_temp"), spread.alias("p"), F.count("*").alias("valid_pixel_count"))
    return found.select(*keys, "min_temp", "avg_temp", "max_temp", F.col("p")[0].alias("median_temp"), F.col("p")[1].alias("p95_temp"), F.col("p")[2].alias("p99_temp"), "valid_pixel_count")


def large_region_statistics(values: DataFrame, keys: list[str], value: str = "temperature") -> DataFrame:
    """region_statistics for groups of any size: percentiles by counts of digits, where `percentile` would hold each distinct value of a
    group in one task. Equal to it but for the last bits of a percentile between two values."""
    from .quantiles import group_quantiles

    v = F.col(value)
    sound = values.filter(v.isNotNull() & ~F.isnan(v))
    plain = sound.groupBy(*keys).agg(F.min(v).alias("min_temp"), F.avg(v).alias("avg_temp"), F.max(v).alias("max_temp"), F.count("*").alias("valid_pixel_count"))
    spread = group_quantiles(sound, keys, value, [0.5, 0.95, 0.99])
    same = None
    for k in keys:
        same = plain[k].eqNullSafe(spread[k]) if same is None else same & plain[k].eqNullSafe(spread[k])
    p = spread["quantiles"]
    return plain.join(spread, same).select(*(plain[k] for k in keys), "min_temp", "avg_temp", "max_temp", p[0].alias("median_temp"), p[1].alias("p95_temp"), p[2].alias("p99_temp"), "valid_pixel_count")


def with_empty_regions(statistics: DataFrame, skeleton: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each frame and region of skeleton; regions without valid values get nulls and a count of 0."""
    return skeleton.join(statistics, keys, "left").withColumn("valid_pixel_count", F.coalesce("valid_pixel_count", F.lit(0)))


def video_summary(log: DataFrame, name: str = "region_name") -> DataFrame:
    """Extremes and unweighted means of per-frame statistics by region name; regions without a valid frame are left out."""
    return log.filter("valid_pixel_count > 0").groupBy(name).agg(
        F.min("min_temp").alias("lowest_frame_min"), F.avg("avg_temp").alias("mean_of_frame_averages"), F.max("max_temp").alias("highest_frame_max"), F.avg("p95_temp").alias("mean_p95"), F.max("p99_temp").alias("highest_p99")
    )


def hotspots(values: DataFrame, keys: list[str], value: str, place: str) -> DataFrame:
    """min, mean, max, the first place of the maximum and the count of each group."""
    v = F.col(value)
    return values.groupBy(*keys).agg(F.min(v).alias("min_temp"), F.avg(v).alias("avg_temp"), F.max(v).alias("max_temp"), F.min_by(F.col(place), F.struct(-v, F.col(place))).alias("hotspot"), F.count(v).alias("valid_pixel_count"))


def probe(pixels: DataFrame, probes: DataFrame, radius: int = 1) -> DataFrame:
    """mean, min, max and count of the valid pixels around each probe (x, y, probe_id) of a frame; pixels: frame, x, y, temperature.

    A probe meets the pixels of its neighbourhood by key, as it is exploded to its (2 * radius + 1) squared places.
    """
    around = F.sequence(F.lit(-radius), F.lit(radius))
    places = probes.withColumn("ox", F.explode(around)).withColumn("oy", F.explode(around))
    places = places.select("probe_id", "frame", (F.col("x") + F.col("ox")).alias("x"), (F.col("y") + F.col("oy")).alias("y"))
    found = places.join(pixels.filter(F.col("temperature").isNotNull()), ["frame", "x", "y"])
    found = found.groupBy("probe_id").agg(F.avg("temperature").alias("temperature"), F.min("temperature").alias("minimum"), F.max("temperature").alias("maximum"), F.count("*").alias("sample_count"))
    out = probes.select("probe_id").join(found, "probe_id", "left")
    return out.select("probe_id", F.col("sample_count").isNotNull().alias("valid"), "temperature", "minimum", "maximum", F.coalesce("sample_count", F.lit(0)).alias("sample_count"))


# Why a place has no temperature.
PROBE_REASONS = ("OUTSIDE FRAME", "THERMAL SCALE / UI", "NO VALID THERMAL PIXELS")


def probe_reason(x: Column, y: Column, width: Column, height: Column, boxes: list[Column], valid_pixels: Column) -> Column:
    """The first reason against a place, or null. boxes: structs x, y, w, h of the scale and its labels; a null box holds nothing."""
    outside = (x < 0) | (y < 0) | (x >= width) | (y >= height)
    inside = F.lit(False)
    for b in boxes:
        inside = inside | F.coalesce((x >= b["x"]) & (x < b["x"] + b["w"]) & (y >= b["y"]) & (y < b["y"] + b["h"]), F.lit(False))
    return F.when(outside, PROBE_REASONS[0]).when(inside, PROBE_REASONS[1]).when(F.coalesce(valid_pixels, F.lit(0)) <= 0, PROBE_REASONS[2])


def counts_by(rows: DataFrame, status: str) -> DataFrame:
    """How many rows have each status."""
    return rows.groupBy(status).agg(F.count("*").alias("n"))


def sample_counters(readings: DataFrame, keys: list[str]) -> DataFrame:
    """Readings sampled, accepted at once, accepted on retry and held, and the share accepted in percent."""
    of = lambda s: F.count_if(F.col("status") == s)
    found = readings.filter(F.col("status") != "UNSAMPLED").groupBy(*keys).agg(F.count("*").alias("sampled"), of("ACCEPT_PRIMARY").alias("primary_accepted"), of("ACCEPT_RETRY").alias("retry_accepted"), of("HOLD_PREVIOUS").alias("held"))
    return found.withColumn("acceptance_rate", 100.0 * (F.col("primary_accepted") + F.col("retry_accepted")) / F.col("sampled"))


def motion_summary(log: DataFrame, keys: list[str]) -> DataFrame:
    """Extremes of the camera's motion; 0 and 1 where nothing was measured."""
    largest = lambda c, name: F.coalesce(F.max(F.abs(c)), F.lit(0.0)).alias(name)
    return log.groupBy(*keys).agg(
        F.count("*").alias("frames"), largest("dx", "max_abs_dx"), largest("dy", "max_abs_dy"), largest("translation", "max_translation"), largest("rotation_deg", "max_abs_rotation"),
        F.coalesce(F.min("scale"), F.lit(1.0)).alias("min_scale"), F.coalesce(F.max("scale"), F.lit(1.0)).alias("max_scale"),
    )


def inlier_ratio(matches: DataFrame, keys: list[str], inlier: Column) -> DataFrame:
    """Matches, inliers, their ratio (0 without matches) and score, the product of inliers and ratio."""
    found = matches.groupBy(*keys).agg(F.count("*").alias("matches"), F.count_if(inlier).alias("inliers"))
    ratio = F.when(F.col("matches") > 0, F.col("inliers") / F.col("matches")).otherwise(0.0)
    return found.withColumn("ratio", ratio).withColumn("score", F.col("inliers") * F.col("ratio"))


def receive_rate(arrivals: DataFrame, key: str, order: str, seconds: Column, last: int = 180) -> DataFrame:
    """Arrivals a second over the last `last` arrivals; 0 with fewer than two or no time between them."""
    recent = Window.partitionBy(key).orderBy(order).rowsBetween(-(last - 1), 0)
    n, span = F.count("*").over(recent), seconds - F.first(seconds).over(recent)
    return arrivals.withColumn("receive_fps", F.when((n >= 2) & (span > 0), (n - 1) / span).otherwise(0.0))


def latest_frames(frames: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """The newest row of each key: what a consumer sees that is slower than its source."""
    return frames.groupBy(key).agg(F.max_by(F.struct(order, *columns), F.col(order)).alias("r")).select(key, "r.*")
