"""Gray levels, the intensity-to-temperature table, temperature maps and region statistics from frames.

Frames are BINARY (blue, green, red for each pixel, row by row). Kernels read a frame where it is scanned and give a row for each
region, so pixels never enter a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kernels import pixels as K


def gray_level(b: Column, g: Column, r: Column) -> Column:
    """Brightness of a pixel, in 15-bit fixed point."""
    return F.shiftright(b * 3735 + g * 19235 + r * 9798 + 16384, 15)


def is_neutral(b: Column, g: Column, r: Column, difference: int) -> Column:
    """Whether a pixel's channels differ by little: thermal picture, not coloured overlay."""
    return F.greatest(b, g, r) - F.least(b, g, r) <= difference


def row_medians(pixels: DataFrame, row: list[str], value: str) -> DataFrame:
    """The median of each row of a scale bar: what its levels are read from."""
    return pixels.groupBy(*row).agg(F.median(value).alias("level"))


def nearest_levels(palette: DataFrame) -> DataFrame:
    """For each intensity 0 to 255 the row of palette(row, gray, temp) of the nearest gray level, the first row on ties.

    Levels are medians of bytes, so at most 511 differ: the first row of each is found by partial aggregates, and these few become
    an array in one row.
    """
    item = F.struct("row", "gray", "temp")
    levels = palette.groupBy("gray").agg(F.min(F.struct("row", "temp")).alias("first")).select("gray", "first.row", "first.temp")
    bar = levels.agg(F.array_sort(F.collect_list(item)).alias("bar"))
    rows = bar.withColumn("intensity", F.explode(F.sequence(F.lit(0), F.lit(255))))
    ranked = F.transform("bar", lambda p: F.struct(F.abs(p["gray"] - F.col("intensity")).alias("d"), p["row"].alias("row"), p["gray"].alias("gray"), p["temp"].alias("temp")))
    return rows.select("intensity", F.array_min(ranked).alias("p")).filter("p IS NOT NULL").select("intensity", "p.row", "p.gray", "p.temp")


def overlay_label(name: Column, low: Column, high: Column, mean: Column | None = None) -> Column:
    """A region's caption: its name and temperatures to one decimal."""
    shown = [name, F.format_string("%.1f", low), *([F.format_string("%.1f", mean)] if mean is not None else []), F.format_string("%.1f", high)]
    text = shown[0]
    for part in shown[1:]:
        text = F.concat(text, F.lit(" | "), part)
    return F.when(low.isNull(), F.concat(name, F.lit(" | NO VALID PIXELS"))).otherwise(text)


REGION_SCHEMA = (
    "video_id string, frame int, timestamp_seconds double, region_id int, region_name string, scale_min_temp double, scale_max_temp double, min_temp double, "
    "avg_temp double, max_temp double, median_temp double, p95_temp double, p99_temp double, valid_pixel_count long, hotspot_x int, hotspot_y int"
)


def temperature_log(frames: DataFrame, regions: list[dict], bar: dict, inner_fraction: float = 0.2, difference: int = 18, erode: int = 0, decimals: int | None = None) -> DataFrame:
    """A row for each frame and region: temperatures of the region's neutral pixels, by the frame's own colour bar.

    frames: video_id, frame, timestamp_seconds, width, height, bgr, scale_min_temp, scale_max_temp (nulls: no scale, empty rows).
    regions: id, name and points of one video's regions, which the task gets with the code. bar: x, y, w, h. decimals: that temperatures
    have, if percentiles are to keep to them.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        masks: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                size = (row.height, row.width)
                if size not in masks:
                    masks[size] = [K.erode(K.fill_polygon(r["points"], *size), erode) for r in regions]
                bgr = np.frombuffer(row.bgr, np.uint8).reshape(row.height, row.width, 3)
                stats = [None] * len(regions)
                if pd.notna(row.scale_min_temp) and pd.notna(row.scale_max_temp):
                    gray = K.gray(bgr)
                    table = K.level_table(K.crop(gray, bar), row.scale_min_temp, row.scale_max_temp, inner_fraction)
                    stats = K.region_statistics(table[gray], K.neutral(bgr, difference), masks[size], decimals)
                for r, s in zip(regions, stats, strict=True):
                    values = s or (None,) * 6 + (0, None, None)
                    out.append((row.video_id, row.frame, row.timestamp_seconds, r["id"], r["name"], row.scale_min_temp, row.scale_max_temp, *values))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in REGION_SCHEMA.split(", ")])

    needed = ("video_id", "frame", "timestamp_seconds", "width", "height", "bgr", "scale_min_temp", "scale_max_temp")
    return frames.select(*needed).mapInPandas(run, REGION_SCHEMA)


def polygon_spans(points: list[tuple[float, float]], height: int, width: int) -> list[tuple[int, int, int]]:
    """A filled polygon as runs (y, first x, last x): a small table to join pixels with."""
    mask = K.fill_polygon(points, height, width)
    out = []
    for y in np.flatnonzero(mask.any(1)).tolist():
        edges = np.flatnonzero(np.diff(np.r_[0, mask[y].astype(np.int8), 0]))
        out += [(y, int(a), int(b) - 1) for a, b in edges.reshape(-1, 2)]
    return out
