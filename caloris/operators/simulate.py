"""Test clips: from frames, a camera that is bumped and one that turns to another view and back; from a table, what a camera sees at its places."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dataset import pan_frames
from .kernels import pixels as K

_FRAME = "video_id string, frame int, timestamp_seconds double, width int, height int, bgr binary"


def turned(dx: float, dy: float, degrees: float, scale: float, width: int, height: int) -> np.ndarray:
    """The transform (2 x 3) that turns and scales about the frame's centre, then shifts."""
    a, b = scale * np.cos(np.radians(degrees)), scale * np.sin(np.radians(degrees))
    cx, cy = width / 2, height / 2
    return np.array([[a, b, (1 - a) * cx - b * cy + dx], [-b, a, b * cx + (1 - a) * cy + dy]])


def moved(frames: DataFrame, dx: float, dy: float, degrees: float, scale: float, start: int, length: int) -> DataFrame:
    """frames from a camera that is moved from frame `start` on, in equal steps over `length` frames; each frame on its own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                share = 0.0 if row.frame < start else min(1.0, (row.frame - start + 1) / max(1, length))
                image = np.frombuffer(row.bgr, np.uint8).reshape(row.height, row.width, 3)
                h = turned(dx * share, dy * share, degrees * share, 1 + (scale - 1) * share, row.width, row.height)
                out.append(K.warp(image, h).tobytes() if share else row.bgr)
            yield batch.assign(bgr=out)

    return frames.select(*(c.split()[0] for c in _FRAME.split(", "))).mapInPandas(run, _FRAME)


def switched(a: DataFrame, b: DataFrame, segments: list[tuple[str, int]], fps: float, name: str = "clip") -> DataFrame:
    """A clip after a timeline (dataset.pan_timeline) from frames of two views of one size; a view's frames repeat if they are too few."""
    sides = {}
    for key, df in (("a", a), ("b", b)):
        last = df.agg(F.max("frame")).first()[0]
        sides[key] = df.select(F.col("frame").alias("n"), F.col("bgr").alias(key), "width", "height") if key == "a" else df.select(F.col("frame").alias("n"), F.col("bgr").alias(key))
        sides[key, "last"] = last + 1
    rows = pan_frames(a.sparkSession, segments)
    for key in ("a", "b"):
        rows = rows.withColumn("n", F.col("frame") % sides[key, "last"]).join(sides[key], "n").drop("n")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                first, second = (np.frombuffer(x, np.uint8).reshape(row.height, row.width, 3) for x in (row.a, row.b))
                if "_TO_" in row.segment:
                    image = K.pan(first, second, row.fraction) if row.segment == "A_TO_B" else K.pan(second, first, row.fraction)
                else:
                    image = first if row.segment == "A" else second
                out.append((name, row.frame, row.frame / fps, row.width, row.height, np.ascontiguousarray(image).tobytes()))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _FRAME.split(", ")])

    return rows.mapInPandas(run, _FRAME)


#: Pixels that a camera's place may lie from a scene's middle, either way.
ROOM = 32


@lru_cache(maxsize=8)
def _scene(number: int, width: int, height: int) -> np.ndarray:
    """Smooth waves under noise in squares, which have corners to hold on to; ROOM wider at each side than what is seen of it."""
    height, width = height + 2 * ROOM, width + 2 * ROOM
    y, x = np.mgrid[:height, :width]
    coarse = np.random.default_rng(number).normal(0, 45, (height // 4 + 1, width // 4 + 1))
    gray = np.kron(coarse, np.ones((4, 4)))[:height, :width] + 100 + 40 * np.sin(x / 7) * np.cos(y / 5)
    return np.clip(gray, 0, 255).astype(np.uint8)


def seen(places: DataFrame, width: int = 160, height: int = 120, fps: float = 25.0) -> DataFrame:
    """Frames of a table of places: video_id, frame, scene (a whole number of zero or more), x and y (of a scene's middle, at most ROOM
    pixels off) and dark (true: nothing is seen). Whole videos stand in partitions in order, as grouped=True asks for.

    Rows with a null in any of these have no picture and go. Only numbers are shuffled; a picture is drawn where it is used.
    """
    parts = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = places.select(F.col("video_id").cast("string"), F.col("frame").cast("int"), F.col("scene").cast("long"), F.col("x").cast("int"), F.col("y").cast("int"), "dark").na.drop()
    kinds = pa.schema([("video_id", pa.string()), ("frame", pa.int32()), ("timestamp_seconds", pa.float64()), ("width", pa.int32()), ("height", pa.int32()), ("bgr", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                out = []
                for r in batch.slice(first, 64).to_pylist():
                    left, top = (ROOM + int(np.clip(r[c], -ROOM, ROOM)) for c in ("x", "y"))
                    gray = np.zeros((height, width), np.uint8) if r["dark"] else _scene(r["scene"], width, height)[top : top + height, left : left + width]
                    out.append((r["video_id"], r["frame"], r["frame"] / fps, width, height, np.repeat(gray[:, :, None], 3, 2).tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k.type) for c, k in zip(zip(*out), kinds)], schema=kinds)

    return rows.repartition(parts, "video_id").sortWithinPartitions("video_id", "frame").mapInArrow(run, _FRAME)
