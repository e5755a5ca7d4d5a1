"""Frames as a table: a Spark data source (batch and stream) over decoders that plug in, live cameras, and frame ranges."""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from .readers import draw

SCHEMA = "video_id string, frame int, timestamp_seconds double, width int, height int, bgr binary"


class Decoder(Protocol):
    """What a video must offer: its size and rate, and any range of its frames."""

    width: int
    height: int
    fps: float
    total_frames: int

    def read(self, first: int, last: int) -> Iterator[np.ndarray]: ...


class SyntheticDecoder:
    """A moving test picture: a gray ramp as colour bar at the right, a warm scene with a hot spot that wanders. texture: a seed of
    smooth noise that gives corners to hold on to. low, high: scale labels, drawn below and above the bar's place. ends_at: the file breaks
    off before this frame, whatever its head says."""

    def __init__(self, options: dict[str, str]):
        self.width, self.height = int(options.get("width", 64)), int(options.get("height", 48))
        self.fps, self.total_frames = float(options.get("fps", 25)), int(options.get("frames", 10))
        self.texture, self.labels = options.get("texture"), (options.get("low"), options.get("high"))
        self.ends_at = int(options.get("ends_at", self.total_frames))

    def read(self, first: int, last: int) -> Iterator[np.ndarray]:
        y, x = np.mgrid[: self.height, : self.width]
        noise: np.ndarray | float = 0.0
        if self.texture is not None:
            coarse = np.random.default_rng(int(self.texture)).normal(0, 45, (self.height // 4 + 2, self.width // 4 + 2))
            noise = np.kron(coarse, np.ones((4, 4)))[: self.height, : self.width]
        for n in range(first, min(last + 1, self.ends_at)):
            gray = noise + 60 + 40 * np.sin(x / 7) * np.cos(y / 5)
            gray += 120 * np.exp(-((x - 10 - n % 20) ** 2 + (y - self.height / 2) ** 2) / 18)
            gray[:, -8:] = np.linspace(255, 0, self.height)[:, None]
            bgr = np.repeat(np.clip(gray, 0, 255).astype(np.uint8)[:, :, None], 3, 2)
            for text, top in zip(self.labels, (self.height - 30, 4), strict=True):
                if text is not None:
                    bgr[top : top + 26, 4:140] = 20
                    draw(bgr, 6, top + 2, text)
            yield bgr


def check_video(width: int, height: int, fps: float, total_frames: int) -> None:
    """An error for a file without size, rate or frames."""
    if min(width, height, total_frames) <= 0 or not fps > 0:
        raise ValueError("the video has no size, rate or frames")


class OpenCvDecoder:
    """Files and streams by OpenCV, which must be installed where tasks run."""

    def __init__(self, options: dict[str, str]):
        try:
            import cv2
        except ImportError as e:
            raise RuntimeError("decoding video files needs the cv2 package on the executors") from e
        self.cv2, self.video = cv2, cv2.VideoCapture(options["path"])
        if not self.video.isOpened():
            raise ValueError("the video can't be opened")
        self.width, self.height, self.total_frames = (int(self.video.get(k)) for k in (cv2.CAP_PROP_FRAME_WIDTH, cv2.CAP_PROP_FRAME_HEIGHT, cv2.CAP_PROP_FRAME_COUNT))
        self.fps = float(self.video.get(cv2.CAP_PROP_FPS))
        if "live" not in options:
            check_video(self.width, self.height, self.fps, self.total_frames)

    def newest(self) -> np.ndarray | None:
        """The frame that a live stream shows now; None where it has ended."""
        ok, image = self.video.read()
        return image if ok else None

    def read(self, first: int, last: int) -> Iterator[np.ndarray]:
        self.video.set(self.cv2.CAP_PROP_POS_FRAMES, first)
        for _ in range(first, last + 1):
            ok, image = self.video.read()
            if not ok:
                return
            yield image


DECODERS = {"synthetic": SyntheticDecoder, "opencv": OpenCvDecoder}


_ARROW = pa.schema([("video_id", pa.string()), ("frame", pa.int32()), ("timestamp_seconds", pa.float64()), ("width", pa.int32()), ("height", pa.int32()), ("bgr", pa.binary())])
#: Bytes of pictures that go to Spark at a time.
BATCH_BYTES = 16 << 20


def read_range(options: dict[str, str], first: int, last: int) -> Iterator[pa.RecordBatch]:
    """Frames first to last. Where the decoder ends before them, the option missing says what comes: `skip` nothing, `null` rows without
    picture and size, `error` an error."""
    d = DECODERS[options.get("decoder", "synthetic")](options)
    name, held, size, missing = options.get("video_id", options.get("path", "video")), [], 0, options.get("missing", "skip")

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _ARROW)], schema=_ARROW)

    at = lambda n: n / d.fps if d.fps > 0 else None
    n = first - 1
    for n, image in enumerate(d.read(first, last), first):
        held.append((name, n, at(n), image.shape[1], image.shape[0], image.tobytes()))
        size += image.nbytes
        if size >= BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if n < last and missing == "error":
        raise OSError(f"{name} ends before frame {n + 1} of {last}")
    if n < last and missing == "null":
        held += [(name, k, at(k), None, None, None) for k in range(n + 1, last + 1)]
    if held:
        yield batch()


class FrameRange(InputPartition):
    def __init__(self, first: int, last: int, video: int = 0):
        self.first, self.last, self.video = first, last, video


class FrameSource(DataSource):
    """Format `frames`. Options: decoder, path, video_id, start_frame, end_frame, max_frames, frames_per_partition, missing; the decoder's; and
    videos, a JSON list of such options for several videos, each over the common ones."""

    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FrameReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return FrameStream(dict(self.options))


class FrameReader(DataSourceReader):
    """One partition for each range of frames, so that one long video is read in parallel.

    Filters on frame and video_id are taken at planning: only videos and ranges that hold wanted frames become partitions, and a frame
    in a range is reached by seeking. Needs spark.sql.python.filterPushdown.enabled, which register() sets.
    """

    def __init__(self, options: dict[str, str]):
        common = {k: v for k, v in options.items() if k != "videos"}
        self.videos = [{**common, **{k: str(v) for k, v in one.items()}} for one in json.loads(options["videos"])] if "videos" in options else [common]
        self.wanted: dict[str, set | None] = {"frame": None, "video_id": None}
        self.low, self.high = 0, (1 << 31) - 1

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in self.wanted and isinstance(f, (EqualTo, In)):
                values = set(f.value) if isinstance(f, In) else {f.value}
                held = self.wanted[column]
                self.wanted[column] = values if held is None else held & values
            elif column == "frame" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, f.value + isinstance(f, GreaterThan))
            elif column == "frame" and isinstance(f, (LessThan, LessThanOrEqual)):
                self.high = min(self.high, f.value - isinstance(f, LessThan))
            elif not (column in self.wanted and isinstance(f, IsNotNull)):  # neither is ever null
                yield f

    def partitions(self) -> list[FrameRange]:
        out = []
        for i, o in enumerate(self.videos):
            names, frames = self.wanted["video_id"], self.wanted["frame"]
            if names is not None and o.get("video_id", o.get("path", "video")) not in names:
                continue
            d = DECODERS[o.get("decoder", "synthetic")](o)
            check_video(d.width, d.height, d.fps, total := d.total_frames)
            first, last = frame_range(int(o.get("start_frame", 0)), o.get("end_frame"), o.get("max_frames"), total)
            first, last = max(first, self.low), min(last, self.high)
            step = max(1, int(o.get("frames_per_partition", 256)))
            spans = [(first, last)] if frames is None else _spans(sorted(f for f in frames if f is not None and first <= f <= last))
            out += [FrameRange(k, min(b, k + step - 1), i) for a, b in spans for k in range(a, b + 1, step)]
        return out

    def read(self, partition: FrameRange | None) -> Iterator[pa.RecordBatch]:
        # without any range Spark still asks once
        return iter(()) if partition is None else read_range(self.videos[partition.video], partition.first, partition.last)


def _spans(frames: list[int]) -> list[tuple[int, int]]:
    """Runs of neighbours in a sorted list."""
    out: list[tuple[int, int]] = []
    for f in frames:
        if out and f <= out[-1][1] + 1:
            out[-1] = (out[-1][0], f)
        else:
            out.append((f, f))
    return out


def frames_of(videos: DataFrame, options: dict[str, str] | None = None, frames_per_partition: int = 256, tasks: int | None = None) -> DataFrame:
    """The frames of a table of videos of any number: videos has video_id, path and total_frames, and may have first_frame and last_frame.

    Ranges are rows that Spark deals out (over `tasks`, if given), so nothing is planned on the driver; a filter on the videos leaves the
    others unread. options: those of the format `frames` for all of them. Nulls in path, video_id or total_frames give no frames.
    """
    options = dict(options or {})
    last = F.col("total_frames") - 1
    last = F.least(last, F.coalesce("last_frame", last)) if "last_frame" in videos.columns else last
    first = F.greatest(F.lit(0), F.coalesce("first_frame", F.lit(0))) if "first_frame" in videos.columns else F.lit(0)
    rows = videos.select("video_id", "path", first.cast("int").alias("first"), last.cast("int").alias("last")).filter("video_id IS NOT NULL AND path IS NOT NULL AND first <= last")
    step = max(1, frames_per_partition)
    rows = rows.withColumn("first", F.explode(F.sequence(F.col("first"), F.col("last"), F.lit(step)))).withColumn("last", F.least("last", F.col("first") + step - 1))
    rows = rows.repartition(tasks, "video_id", "first") if tasks else rows.repartition("video_id", "first")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield from read_range({**options, "video_id": r["video_id"], "path": r["path"]}, r["first"], r["last"])

    return rows.mapInArrow(read, SCHEMA)


def missing_frames(frames: DataFrame, videos: DataFrame) -> DataFrame:
    """(video_id, first, last): the runs of frames that videos(video_id, total_frames) promise and frames lack, or hold without a picture."""
    held = frames.filter("bgr IS NOT NULL") if "bgr" in frames.columns else frames
    ends = held.select("video_id", F.col("frame").cast("long").alias("frame")).union(videos.select("video_id", F.lit(-1).cast("long")))
    totals = videos.filter("total_frames > 0").select("video_id", F.col("total_frames").cast("long").alias("frame"))
    order = Window.partitionBy("video_id").orderBy("frame")
    gaps = ends.join(totals.select("video_id"), "video_id", "left_semi").union(totals).distinct().withColumn("before", F.lag("frame").over(order))
    return gaps.filter("frame - before > 1").select("video_id", (F.col("before") + 1).alias("first"), (F.col("frame") - 1).alias("last"))


def reference_frame(requested: Column, override: Column, total: Column) -> Column:
    """The frame that a set-up rests on: the override if given, else the one asked for, else 0, within the video; null for one without frames."""
    return F.when(total > 0, F.least(F.greatest(F.coalesce(override, requested, F.lit(0)), F.lit(0)), total - 1))


class FrameStream(DataSourceStreamReader):
    """The frames of a recorded video that Spark's log doesn't hold yet, in order, in partitions of frames_per_partition.

    Offsets are frame numbers, and where a batch starts comes from the log alone: a restarted query goes on where it ended, and reads
    what a video has grown by. A batch can be read again by its offsets. Live streams are the format `cameras`.
    """

    def __init__(self, options: dict[str, str]):
        self.options, self.part = options, max(1, int(options.get("frames_per_partition", 256)))

    def initialOffset(self) -> dict:
        return {"frame": 0}

    def latestOffset(self) -> dict:
        return {"frame": DECODERS[self.options.get("decoder", "synthetic")](self.options).total_frames}

    def partitions(self, start: dict, end: dict) -> list[FrameRange]:
        return [FrameRange(k, min(end["frame"], k + self.part) - 1) for k in range(start["frame"], end["frame"], self.part)]

    def read(self, partition: FrameRange) -> Iterator[pa.RecordBatch]:
        return read_range(self.options, partition.first, partition.last)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


LIVE_SCHEMA = f"{SCHEMA}, received_at timestamp, status string"
#: Open cameras of this worker process, by address; a worker keeps them from batch to batch.
_OPEN: dict[str, object] = {}
#: Failed reads in a row that drop a connection, and the seconds between them.
FAILURES, PAUSE = 3, 0.03


class SyntheticCamera(SyntheticDecoder):
    """A camera that shows the test picture. down: addresses that can't be reached; fail_every: how many pictures a connection lasts."""

    def __init__(self, options: dict[str, str]):
        if options.get("path") in options.get("down", "").split(","):
            raise ValueError("the camera can't be reached")
        super().__init__(options)
        self.n, self.fail_every = 0, int(options.get("fail_every", 0))

    def newest(self) -> np.ndarray | None:
        self.n += 1
        return None if self.fail_every and self.n % self.fail_every == 0 else next(self.read(self.n, self.n))


CAMERAS = {"synthetic": SyntheticCamera, "opencv": OpenCvDecoder}


class Camera(InputPartition):
    def __init__(self, name: str, tick: int):
        self.name, self.tick = name, tick


class CameraSource(DataSource):
    """Format `cameras`: live streams, each read by a task of its own, the newest picture with each batch.

    Options: cameras (addresses, comma-separated), decoder, reconnect_seconds, ticks_per_second; and the decoder's. A picture that is
    not the newest is never shown. frame counts batches. status is CONNECTED, or RECONNECTING for a row without a picture: a camera that
    can't be opened, or FAILURES reads in a row that fail; it is tried again with the next batch, reconnect_seconds later (0.5 at least). A
    worker keeps its cameras open from batch to batch; one that Spark replaces opens them anew. Offsets are ticks of the clock, so they go on
    after a restart; a batch that is run again shows the newest picture then, as a live stream can't be read twice.
    """

    @classmethod
    def name(cls) -> str:
        return "cameras"

    def schema(self) -> str:
        return LIVE_SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return CameraStream(dict(self.options))


class CameraStream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.options, self.rate = options, float(options.get("ticks_per_second", 10))

    def initialOffset(self) -> dict:
        return {"tick": 0}

    def latestOffset(self) -> dict:
        return {"tick": int(time.time() * self.rate)}

    def partitions(self, start: dict, end: dict) -> list[Camera]:
        return [Camera(c, end["tick"]) for c in self.options["cameras"].split(",")] if end["tick"] > start["tick"] else []

    def read(self, partition: Camera) -> Iterator[tuple]:
        name, wait = partition.name, max(0.5, float(self.options.get("reconnect_seconds", 2)))
        image, status = None, "RECONNECTING"
        held = _OPEN.get(name)
        if not isinstance(held, float) or time.time() - held >= wait:
            try:
                if held is None or isinstance(held, float):
                    held = CAMERAS[self.options.get("decoder", "synthetic")]({**self.options, "path": name, "live": "1"})
                for k in range(FAILURES):
                    if k:
                        time.sleep(PAUSE)
                    if (image := held.newest()) is not None:
                        break
            except (ValueError, OSError):
                image = None
            # a camera that fails is closed; in its place stands when that was
            _OPEN[name] = held if image is not None else time.time()
        if image is not None:
            status = "CONNECTED"
        size = (image.shape[1], image.shape[0]) if image is not None else (None, None)
        yield (name, partition.tick % (1 << 31), None, *size, image.tobytes() if image is not None else None, datetime.now(timezone.utc), status)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


def frame_age(received_at: Column) -> Column:
    """Seconds from when a picture came in to the start of the batch that shows it; 0 for one that came in since."""
    return F.greatest(F.lit(0.0), (F.unix_micros(F.current_timestamp()) - F.unix_micros(received_at)) / 1e6)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FrameSource)
    spark.dataSource.register(CameraSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def frame_range(start: int, end: int | str | None, most: int | str | None, total: int) -> tuple[int, int]:
    """First and last frame of a range within the video; a start beyond it or an empty range is an error."""
    start = max(0, start)
    last = total - 1 if end is None else min(int(end), total - 1)
    if most is not None:
        if int(most) <= 0:
            raise ValueError("max_frames must be positive")
        last = min(last, start + int(most) - 1)
    if start >= total:
        raise ValueError("the range starts after the video")
    if last < start:
        raise ValueError("the range ends before it starts")
    return start, last


def clamp_range(start: Column, end: Column, most: Column, total: Column) -> tuple[Column, Column]:
    """The same as columns; an empty range where it is an error there."""
    first = F.greatest(F.lit(0), start)
    last = F.least(F.coalesce(end, total - 1), total - 1)
    return first, F.least(last, F.coalesce(first + most - 1, last))


def looped_frame(seconds: Column, duration: Column, fps: Column, total: Column) -> Column:
    """The frame nearest to a time in a clip that repeats, halves to even."""
    return F.least(F.greatest(F.rint(F.pmod(seconds, duration) * fps).cast("int"), F.lit(0)), total - 1)
