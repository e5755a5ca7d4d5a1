"""Pictures as files: a Spark sink that writes PNG, the reader for what it wrote, and the pictures of view libraries and rejected labels.

A job's files lie in folders of their own; the last thing it writes is a list of those that count. Readers go by the lists, so a job that
fails or is still running shows nothing, and nothing has to be renamed, which object stores can't do.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from caloris.operators.kernels import pixels as K

from .store import write_json

_HEAD = b"\x89PNG\r\n\x1a\n"
SCHEMA = "name string, width int, height int, pixels binary"


def png(pixels: bytes, width: int, height: int) -> bytes:
    """An 8-bit picture as PNG: gray where there is a byte a pixel, else blue, green and red of each."""
    depth = len(pixels) // (width * height) if width > 0 and height > 0 else 0
    if depth not in (1, 3) or len(pixels) != width * height * depth:
        raise ValueError(f"{len(pixels)} bytes are no picture of {width} x {height}")
    rows = np.frombuffer(pixels, np.uint8).reshape(height, width, depth)[:, :, ::-1].reshape(height, -1)
    lines = np.concatenate([np.zeros((height, 1), np.uint8), rows], axis=1).tobytes()
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", width, height, 8, 0 if depth == 1 else 2, 0, 0, 0)
    return _HEAD + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b"")


def unpng(data: bytes) -> tuple[int, int, bytes]:
    """Width, height and pixels of what png() made; other forms of PNG and damaged files are an error."""
    if data[:8] != _HEAD:
        raise ValueError("no PNG")
    at, held = 8, {}
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if data[at + 8 + size : at + 12 + size] != struct.pack(">I", zlib.crc32(kind + body)):
            raise ValueError("the picture is damaged")
        held[kind] = held.get(kind, b"") + body
        at += 12 + size
    width, height, bits, colour, *rest = struct.unpack(">IIBBBBB", held[b"IHDR"])
    depth = {0: 1, 2: 3}.get(colour)
    lines = np.frombuffer(zlib.decompress(held[b"IDAT"]), np.uint8).reshape(height, -1)
    if bits != 8 or depth is None or any(rest) or lines[:, 0].any():
        raise ValueError("this form of PNG is not read")
    return width, height, lines[:, 1:].reshape(height, width, depth)[:, :, ::-1].tobytes()


@dataclass
class Written(WriterCommitMessage):
    task: str
    pictures: int


class PictureSink(DataSource):
    """Format `pictures`, for writing rows of name, width, height and pixels. Option path: a folder that all executors reach.

    mode("append") adds to what is there, mode("overwrite") takes its place for readers; old files stay until removed.
    """

    @classmethod
    def name(cls) -> str:
        return "pictures"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if {f.name for f in schema} != {"name", "width", "height", "pixels"}:
            raise ValueError("pictures are rows of name, width, height and pixels")
        return PictureWriter(self.options["path"], overwrite)


class PictureWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        from datetime import datetime, timezone

        self.path, self.overwrite = path.rstrip("/"), overwrite
        # jobs sort by when they began
        self.job = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"

    def _root(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Each attempt of a task has a folder of its own; only the committed attempt's is listed."""
        files, root = self._root()
        task, n, seen = f"{TaskContext.get().taskAttemptId():08d}", 0, set()
        for batch in iterator:
            for r in batch.to_pylist():
                name = r["name"]
                if not name or re.search(r"(^|/)\.{0,2}(/|$)", name) or name.startswith("/"):
                    raise ValueError(f"{name!r} is no name for a picture")
                folder = f"{root}/{self.job}/{task}/{name}".rpartition("/")[0]
                if folder not in seen:
                    files.create_dir(folder, recursive=True)
                    seen.add(folder)
                with files.open_output_stream(f"{root}/{self.job}/{task}/{name}.png") as out:
                    out.write(png(r["pixels"], r["width"], r["height"]))
                n += 1
        return Written(task, n)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = self._root()
        listed = {"job": self.job, "replaces": self.overwrite, "tasks": sorted(m.task for m in messages if m and m.pictures), "pictures": sum(m.pictures for m in messages if m)}
        files.create_dir(f"{root}/jobs", recursive=True)
        with files.open_output_stream(f"{root}/jobs/{self.job}.json") as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        files, root = self._root()
        if files.get_file_info(f"{root}/{self.job}").type != fs.FileType.NotFound:
            files.delete_dir(f"{root}/{self.job}")


def write_pictures(rows: DataFrame, path: str, mode: str = "append") -> None:
    """rows(name, width, height, pixels) as PNG files below path. A null name or pixels that don't fit the size fail the job."""
    rows.sparkSession.dataSource.register(PictureSink)
    rows.select("name", F.col("width").cast("int"), F.col("height").cast("int"), "pixels").write.format("pictures").option("path", path).mode(mode).save()


def read_pictures(spark: SparkSession, path: str) -> DataFrame:
    """name, width, height and pixels of the pictures below path that finished jobs list."""
    path = path.rstrip("/")
    jobs = spark.read.schema("job string, replaces boolean, tasks array<string>").option("multiLine", True).json(f"{path}/jobs")
    # a row a job; what came before the last that replaces is not read
    listed = sorted(map(tuple, jobs.collect()))
    since = max((i for i, (_, replaces, _) in enumerate(listed) if replaces), default=0)
    folders = [f"{path}/{job}/{task}" for job, _, tasks in listed[since:] for task in tasks]
    if not folders:
        return spark.createDataFrame([], SCHEMA)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.png").load(folders)
    name = F.regexp_extract("path", r"/\d{8}T\d+-[0-9a-f]{8}/\d+/(.*)\.png$", 1)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                width, height, pixels = unpng(b.column(1)[i].as_py())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), pa.array([width], pa.int32()), pa.array([height], pa.int32()), pa.array([pixels], pa.binary())], names=["name", "width", "height", "pixels"])

    return files.select(name.alias("name"), "content").mapInArrow(decode, SCHEMA)


def write_views(views: DataFrame, path: str) -> None:
    """A library of views: their pictures, and view_library.json with id, name, created_frame, created_timestamp_seconds and reference_image.

    views: these and width, height, bgr. The list is written last, so a library that is listed has its pictures; it is one video's, and small.
    """
    name = F.concat("name", F.lit("_reference"))
    write_pictures(views.select(name.alias("name"), "width", "height", F.col("bgr").alias("pixels")), f"{path}/views", "overwrite")
    listed = views.select("id", "name", "created_frame", "created_timestamp_seconds", F.concat(name, F.lit(".png")).alias("reference_image")).orderBy("id")
    write_json(views.sparkSession, {"views": [r.asDict() for r in listed.collect()]}, f"{path}/view_library.json")


def rejected_frames(log: DataFrame, limit: int = 30) -> DataFrame:
    """The first `limit` frames of each video whose primary reading was not taken: what is kept for a look at what went wrong."""
    rows = log.filter((F.col("was_ocr_sampled") == 1) & (F.col("status") != "ACCEPT_PRIMARY"))
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy("video_id").orderBy("frame"))).filter(F.col("nth") <= limit).drop("nth")


def debug_crops(frames: DataFrame, boxes: dict[str, dict], recipes: dict[str, str], padding: int = 6) -> DataFrame:
    """Pictures of each frame's labels, as they are and as the reader saw them: name, width, height, pixels for write_pictures().

    boxes, recipes: by label, MIN and MAX; frames as the source gives them, those without a picture are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                image = np.frombuffer(r["bgr"], np.uint8).reshape(r["height"], r["width"], 3)
                out = []
                for label, box in boxes.items():
                    crop = K.crop_padded(image, box, padding)
                    for kind, picture in (("ORIGINAL", crop), ("PRIMARY", K.prepare(crop, recipes[label]))):
                        out.append((f"{r['video_id']}/frame_{r['frame']:06d}_{kind}_{label}", picture.shape[1], picture.shape[0], np.ascontiguousarray(picture, np.uint8).tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), (pa.string(), pa.int32(), pa.int32(), pa.binary()))], names=["name", "width", "height", "pixels"])

    return frames.filter("bgr IS NOT NULL").select("video_id", "frame", "width", "height", "bgr").mapInArrow(run, SCHEMA)
