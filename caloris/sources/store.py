"""Sinks: cut lineage durably, tables as files, small JSON written whole, directories promoted whole."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of this machine where that is unset and all runs here."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        root = sc.getConf().get("spark.checkpoint.dir")
        if not root and not runs_here(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(root or tempfile.mkdtemp(prefix="caloris-"))
    return sc._jsc.sc().getCheckpointDir().get()


def runs_here(master: str) -> bool:
    """Whether all of a session runs in one process: local, local[8], local[*, 3]; not local-cluster."""
    return master == "local" or master.startswith("local[")


#: Folders of the scopes that are open, the innermost last.
_SCOPES: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """What stored(), drained() and arrivals() write within is deleted in the end: for a query with its action, as its tables are gone after.

        with scratch(spark):
            queries["region_stats_large"](spark, folder).write.parquet(out)

    Without a scope such tables stay below spark.checkpoint.dir, to be removed with it. Scopes nest; they are the driver's, not a thread's.
    """
    folder = f"{shared_root(spark).rstrip('/')}/scope-{uuid.uuid4().hex}"
    _SCOPES.append(folder)
    try:
        yield folder
    finally:
        _SCOPES.remove(folder)
        fs, at = _files(spark, folder)
        fs.delete(at, True)


def own_folder(spark: SparkSession, kind: str) -> str:
    """A new folder's name below the innermost scope, or below the shared root."""
    root = _SCOPES[-1] if _SCOPES else shared_root(spark).rstrip("/")
    return f"{root}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again, so that a lost executor loses nothing of it."""
    path = own_folder(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """df computed once and written to the shared folder."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def drained(stream: DataFrame) -> DataFrame:
    """What a stream gives for the input there is now, as a table in the shared folder."""
    spark = stream.sparkSession
    folder = own_folder(spark, "stream")
    q = stream.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def write_csv(df: DataFrame, path: str) -> None:
    """Rows as CSV with a header; nulls are empty, booleans 0 or 1."""
    shown = [F.col(n).cast("int").alias(n) if kind == "boolean" else F.col(n) for n, kind in df.dtypes]
    df.select(*shown).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def tracked_regions(log: DataFrame) -> DataFrame:
    """One row for each video and frame with its regions nested, in region order; log has a row for each frame and region."""
    item = F.struct("region_id", "region_name", "pixel_points", "normalized_points")
    return log.groupBy("video_id", "frame", "timestamp_seconds", "status").agg(F.array_sort(F.collect_list(item)).alias("regions"))


def complete_log(videos: DataFrame, log: DataFrame) -> DataFrame:
    """A row for every frame of videos(video_id, fps, total_frames); frames that log lacks are MISSING and still."""
    frames = videos.filter("total_frames > 0").select("video_id", "fps", F.explode(F.sequence(F.lit(0), F.col("total_frames") - 1)).alias("frame"))
    still = {"h00": 1.0, "h01": 0.0, "h02": 0.0, "h10": 0.0, "h11": 1.0, "h12": 0.0}
    both = frames.join(log, ["video_id", "frame"], "left")
    both = both.withColumns({k: F.coalesce(k, F.lit(v)) for k, v in still.items()} | {"status": F.coalesce("status", F.lit("MISSING"))})
    return both.withColumn("timestamp_seconds", F.when(F.col("fps") > 0, F.col("frame") / F.col("fps"))).drop("fps")


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path: local disks, HDFS and object stores alike."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def write_json(spark: SparkSession, value: Any, path: str) -> None:
    """A small document, complete or not at all: written beside its place, then renamed."""
    fs, part = _files(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(json.dumps(value, ensure_ascii=False, indent=2, allow_nan=False).encode()))
    finally:
        out.close()
    replace_file(spark, part.toString(), path)


def read_json(spark: SparkSession, path: str) -> Any:
    """A small document; None where there is none."""
    fs, at = _files(spark, path)
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())) if fs.exists(at) else None


def replace_file(spark: SparkSession, made: str, target: str) -> None:
    """Put a finished file in the place of another; one that is missing or empty is refused, and the old one stays."""
    fs, new = _files(spark, made)
    if not fs.exists(new) or not fs.getFileStatus(new).getLen():
        raise ValueError(f"nothing to put in place in {made}")
    _swap(spark, made, target)


def promote(spark: SparkSession, made: str, target: str) -> None:
    """Put a finished folder in the place of another. The old one comes back if that fails. An empty folder is refused."""
    fs, new = _files(spark, made)
    if not fs.exists(new) or not len(fs.listStatus(new)):
        raise ValueError(f"nothing to promote in {made}")
    _swap(spark, made, target)


def _swap(spark: SparkSession, made: str, target: str) -> None:
    fs, at = _files(spark, target)
    old = _files(spark, f"{target}.{uuid.uuid4().hex}.old")[1]
    held = fs.exists(at)
    if held and not fs.rename(at, old):
        raise OSError(f"{target} can't be moved away")
    if not fs.rename(_files(spark, made)[1], at):
        if held:
            fs.rename(old, at)
        raise OSError(f"{made} can't be moved to {target}")
    if held:
        fs.delete(old, True)


def coco(images: DataFrame, annotations: DataFrame, categories: list[str], folder: str) -> None:
    """The three tables of a labelled dataset as JSON lines."""
    spark = images.sparkSession
    images.write.mode("overwrite").json(f"{folder}/images")
    annotations.write.mode("overwrite").json(f"{folder}/annotations")
    spark.createDataFrame([(i, c, "equipment") for i, c in enumerate(categories, 1)], "id int, name string, supercategory string").coalesce(1).write.mode("overwrite").json(f"{folder}/categories")
