"""Folders with versions: a log of pointers in place of renames, so that readers see the old or the new one whole, on object stores too."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from .store import _files


class Superseded(Exception):
    """Another writer came first."""


def _log(spark: SparkSession, target: str) -> list[str]:
    fs, at = _files(spark, f"{target}/log")
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(n for n in names if n.endswith(".json") and not n.startswith("."))


def _put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, unless one of that name is there; whether it was written.

    On local disks by a link, on HDFS by a rename, both of which refuse a taken name; on object stores by a conditional put, which the
    store must have switched on (for S3A fs.s3a.create.conditional.enabled).
    """
    fs, at = _files(spark, path)
    jvm, data = spark._jvm, bytearray(text.encode())
    fs.mkdirs(at.getParent())
    scheme = fs.getUri().getScheme()
    if scheme == "file":
        place = lambda p: jvm.java.io.File(jvm.org.apache.hadoop.fs.Path(p).toUri().getPath()).toPath()
        part, files = place(f"{path}.{uuid.uuid4().hex}.part"), jvm.java.nio.file.Files
        files.write(part, data, spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 0))
        try:
            files.createLink(place(path), part)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception):
                return False
            raise
        finally:
            files.delete(part)
    whole = scheme not in ("hdfs", "viewfs", "webhdfs")
    made = at if whole else _files(spark, f"{path}.{uuid.uuid4().hex}.part")[1]
    try:
        out = fs.create(made, False)
        out.write(data)
        out.close()
    except Py4JJavaError as e:
        if "AlreadyExists" in str(e.java_exception):
            return False
        raise
    if whole or fs.rename(made, at):
        return True
    fs.delete(made, False)
    return False


def current(spark: SparkSession, target: str) -> str | None:
    """The folder of the newest version; None where there is none."""
    names = _log(spark, target)
    if not names:
        return None
    text = spark.read.text(f"{target}/log/{names[-1]}", wholetext=True).first()[0]
    return f"{target}/{json.loads(text)['folder']}"


def publish(spark: SparkSession, target: str, write: Callable[[str], None], expected: str | None = "", tries: int = 100) -> str:
    """write(folder) a new version, then point to it; its folder. An error in write leaves the old version as it is.

    expected: what current() gave when the writer began (None: nothing); Superseded if another version has come since, so that no
    update is lost. Without it the last writer wins, and every version is in the log.
    """
    folder = f"v-{uuid.uuid4().hex}"
    write(f"{target}/{folder}")
    fs, made = _files(spark, f"{target}/{folder}")
    if not fs.exists(made):
        raise ValueError(f"nothing was written for {target}")
    for _ in range(tries):
        if expected != "" and current(spark, target) != expected:
            fs.delete(made, True)
            raise Superseded(target)
        names = _log(spark, target)
        n = int(names[-1][:-5]) + 1 if names else 1
        if _put_if_absent(spark, f"{target}/log/{n:020d}.json", json.dumps({"folder": folder})):
            return f"{target}/{folder}"
    raise Superseded(target)


def publish_table(df: DataFrame, target: str, expected: str | None = "") -> str:
    """A table's next version as Parquet."""
    return publish(df.sparkSession, target, lambda folder: df.write.parquet(folder), expected)


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """The newest version; readers keep the one they opened, whatever is published meanwhile."""
    folder = current(spark, target)
    if folder is None:
        raise FileNotFoundError(target)
    return spark.read.parquet(folder)


def forget(spark: SparkSession, target: str, keep: int = 2) -> int:
    """Delete the folders of all but the newest `keep` versions; how many. The log stays."""
    names = _log(spark, target)
    fs, _ = _files(spark, target)
    gone = 0
    for name in names[: -keep or None]:
        folder = json.loads(spark.read.text(f"{target}/log/{name}", wholetext=True).first()[0])["folder"]
        gone += bool(fs.delete(_files(spark, f"{target}/{folder}")[1], True))
    return gone
