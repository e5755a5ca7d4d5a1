"""What the text operators share: input selection, Arrow row mapping, durable intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word, for Spark, DuckDB and Python alike; bytes.split() cuts at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows and bytes of text handed to a row function at once, so that only a slice of an Arrow batch is held as Python objects; a longer
#: text is a slice of its own.
SLICE_ROWS, SLICE_BYTES = 1024, 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fold_is(id_col: str, folds: int, fold: int) -> Column:
    """True where crc32(id as text) mod folds is fold; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def map_texts(df: DataFrame, keep: list[str], text_col: str, start: Callable[[], Callable], fields: list[T.StructField]) -> DataFrame:
    """Columns `keep` of df, then `fields` as the function that start() gives makes them of a list of texts.

    start() runs once a task; what its function holds is given back when the task ends, as Python workers wait for later stages.
    Texts come as str or None; the function returns one list for each field. Only the kept columns and the text leave the JVM. A kept
    column of the same name as a made one gives way to it.
    """
    keep = [k for k in keep if k not in {f.name for f in fields}]
    held = list(dict.fromkeys([*keep, text_col]))
    schema = T.StructType([*(df.schema[k] for k in keep), *fields])
    arrow = T.StructType(fields)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(arrow)
        f = start()
        for batch in batches:
            given = batch.column(held.index(text_col))
            sizes = pc.list_value_length(given) if pa.types.is_list(given.type) else pc.binary_length(given)
            ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False))
            stop = 0
            while stop < batch.num_rows:
                at, before = stop, ends[stop - 1] if stop else 0
                stop = min(at + SLICE_ROWS, max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right"))))
                part = batch.slice(at, stop - at)
                made = f(part.column(held.index(text_col)).to_pylist())
                columns = [part.column(held.index(k)) for k in keep]
                columns += [pa.array(v, type=k.type) for v, k in zip(made, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *kinds.names])
        f = batch = given = sizes = part = made = columns = None
        pa.default_memory_pool().release_unused()

    return df.select(*held).mapInArrow(rows, schema)


def neutral(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with its columns named c0, c1, ..., so that none clashes with what an operator makes, and the new names by the old."""
    names = {k: f"c{i}" for i, k in enumerate(df.columns)}
    return df.select(*(F.col(f"`{k}`").alias(c) for k, c in names.items())), names


def restored(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns that neutral() renamed, under their old names; all others go."""
    return df.select(*(F.col(c).alias(k) for k, c in names.items()))


def shared_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir, or, if all runs on this machine, below a folder of it."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = _own_root(spark)
    return f"{root.rstrip('/')}/caloris-{uuid.uuid4().hex}"


def _own_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="caloris-"))
    return sc._jsc.sc().getCheckpointDir().get()


def stored(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: lineage ends there, and lost executors lose nothing of it."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete what stored() wrote for these frames."""
    for df in frames:
        for file in df.inputFiles()[:1]:
            folder = file.rsplit("/", 1)[0]
            jvm = df.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
