"""Comparing all rows of a group without gathering a large group in one place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Rows of a group that meet in one place; larger groups are cut into blocks of about this many.
BLOCK = 1024
#: Rows that a task holds at a time; a block pair is never cut.
BATCH_ROWS = 50_000
#: Columns that dealt() adds.
PLACE = ["low", "high"]


def dealt(rows: DataFrame, key: list[str], salt: str, block: int = BLOCK) -> DataFrame:
    """rows in partitions by key, low and high, sorted by these and side.

    A group of at most `block` rows is one block pair (0, 0). A larger one is cut into blocks by a hash of salt, and each pair of
    blocks is dealt out on its own: every two rows of a group meet in exactly one pair. side is 2 where a block meets itself, else
    0 or 1 for the two blocks. Only the keys of large groups, which are few, are written and joined.
    """
    large = rows.groupBy(*key).count().filter(F.col("count") > block)
    large = stored(large.select(*key, F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    rows = rows.join(large, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64(F.lit(5), F.col(salt)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    side = F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") == low, 0).otherwise(1)
    rows = rows.withColumns({"low": low, "high": high, "side": side}).drop("blocks", "mine", "other")
    return rows.repartition(*key, *PLACE).sortWithinPartitions(*key, *PLACE, "side")


def whole_groups(batches: Iterator[pa.RecordBatch], group: list[str], lists: tuple[str, ...] = (), rows: int = BATCH_ROWS) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Columns and group numbers of sorted rows, about `rows` at a time, no group cut; groups of one row are left out.

    lists: columns of equally long lists, which come as matrices.
    """

    def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
        c = batch.column(name)
        if name in lists:
            return c.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        return c.to_numpy(zero_copy_only=False)

    def made(c: dict[str, np.ndarray]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
        n = len(c[group[0]])
        if not n:
            return
        new = np.zeros(n, bool)
        for k in group:
            new[1:] |= c[k][1:] != c[k][:-1]
        number = np.cumsum(new)
        some = np.bincount(number)[number] > 1
        if some.any():
            yield {k: v[some] for k, v in c.items()}, number[some]

    held: list[dict[str, np.ndarray]] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append({k: column(batch, k) for k in batch.schema.names})
        n += batch.num_rows
        if n >= rows:
            c = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
            last = np.ones(n, bool)
            for k in group:
                last &= c[k] == c[k][-1]
            cut = int(np.argmax(last))
            yield from made({k: v[:cut] for k, v in c.items()})
            held, n = [{k: v[cut:] for k, v in c.items()}], n - cut
    if n:
        yield from made({k: np.concatenate([h[k] for h in held]) for k in held[0]})


def record_batches(columns: dict[str, np.ndarray], schema: pa.Schema, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    n = len(next(iter(columns.values())))
    for k in range(0, n, rows):
        yield pa.RecordBatch.from_arrays([pa.array(columns[f.name][k : k + rows], f.type) for f in schema], schema=schema)

