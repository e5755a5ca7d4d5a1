"""Exact quantiles of groups of any size, by counts of digits: four passes whose sums merge, and no group in one place.

A double is seen as a 64-bit number of the same order. Each pass counts the next 16 bits of those values that still share their leading bits with
a wanted one, so a group leaves at most 65,536 counts a task and wanted prefix, and after four passes the value itself is known, ties and all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caloris.sources.store import stored

_TOP = np.uint64(1 << 63)


def _ordered(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles; both zeros are one."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >= _TOP, ~bits, bits | _TOP)


def _double(numbers: np.ndarray) -> np.ndarray:
    return np.where(numbers >= _TOP, numbers ^ _TOP, ~numbers).view(np.float64)


def _digits(rows: DataFrame, step: int) -> DataFrame:
    """(group, prefix, digit, n): how many values of a group with a wanted prefix have each next digit. rows: group, value, prefixes."""
    shift = np.uint64(48 - 16 * step)
    schema = T.StructType([rows.schema["group"], T.StructField("prefix", T.LongType()), T.StructField("digit", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            # what a row carries with it is alike for all rows of a group, so one look at each distinct pair is enough
            groups = batch.column(0).dictionary_encode()
            code = groups.indices.to_numpy()
            numbers = _ordered(batch.column(1).to_numpy(zero_copy_only=False))
            first = np.unique(code, return_index=True)[1]
            wanted = {int(code[i]): batch.column(2)[int(i)].as_py() for i in first}
            prefix = (numbers >> shift >> np.uint64(16)).astype(np.int64)
            keep = np.zeros(len(code), bool)
            for g, some in wanted.items():
                own = code == g if len(wanted) > 1 else np.ones(len(code), bool)
                keep |= own & (np.isin(prefix, some) if step else True)
            digit = ((numbers >> shift) & np.uint64(0xFFFF)).astype(np.int64)
            table = np.stack([code[keep].astype(np.int64), prefix[keep], digit[keep]])
            pairs, n = np.unique(table, axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([groups.dictionary.take(pa.array(pairs[0])), pa.array(pairs[1]), pa.array(pairs[2].astype(np.int32)), pa.array(n)], names=schema.names)

    return rows.mapInArrow(run, schema).groupBy("group", "prefix", "digit").agg(F.sum("n").alias("n"))


def group_quantiles(values: DataFrame, keys: list[str], value: str, shares: list[float], salts: int = 16) -> DataFrame:
    """keys and `quantiles`, an array of the values at these shares of each group, linear between neighbours, and `n`.

    Exact, whatever a group's size; nulls and NaN are left out, groups of nothing else too. Null keys are one key. What is joined to the
    values is small and is dealt over `salts` places a group, so that no key gathers in one task. Rows are read five times.
    """
    v = F.col(value).cast("double")
    rows = values.select(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("group"), v.alias("value"), *keys).filter(v.isNotNull() & ~F.isnan(v))
    sizes = stored(rows.groupBy("group", *keys).agg(F.count("*").alias("n")))
    place = lambda s: F.lit(float(s)) * (F.col("n") - 1)
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(place(s)), F.ceil(place(s))) for s in shares))))
    # a wanted rank, counted from 0 among the values that share its prefix
    wanted = sizes.select("group", F.explode(ranks).alias("rank")).select("group", "rank", F.col("rank").alias("left"), F.lit(0).cast("long").alias("prefix"))
    for step in range(4):
        salted = wanted.groupBy("group").agg(F.collect_set("prefix").alias("prefixes")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        sought = rows.withColumn("salt", F.pmod(F.xxhash64("value", F.spark_partition_id()), F.lit(salts)).cast("int")).join(salted, ["group", "salt"])
        counts = _digits(sought.select("group", "value", "prefixes"), step)
        before = F.sum("n").over(Window.partitionBy("group", "prefix").orderBy("digit")) - F.col("n")
        counts = counts.withColumn("before", before)
        found = wanted.join(counts, ["group", "prefix"]).filter((F.col("left") >= F.col("before")) & (F.col("left") < F.col("before") + F.col("n")))
        wanted = stored(found.select("group", "rank", (F.col("left") - F.col("before")).alias("left"), F.expr("shiftleft(prefix, 16) | digit").alias("prefix")))

    def doubles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(_double(b.column(2).to_numpy().view(np.uint64)))], names=["group", "rank", "value"])

    held = wanted.select("group", "rank", "prefix").mapInArrow(doubles, "group string, rank long, value double")
    held = held.groupBy("group").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))

    def between(s: float):
        low, high = F.col("at")[F.floor(place(s))], F.col("at")[F.ceil(place(s))]
        return F.when(low == high, low).otherwise(low + (high - low) * (place(s) - F.floor(place(s))))

    return sizes.join(held, "group").select(*keys, F.array(*(between(s) for s in shares)).alias("quantiles"), "n")
