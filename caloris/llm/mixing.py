"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

Targets: sources share the total size by weight, each at most max_epochs times its own size; what a capped source can't take is
shared again by weight among the others, until none is above its cap. Each round is one aggregate over the table of sources, so any
number of sources is spread over tasks; rounds end when no further source is capped.

Taking: a source whose target is r times its size takes every document floor(r) times, and the documents whose seeded hash is at
most a threshold once more. The threshold is where the running size in hash order comes nearest to the rest of the target: a
histogram of hashes finds its bin, one within that bin a bin of that, and only the rows of the last, one in 16 million of a source,
are put in order. Each source so misses its target by half a document at most. The threshold is joined to the documents, so no
source is gathered in one place.

Defined results: a null or empty text has size 0 and is taken 0 words. A null source is a source of its own, the last. Rows with
equal ids (or null ids) fall on the same side of the threshold. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, neutral, restored, stored

#: Bits of a hash below each of the two histograms' bins; a hash has 60.
BIN_BITS = (48, 36)
#: Adds `weight` to a table of sources.
Weights = Callable[[DataFrame], DataFrame]


def size_of(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Weights, max_epochs: float = 3.0) -> DataFrame:
    """sizes(source, source_size) and then target. One row for each source."""
    rows = weights(sizes).withColumn("weight", F.col("weight").cast("double")).withColumn("cap", max_epochs * F.col("source_size"))
    rows = stored(rows.select("source", "source_size", "weight", "cap", (F.col("cap") / F.col("weight")).alias("top")))
    total, weight = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = (total or 0) / weight if weight else 0.0, -1
    while True:
        over = F.col("top") < level
        n, taken, free = rows.agg(F.count(F.when(over, 1)), F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("weight")))).first()
        if n == capped or not free:
            break
        level, capped = ((total or 0) - (taken or 0.0)) / free, n
    return rows.select("source", "source_size", F.least("cap", F.col("weight") * level).alias("target"))


def cycle_weights(*weights: float) -> Weights:
    """Weights for the sources in code-point order, null last, that repeat after the last.

    A source's place is its place in its range of sources, after those of the ranges before: only their numbers reach the driver.
    """

    def add(sources: DataFrame) -> DataFrame:
        order = F.col("source").asc_nulls_last()
        parts = stored(sources.repartitionByRange(order).withColumn("__part", F.spark_partition_id()))
        before, at = {}, 0
        for r in sorted(parts.groupBy("__part").count().collect(), key=lambda r: r["__part"]):
            before[r["__part"]], at = at, at + r["count"]
        offset = F.get(F.array(*(F.lit(before.get(k, 0)) for k in range(max(before, default=0) + 1))), F.col("__part"))
        place = offset + F.row_number().over(Window.partitionBy("__part").orderBy(order)) - 1
        return parts.withColumn("weight", F.get(F.array(*(F.lit(float(w)) for w in weights)), place % len(weights))).drop("__part")

    return add


def plan(sized: DataFrame, weights: Weights, max_epochs: float = 3.0, seed: int = 11) -> DataFrame:
    """One row for each source of sized(id, source, size): source, source_size, target, whole (times each document is taken) and
    threshold (hash up to which a document is taken once more; null for none)."""
    hashed = sized.select("source", "size", hash_of("id", seed).alias("h"))
    bins = stored(hashed.groupBy("source", F.shiftright("h", BIN_BITS[0]).alias("bin")).agg(F.sum("size").alias("size")))
    sources = targets(bins.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # a ratio that rounding left just under a whole number is that number
    whole = F.floor(ratio + 1e-9)
    sources = stored(sources.withColumn("whole", whole).withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    edge = sources.filter("rest > 0").select("source", F.lit(0).cast("long").alias("base"), "rest")
    edge = stored(_edge(bins.alias("r").join(edge.alias("e"), same(bins, edge)).select("r.source", "bin", "size", "base", "rest")))
    inside = _inside(hashed, edge, BIN_BITS[0]).groupBy("source", F.shiftright("h", BIN_BITS[1]).alias("bin")).agg(F.sum("size").alias("size"), F.first("base").alias("base"), F.first("rest").alias("rest"))
    edge = stored(_edge(inside))
    inside = _inside(hashed, edge, BIN_BITS[1]).groupBy("source", "h").agg(F.sum("size").alias("size"), F.first("base").alias("base"), F.first("rest").alias("rest"))
    taken = F.col("base") + F.sum("size").over(Window.partitionBy("source").orderBy("h"))
    inside = inside.withColumn("miss", F.abs(taken - F.col("rest"))).select("source", "h", "miss", F.lit(None).cast("long").alias("bin"))
    # taking none of the bin's documents is a choice as well: its hashes start above the last threshold
    none = edge.select("source", F.lit(None).cast("long").alias("h"), (F.col("rest") - F.col("base")).alias("miss"), "bin")
    best = inside.unionByName(none).groupBy("source").agg(F.min_by(F.struct("h", "bin"), F.struct("miss", F.coalesce("h", F.lit(-1)))).alias("best"))
    best = best.select("source", F.coalesce("best.h", F.shiftleft(F.col("best.bin"), BIN_BITS[1]) - 1).alias("threshold"))
    joined = sources.join(best, same(sources, best), "left")
    return joined.select(sources["source"], "source_size", "target", F.col("whole").cast("long").alias("whole"), "threshold")


def _edge(bins: DataFrame) -> DataFrame:
    """(source, bin, base, rest): of bins(source, bin, size, base, rest) the one in which the running size, from base on, reaches the rest."""
    end = F.col("base") + F.sum("size").over(Window.partitionBy("source").orderBy("bin"))
    spread = bins.withColumn("end", end).withColumn("begin", F.col("end") - F.col("size")).filter("begin < rest AND rest <= end")
    return spread.groupBy("source").agg(F.min("bin").alias("bin"), F.min("begin").alias("base"), F.min("rest").alias("rest"))


def _inside(hashed: DataFrame, edge: DataFrame, bit: int) -> DataFrame:
    """Rows of hashed in their source's bin."""
    both = hashed.alias("h").join(edge.alias("e"), F.col("h.source").eqNullSafe(F.col("e.source")) & (F.shiftright("h.h", bit) == F.col("e.bin")))
    return both.select("h.source", "h.h", "h.size", "e.base", "e.rest")


def hash_of(id_col: str, seed: int) -> Column:
    """0 to 2 ** 60 - 1, by a row's id: the first 15 hexadecimal digits of a digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def mix(df: DataFrame, weights: Weights, max_epochs: float = 3.0, seed: int = 11, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of df, then size, source_size, target and times (how often the mix takes the document)."""
    keep = [k for k in (df.columns if keep is None else keep) if k not in ("size", "source_size", "target", "times")]
    sized = stored(df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size_of(text_col).alias("size")))
    found = stored(plan(sized, weights, max_epochs, seed))
    rows, columns = (sized, []) if set(keep) <= {id_col} else (df, keep)
    if rows is sized:
        rows = sized.select(*(F.col("id").alias(k) for k in keep), F.col("source").alias("__source"), F.col("size").alias("__size"), hash_of("id", seed).alias("__h"))
        columns = keep
    else:
        rows = df.select(*keep, F.col(source_col).alias("__source"), size_of(text_col).alias("__size"), hash_of(id_col, seed).alias("__h"))
    of = found.select(F.col("source").alias("__of"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), "whole", "threshold")
    both = rows.join(of, F.col("__source").eqNullSafe(F.col("__of")))
    times = F.col("whole") + F.coalesce((F.col("__h") <= F.col("threshold")).cast("long"), F.lit(0))
    return both.select(*columns, F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), times.alias("times"))


def repeated(df: DataFrame, weights: Weights, **options) -> DataFrame:
    """The mix itself: rows of df, each as often as the mix takes it."""
    own, names = neutral(df)
    columns = {f"{k}_col": names[options.pop(f"{k}_col", default)] for k, default in (("id", "doc_id"), ("source", "source"), ("text", "text"))}
    mixed = mix(own, weights, **columns, **options).filter("times > 0")
    return restored(mixed.withColumn("n", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))), names)
