"""Finding videos and stage files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def files(spark: SparkSession, folder: str, suffix: str = "mp4") -> DataFrame:
    """Files of a kind below a folder (in any case of the suffix), by path: path, filename, size, time. Contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    rows = rows.filter(F.lower("path").endswith(f".{suffix.lower()}"))
    return rows.select("path", F.regexp_extract("path", "[^/]*$", 0).alias("filename"), "length", "modificationTime").orderBy(F.lower("path"))


def by_name(wanted: DataFrame, found: DataFrame) -> DataFrame:
    """For each wanted filename the first found file of that name in any case, and how many there are."""
    rank = F.row_number().over(Window.partitionBy(F.lower("filename")).orderBy(F.lower("path")))
    n = F.count("*").over(Window.partitionBy(F.lower("filename")))
    first = found.select(F.lower("filename").alias("key"), "path", rank.alias("rank"), n.alias("matches")).filter("rank = 1").drop("rank")
    return wanted.withColumn("key", F.lower("filename")).join(first, "key", "left").drop("key")


def stage_file(explicit: Column, standard: list[Column], fallback: Column, n_fallback: Column) -> Column:
    """Where a stage's file is and how it was found: as given, in a standard place, or the only one of its name elsewhere."""
    options = [F.when(explicit.isNotNull(), F.struct(explicit.alias("path"), F.lit("explicit").alias("source")))]
    options += [F.when(p.isNotNull(), F.struct(p.alias("path"), F.lit("standard").alias("source"))) for p in standard]
    options.append(F.when(fallback.isNotNull() & (n_fallback == 1), F.struct(fallback.alias("path"), F.lit("unique").alias("source"))))
    return F.coalesce(*options, F.struct(F.lit(None).cast("string").alias("path"), F.lit("none").alias("source")))
