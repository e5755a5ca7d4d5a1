"""Folds in blocks against folds in order."""

import random

import pytest
from pyspark.sql import functions as F

from caloris.operators import fold
from caloris.operators.scan import SceneScan, TrackScan, block_fold


def frames(spark, n=500, videos=("a", "b", None), seed=1):
    rng = random.Random(seed)
    rows = []
    for v in videos:
        for f in range(rng.randint(0, 9), n):
            if rng.random() < 0.9:
                rows.append((v, f, rng.random() < 0.6, rng.random() < 0.7 if rng.random() < 0.9 else None, rng.random() < 0.5, [1.0, 0.0, float(rng.randint(-3, 3)), 0.0, 1.0, float(rng.randint(-3, 3))]))
    return spark.createDataFrame(rows, "video string, frame long, moving boolean, stable boolean, accepted boolean, delta array<double>").repartition(5)


@pytest.mark.parametrize(("size", "fan"), [(7, 2), (40, 100), (1 << 16, 1 << 12), (1, 3)])
def test_scene_states(spark, size, fan):
    df, rules = frames(spark), fold.SceneRules(2, 4, 5)
    found = block_fold(df, "video", "frame", SceneScan(rules), fold.SCENE_FIELDS, size, fan)
    want = fold.ordered_fold(df, "video", ["frame"], ["moving", "stable"], fold.scene_step(rules), fold.SCENE_FIELDS)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


@pytest.mark.parametrize(("reference", "size", "fan"), [(0, 9, 2), (123, 16, 3), (123, 1000, 50), (10**6, 32, 2)])
def test_camera_track(spark, reference, size, fan):
    """Whole numbers as moves, so that products are exact in any order; also with a reference inside a block, missing or never reached."""
    df = frames(spark, seed=reference)
    found = block_fold(df, "video", "frame", TrackScan(reference, 5), fold.TRACK_FIELDS, size, fan)
    want = fold.ordered_fold(df, "video", ["frame"], ["frame", "accepted", "delta"], fold.track_step(reference, 5), fold.TRACK_FIELDS)
    assert sorted(map(tuple, found.select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_no_task_holds_more_than_a_block(spark):
    rows = spark.range(6000).selectExpr("'one' AS video", "id AS frame", "id % 7 < 3 AS moving", "id % 5 < 4 AS stable")
    found = block_fold(rows, "video", "frame", SceneScan(fold.SceneRules()), fold.SCENE_FIELDS, size=500, fan=4)
    most = found.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.countDistinct(F.expr("frame div 500")).alias("blocks"), F.count("*").alias("rows"))
    assert all(r.rows == 500 * r.blocks for r in most.collect()) and found.count() == 6000
    assert block_fold(rows.limit(0), "video", "frame", SceneScan(fold.SceneRules()), fold.SCENE_FIELDS).count() == 0


@pytest.mark.parametrize(("size", "fan"), [(5, 2), (64, 100)])
def test_views_seen(spark, size, fan):
    from pyspark.sql import Window
    from pyspark.sql import types as T

    from caloris.operators.scan import ViewScan

    rng = random.Random(4)
    rows = [(v, f, rng.choice([None] * 6 + [1, 2, 3]), rng.random() < 0.05, f"x{f}") for v in "ab" for f in range(300) if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "video string, frame long, seen int, new boolean, note string").repartition(4)
    fields = [T.StructField("view", T.IntegerType()), T.StructField("before", T.IntegerType()), T.StructField("told", T.LongType())]
    found = block_fold(df, "video", "frame", ViewScan(), fields, size, fan, keep=["note"])
    so_far = Window.partitionBy("video").orderBy("frame").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("view", F.last("seen", True).over(so_far)).withColumn("before", F.lag(F.last("seen", True).over(so_far)).over(Window.partitionBy("video").orderBy("frame")))
    want = want.withColumn("told", F.last(F.when(F.col("new"), F.col("frame")), True).over(so_far)).select(found.columns)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
