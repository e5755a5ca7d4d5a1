"""Joins by place: values in intervals and points in polygons, as equi-joins on tiles with the exact test behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contains(points: Column, x: Column, y: Column) -> Column:
    """Whether a place lies in a polygon or on its edge; self-crossing polygons by the even-odd rule. Null with a null; false with no points."""
    turned = F.concat(F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 1, 1))
    edges = F.zip_with(points, turned, lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))

    def on(e: Column) -> Column:
        flat = (e["bx"] - e["ax"]) * (y - e["ay"]) == (e["by"] - e["ay"]) * (x - e["ax"])
        return flat & x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"])) & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))

    def crossed(e: Column) -> Column:
        # x < ax + (y - ay) * (bx - ax) / (by - ay), without the quotient
        left = (x - e["ax"]) * (e["by"] - e["ay"]) < (y - e["ay"]) * (e["bx"] - e["ax"])
        return ((e["ay"] > y) != (e["by"] > y)) & (left == (e["by"] > e["ay"]))

    return F.exists(edges, on) | (F.size(F.filter(edges, crossed)) % 2 == 1)


def _levels(of: DataFrame, level: str) -> list[int]:
    """The few sizes of tiles in use: a size is twice the one before, so there are at most as many as a double has exponents."""
    return sorted(r[0] for r in of.select(level).filter(F.col(level).isNotNull()).distinct().collect())


def _level(extent: Column, tile: float) -> Column:
    """How often a tile must be doubled to be as large as the extent."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(extent, F.lit(tile)) / tile))).cast("int")


def interval_join(values: DataFrame, intervals: DataFrame, keys: list[str], at: str, low: str, high: str, tile: float = 16.0) -> DataFrame:
    """Pairs of rows with equal keys where low <= at <= high; columns of values, then those of intervals but the keys.

    An interval lies in at most two tiles of its own level, the tiles' width there being its length or up to twice that; a value is looked
    up once at each level in use. So long intervals cost no more than short ones and pairs that can't match rarely meet. Nulls, NaN and
    intervals that end before they start match nothing; neither does a null key.
    """
    spans = intervals.filter(F.col(low) <= F.col(high)).withColumn("__level", _level(F.col(high) - F.col(low), tile))
    width = lambda level: F.lit(tile) * F.pow(F.lit(2.0), level)
    levels = _levels(spans, "__level")
    place = lambda c: F.floor(F.col(c) / width(F.col("__level")))
    spans = spans.withColumn("__tile", F.explode(F.sequence(place(low), place(high))))
    points = values.withColumn("__level", F.explode(F.array(*(F.lit(v) for v in levels)).cast("array<int>"))).withColumn("__tile", place(at))
    # sizes are estimated without the tiles, so a side much too large for it would be broadcast
    found = points.join(spans.hint("merge"), [*keys, "__level", "__tile"])
    return found.filter(F.col(at).between(F.col(low), F.col(high))).drop("__level", "__tile")


def points_in_polygons(points: DataFrame, polygons: DataFrame, keys: list[str], x: str, y: str, shape: str, tile: float = 16.0) -> DataFrame:
    """Pairs of a point and a polygon of equal keys that holds it, its edge included; columns of points, then those of polygons but the keys.

    A polygon lies in at most four tiles of its level, a point in one of each level in use: an equi-join, then the exact test. Points
    without a place and polygons without points match nothing; neither does a null key.
    """
    of = lambda axis: F.transform(shape, lambda p: p[axis])
    # both ends of each side as they are: a start and a length would lose the far edge to rounding
    box = F.array(F.array_min(of("x")), F.array_min(of("y")), F.array_max(of("x")), F.array_max(of("y")))
    shapes = polygons.filter(F.size(shape) > 0).withColumn("__box", box).filter(F.exists("__box", lambda v: v.isNull() | F.isnan(v)) == F.lit(False))
    side = lambda i: F.col("__box")[i + 2] - F.col("__box")[i]
    shapes = shapes.withColumn("__level", _level(F.greatest(side(0), side(1)), tile))
    levels = _levels(shapes, "__level")
    width = F.lit(tile) * F.pow(F.lit(2.0), F.col("__level"))
    reach = lambda i: F.explode(F.sequence(F.floor(F.col("__box")[i] / width), F.floor(F.col("__box")[i + 2] / width)))
    shapes = shapes.withColumn("__tx", reach(0)).withColumn("__ty", reach(1))
    places = points.withColumn("__level", F.explode(F.array(*(F.lit(v) for v in levels)).cast("array<int>")))
    places = places.withColumn("__tx", F.floor(F.col(x) / width)).withColumn("__ty", F.floor(F.col(y) / width))
    # not by estimated sizes, which know neither of the tiles nor of the length of a shape
    found = places.join(shapes.hint("merge"), [*keys, "__level", "__tx", "__ty"])
    near = F.col(x).between(F.col("__box")[0], F.col("__box")[2]) & F.col(y).between(F.col("__box")[1], F.col("__box")[3])
    return found.filter(near & contains(F.col(shape), F.col(x), F.col(y))).drop("__level", "__tx", "__ty", "__box")

