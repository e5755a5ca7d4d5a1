"""Column functions for points, polygons, boxes and plane transforms.

Points are structs of x and y; a polygon is an array of them. A transform is an array of six doubles, the two upper rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def identity() -> Column:
    return F.array(*(F.lit(float(v)) for v in (1, 0, 0, 0, 1, 0)))


def apply(h: Column, points: Column) -> Column:
    """Each point moved by the transform."""
    return F.transform(points, lambda p: point(h[0] * p["x"] + h[1] * p["y"] + h[2], h[3] * p["x"] + h[4] * p["y"] + h[5]))


def rounded(points: Column) -> Column:
    """Each point at the nearest pixel, halves to even."""
    return F.transform(points, lambda p: point(F.rint(p["x"]), F.rint(p["y"])))


def compose(outer: Column, inner: Column) -> Column:
    """The transform that does inner and then outer."""
    rows = []
    for r in (0, 3):
        rows += [outer[r] * inner[c] + outer[r + 1] * inner[c + 3] + (outer[r + 2] if c == 2 else F.lit(0.0)) for c in range(3)]
    return F.array(*rows)


def metrics(h: Column, width: Column, height: Column) -> Column:
    """scale, rotation in degrees, and the shift of the frame's centre (dx, dy, length)."""
    cx, cy = width / 2.0, height / 2.0
    dx = h[0] * cx + h[1] * cy + h[2] - cx
    dy = h[3] * cx + h[4] * cy + h[5] - cy
    return F.struct(
        F.sqrt(h[0] * h[0] + h[3] * h[3]).alias("scale"), F.degrees(F.atan2(h[3], h[0])).alias("rotation_deg"), dx.alias("dx"), dy.alias("dy"), F.sqrt(dx * dx + dy * dy).alias("translation")
    )


def similarity(dx: Column, dy: Column, degrees: Column, scale: Column, width: Column, height: Column) -> Column:
    """The transform that turns and scales about the frame's centre, then shifts."""
    a, b = scale * F.cos(F.radians(degrees)), scale * F.sin(F.radians(degrees))
    cx, cy = width / 2.0, height / 2.0
    return F.array(a, b, (1.0 - a) * cx - b * cy + dx, -b, a, b * cx + (1.0 - a) * cy + dy)


def ramp(frame: Column, start: Column, length: Column) -> Column:
    """Share of a motion that is done: 0 before its start, then in equal steps up to 1 over max(1, length) frames."""
    return F.when(frame < start, 0.0).otherwise(F.least(F.lit(1.0), (frame - start + 1) / F.greatest(F.lit(1), length)))


def area(points: Column) -> Column:
    """Area by the shoelace formula; 0 with fewer than three points."""
    turned = F.concat(F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 1, 1))
    cross = F.zip_with(points, turned, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.when(F.size(points) >= 3, F.abs(F.aggregate(cross, F.lit(0.0), lambda acc, c: acc + c)) / 2.0).otherwise(0.0)


def bounding_box(points: Column) -> Column:
    """[least x, least y, width, height]."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys))


def flat(points: Column) -> Column:
    """x1, y1, x2, y2, ..."""
    return F.flatten(F.transform(points, lambda p: F.array(p["x"], p["y"])))


def fits(points: Column, width: Column, height: Column, border: float = 3.0, least_area: float = 10.0) -> Column:
    """Whether a polygon is large enough and keeps a border to the frame's edges."""
    inside = F.forall(points, lambda p: (p["x"] >= border) & (p["y"] >= border) & (p["x"] < width - border) & (p["y"] < height - border))
    return (area(points) >= least_area) & inside


def normalised(points: Column, width: Column, height: Column) -> Column:
    return F.transform(points, lambda p: point(p["x"] / width, p["y"] / height))


def rectangle(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """The four corners, clockwise from the top left, of a rectangle given by any two opposite ones."""
    left, right, top, bottom = F.least(x1, x2), F.greatest(x1, x2), F.least(y1, y2), F.greatest(y1, y2)
    return F.array(point(left, top), point(right, top), point(right, bottom), point(left, bottom))


def in_box(x: Column, y: Column, box: Column) -> Column:
    """Whether a point lies in a half-open box with x, y, w and h."""
    return (x >= box["x"]) & (x < box["x"] + box["w"]) & (y >= box["y"]) & (y < box["y"] + box["h"])


def padded(box: Column, padding: int, width: Column, height: Column) -> Column:
    """A box grown on all sides, within the frame."""
    pad = max(0, padding)
    x0, y0 = F.greatest(F.lit(0), box["x"] - pad), F.greatest(F.lit(0), box["y"] - pad)
    x1, y1 = F.least(width, box["x"] + box["w"] + pad), F.least(height, box["y"] + box["h"] + pad)
    return F.struct(x0.alias("x"), y0.alias("y"), (x1 - x0).alias("w"), (y1 - y0).alias("h"))


def display_scale(width: Column, height: Column, max_width: int, max_height: int) -> Column:
    return F.least(max_width / width, max_height / height, F.lit(1.0))


def from_display(x: Column, scale: Column, size: Column) -> Column:
    """A shown coordinate in the frame, halves to even, within the frame."""
    return F.least(F.greatest(F.rint(x / scale), F.lit(0.0)), size - 1.0)
