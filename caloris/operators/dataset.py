"""Labelled image datasets: frame sampling, augmented variants, annotations; and timelines of synthetic clips."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caloris.functions import geometry as G
from caloris.sources.store import cut


# Defaults of dataset building.
@dataclass(frozen=True)
class DatasetOptions:
    sample_seconds: float = 5.0
    seed: int = 42
    preview_every: int = 10
    border: float = 3.0
    least_area: float = 10.0
    attempts: int = 30
    augmentations: int = 2
    max_shift: float = 20.0
    max_degrees: float = 2.0
    max_scale: float = 0.03


def sample_step(fps: Column, seconds: float) -> Column:
    """Frames between samples: at least one, halves to even."""
    return F.greatest(F.lit(1), F.rint(fps * seconds).cast("int"))


def sampled_frames(videos: DataFrame, seconds: float) -> DataFrame:
    """A row for each sampled frame of videos(video_id, fps, total_frames)."""
    frames = F.sequence(F.lit(0), F.col("total_frames") - 1, sample_step(F.col("fps"), seconds))
    return videos.filter("total_frames > 0").withColumn("frame", F.explode(frames))


def uniform(seed: int, *parts: Column) -> Column:
    """A number from 0 (within) to 1 (without) that depends on seed and parts alone, so that reruns and lost tasks agree."""
    return F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(1 << 40)) / float(1 << 40)


def augmentations(frames: DataFrame, options: DatasetOptions) -> DataFrame:
    """Variants of frames(source_group, width, height, polygons): the original, and for each augmentation the first of `attempts`
    random transforms that keeps all polygons in the frame (those without one are left out).

    Each attempt's numbers come from a hash of group, variant and attempt, not from one stream of random numbers over all videos:
    so rows need no order, and any part can be made again by itself. Attempts end with the first that fits. Rows are dealt out anew, as a
    small table of frames is much work.
    """
    o = options
    dealt = frames.repartition(int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source_group")
    rows = dealt.withColumn("variant", F.explode(F.sequence(F.lit(1), F.lit(o.augmentations))))
    tries = F.sequence(F.lit(1), F.lit(o.attempts))
    # made once and used often
    of = lambda made, use: F.get(F.transform(F.array(made), use), F.lit(0))

    def attempt(n: Column) -> Column:
        u = lambda k: 2.0 * uniform(o.seed, F.col("source_group"), F.col("variant"), n, F.lit(k)) - 1.0
        drawn = F.struct((o.max_shift * u(0)).alias("dx"), (o.max_shift * u(1)).alias("dy"), (o.max_degrees * u(2)).alias("turn"), (1.0 + o.max_scale * u(3)).alias("scale"))
        turned = lambda d: G.similarity(d["dx"], d["dy"], d["turn"], d["scale"], F.col("width"), F.col("height"))
        return of(drawn, lambda d: F.struct(d["dx"].alias("dx_pixels"), d["dy"].alias("dy_pixels"), d["turn"].alias("rotation_deg"), d["scale"].alias("scale"), turned(d).alias("transform")))

    def fitting(t: Column) -> Column:
        moved = F.transform("polygons", lambda p: G.apply(t["transform"], p))
        return F.when(F.forall(moved, lambda p: G.fits(p, F.col("width"), F.col("height"), o.border, o.least_area)), t)

    none = F.lit(None).cast("struct<dx_pixels: double, dy_pixels: double, rotation_deg: double, scale: double, transform: array<double>>")
    first = F.aggregate(tries, none, lambda found, n: F.when(found.isNotNull(), found).otherwise(of(attempt(n), fitting)))
    # exploded rather than filtered: a filter would go below and make all attempts once more
    made = rows.withColumn("t", F.explode(F.filter(F.array(first), lambda t: t.isNotNull())))
    kept = [c for c in frames.columns if c != "polygons"]
    made = made.select(*kept, F.format_string("aug_%02d", "variant").alias("augmentation"), "t.*", F.transform("polygons", lambda p: G.apply(F.col("t.transform"), p)).alias("polygons"))
    one, none = F.lit(1.0), F.lit(0.0)
    original = frames.select(*kept, F.lit("original").alias("augmentation"), none.alias("dx_pixels"), none.alias("dy_pixels"), none.alias("rotation_deg"), one.alias("scale"), G.identity().alias("transform"), "polygons")
    return original.unionByName(made)


def split(group: Column, shares: dict[str, float], seed: int = 42) -> Column:
    """The part of a dataset that a group belongs to: all variants of a frame fall into one part. By a hash of seed and group, so that parts
    stay as they are when groups are added; shares need not add up to 1. A null group is a group."""
    total, at = float(sum(shares.values())), 0.0
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(group.cast("string"), F.lit("")))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    part, *rest = shares
    out = None
    for name in (part, *rest):
        at += shares[name] / total
        out = F.when(place < at, name) if out is None else out.when(place < at, name)
    return out.otherwise(name)


def totals(images: DataFrame, annotations: DataFrame, image: str, source: str) -> DataFrame:
    """Images and instances of each source; images(image, source), annotations(image), which are counted before they meet the images."""
    per_image = annotations.groupBy(image).agg(F.count("*").alias("n"))
    return images.join(per_image, image, "left").groupBy(source).agg(F.count("*").alias("images"), F.coalesce(F.sum("n"), F.lit(0)).alias("instances"))


def image_name(stem: Column, frame: Column, kind: Column) -> Column:
    return F.concat(stem, F.lit("__frame_"), F.lpad(frame.cast("string"), 6, "0"), F.lit("__"), kind, F.lit(".jpg"))


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with dense numbers from 1 in an explicit order, over all rows.

    Rows are range-partitioned, sorted and kept; only the number of rows of each partition passes the driver, so no task holds more
    than its range.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    dealt = cut(dealt.withColumn("__at", F.monotonically_increasing_id() - F.shiftleft(F.col("__part").cast("long"), 33)))
    before, starts = 0, {}
    for part, n in sorted((r["__part"], r["count"]) for r in dealt.groupBy("__part").count().collect()):
        starts[part] = before
        before += n
    if not starts:
        return dealt.drop("__part", "__at").withColumn(name, F.lit(0).cast("long"))
    begin = F.element_at(F.create_map(*(F.lit(x) for part, n in starts.items() for x in (part, n))), F.col("__part"))
    return dealt.withColumn(name, (begin + F.col("__at") + 1).cast("long")).drop("__part", "__at")


def annotations(images: DataFrame) -> DataFrame:
    """One row for each polygon of images(image_id, polygons, ...): segmentation, area, box and a dense id in image order."""
    rows = numbered(images.select("image_id", F.posexplode("polygons").alias("pos", "polygon")), ["image_id", "pos"], "id")
    polygon = F.col("polygon")
    return rows.select("id", "image_id", (F.col("pos") + 1).alias("source_region_id"), F.lit(1).alias("category_id"), G.flat(polygon).alias("segmentation"), G.area(polygon).alias("area"), G.bounding_box(polygon).alias("bbox"), F.lit(0).alias("iscrowd"))


def pan_timeline(fps: float, stable_seconds: float = 4.0, transition_seconds: float = 1.2, back: bool = True) -> list[tuple[str, int]]:
    """Segments of a clip that shows view A, pans to B and back: names and lengths in frames, halves to even."""
    stable, pan = round(stable_seconds * fps), max(1, round(transition_seconds * fps))
    out = [("A", stable), ("A_TO_B", pan), ("B", stable)]
    return [*out, ("B_TO_A", pan), ("A", stable)] if back else out


def pan_frames_of(clips: DataFrame, key: str, stable_seconds: float = 4.0, transition_seconds: float = 1.2, back: bool = True) -> DataFrame:
    """pan_frames for a table of clips (key, fps): key, frame, segment and the share of the pan that is done."""
    names = ["A", "A_TO_B", "B", "B_TO_A", "A"] if back else ["A", "A_TO_B", "B"]
    length = lambda n: F.rint(F.col("fps") * stable_seconds) if "_TO_" not in n else F.greatest(F.lit(1.0), F.rint(F.col("fps") * transition_seconds))
    begin, items = F.lit(0), []
    for n in names:
        items.append(F.struct(F.lit(n).alias("segment"), length(n).cast("int").alias("length"), begin.alias("begin")))
        begin = begin + length(n).cast("int")
    rows = clips.select(key, F.inline(F.array(*items))).filter("length > 0").withColumn("local", F.explode(F.sequence(F.lit(0), F.col("length") - 1)))
    share = F.when(F.col("length") > 1, F.col("local") / (F.col("length") - 1)).otherwise(1.0)
    return rows.select(key, (F.col("begin") + F.col("local")).alias("frame"), "segment", F.when(F.contains("segment", F.lit("_TO_")), share).alias("fraction"))


def pan_frames(spark, segments: list[tuple[str, int]]) -> DataFrame:
    """A row for each frame: segment and the share of the pan that is done (0 at its first frame, 1 at its last)."""
    starts = [sum(n for _, n in segments[:i]) for i in range(len(segments))]
    rows = spark.createDataFrame([(at, s, n) for at, (s, n) in zip(starts, segments, strict=True)], "begin int, segment string, length int")
    rows = rows.withColumn("local", F.explode(F.sequence(F.lit(0), F.col("length") - 1))).withColumn("frame", F.col("begin") + F.col("local"))
    share = F.when(F.col("length") > 1, F.col("local") / (F.col("length") - 1)).otherwise(1.0)
    return rows.select("frame", "segment", F.when(F.contains("segment", F.lit("_TO_")), share).alias("fraction"))
