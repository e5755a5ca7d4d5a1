"""Descriptor matches, transform validation and motion evidence."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caloris.sources.store import stored

# Reasons for which a camera transform is rejected, in the order of their checks.
REASONS = (
    "NO_TRANSFORM", "NO_MATCHES", "TOO_FEW_INLIERS", "LOW_INLIER_RATIO", "DELTA_TRANSLATION_TOO_LARGE", "DELTA_ROTATION_TOO_LARGE",
    "DELTA_SCALE_IMPLAUSIBLE", "CUMULATIVE_TRANSLATION_TOO_LARGE", "CUMULATIVE_ROTATION_TOO_LARGE", "CUMULATIVE_SCALE_IMPLAUSIBLE",
)


# Defaults of camera tracking.
@dataclass(frozen=True)
class TrackingOptions:
    margin: int = 80
    min_inliers: int = 12
    min_ratio: float = 0.45
    delta_pixels: float = 100.0
    delta_degrees: float = 5.0
    delta_scale: tuple[float, float] = (0.92, 1.08)
    total_pixels: float = 220.0
    total_degrees: float = 10.0
    total_scale: tuple[float, float] = (0.85, 1.15)
    warn_after: int = 20
    corners: int = 900
    worst_error: float = 60.0
    least_points: int = 6
    features: int = 1800


# Defaults of scene detection.
@dataclass(frozen=True)
class SceneOptions:
    width: int = 640
    ignore: tuple[float, float, float, float] = (0.05, 0.03, 0.02, 0.12)  # top, bottom, left, right
    channel_difference: int = 25
    moving_pixels: float = 2.0
    moving_degrees: float = 0.12
    moving_edges: float = 0.12
    stable_pixels: float = 0.8
    stable_degrees: float = 0.06
    stable_edges: float = 0.07
    failed_edges: float = 0.10
    min_inliers: int = 10
    min_ratio: float = 0.35
    moving_frames: int = 3
    stable_frames: int = 12
    view_matches: int = 20
    view_inliers: int = 12
    view_ratio: float = 0.30
    banner_frames: int = 30
    corners: int = 700
    worst_error: float = 70.0
    least_points: int = 8
    features: int = 2200


def verdict(o: TrackingOptions) -> Column:
    """OK or the first reason against a candidate: columns found, matches, inliers, ratio, delta and total (each a struct of
    geometry.metrics)."""
    outside = lambda x, band: (x < band[0]) | (x > band[1])
    checks = (
        ~F.col("found"), F.col("matches") <= 0, F.col("inliers") < o.min_inliers, F.col("ratio") < o.min_ratio, F.col("delta.translation") > o.delta_pixels,
        F.abs("delta.rotation_deg") > o.delta_degrees, outside(F.col("delta.scale"), o.delta_scale), F.col("total.translation") > o.total_pixels,
        F.abs("total.rotation_deg") > o.total_degrees, outside(F.col("total.scale"), o.total_scale),
    )
    return F.coalesce(*(F.when(c, F.lit(r)) for c, r in zip(checks, REASONS, strict=True)), F.lit("OK"))


def choose_method(flow_reason: Column, features_reason: Column) -> Column:
    """Which of two candidates counts: the flow if it is OK, else the features, else neither; with the reason to log."""
    reason = F.when(flow_reason == "OK", "LK_ACCEPTED").when(features_reason == "OK", F.concat(F.lit("ORB_RECOVERY_AFTER_"), flow_reason)).otherwise(F.concat(F.lit("TRACKING_FAILED:LK="), flow_reason, F.lit(";ORB="), features_reason))
    method = F.when(flow_reason == "OK", "LK_OPTICAL_FLOW").when(features_reason == "OK", "ORB_FALLBACK").otherwise("NONE")
    return F.struct(method.alias("method"), reason.alias("reason"))


def rejection(matches: int, inliers: int, ratio: float, delta: dict | None, total: dict | None, o: TrackingOptions) -> str:
    """verdict() of one candidate, for a fold that decides by it. delta, total: as kernels.motion.metrics gives them; None: no transform."""
    if delta is None or total is None:
        return "NO_TRANSFORM"
    inside = lambda x, band: band[0] <= x <= band[1]
    passed = (
        True, matches > 0, inliers >= o.min_inliers, ratio >= o.min_ratio, delta["translation"] <= o.delta_pixels, abs(delta["rotation_deg"]) <= o.delta_degrees,
        inside(delta["scale"], o.delta_scale), total["translation"] <= o.total_pixels, abs(total["rotation_deg"]) <= o.total_degrees, inside(total["scale"], o.total_scale),
    )
    return next((r for r, ok in zip(REASONS, passed, strict=True) if not ok), "OK")


def frame_evidence(o: SceneOptions) -> Column:
    """evidence() that tells a frame without a transform (column found) from one with a poor transform: the first is judged by a lower
    bar of edge change and may be stable, the second is never stable."""
    good = F.col("found") & (F.col("inliers") >= o.min_inliers) & (F.col("ratio") >= o.min_ratio)
    turn, edge = F.abs("rotation_deg"), F.col("edge_change")
    moves = (good & ((F.col("translation") >= o.moving_pixels) | (turn >= o.moving_degrees))) | (edge >= o.moving_edges)
    still = good & (F.col("translation") <= o.stable_pixels) & (turn <= o.stable_degrees) & (edge <= o.stable_edges)
    moving = F.when(F.col("found"), moves).otherwise(edge >= o.failed_edges)
    stable = F.when(F.col("found"), still).otherwise(edge <= o.stable_edges)
    return F.struct(F.coalesce(moving, F.lit(False)).alias("moving"), F.coalesce(stable, F.lit(False)).alias("stable"))


def evidence(o: SceneOptions) -> Column:
    """Whether a frame shows motion, and whether it shows none: columns translation, rotation_deg, inliers, ratio, edge_change."""
    tracked = F.coalesce((F.col("inliers") >= o.min_inliers) & (F.col("ratio") >= o.min_ratio), F.lit(False))
    turn = F.abs("rotation_deg")
    moving = F.when(tracked, (F.col("translation") >= o.moving_pixels) | (turn >= o.moving_degrees) | (F.col("edge_change") >= o.moving_edges)).otherwise(F.col("edge_change") >= o.failed_edges)
    stable = F.when(tracked, (F.col("translation") <= o.stable_pixels) & (turn <= o.stable_degrees) & (F.col("edge_change") <= o.stable_edges)).otherwise(F.lit(False))
    return F.struct(F.coalesce(moving, F.lit(False)).alias("moving"), F.coalesce(stable, F.lit(False)).alias("stable"))


def view_accepted(o: SceneOptions) -> Column:
    """Whether a match with a known view is good enough: columns matches, inliers, ratio."""
    return (F.col("matches") >= o.view_matches) & (F.col("inliers") >= o.view_inliers) & (F.col("ratio") >= o.view_ratio)


def two_nearest(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str, bits: str, block: int = 4096, others: bool = False) -> DataFrame:
    """For each left row, its nearest right row of the same keys by differing bits (an array of longs), and the two least distances.

    Of equal distances the least right_id counts; d2 is null with a single right row. others: rows of equal ids don't meet. A key's rows are
    dealt by size: blocks of about `block` left rows meet blocks of as many right rows, each pair in a place of its own as matrices, and
    two of each left row leave it. So a key of any size is many even tasks. Rows with a null key, id or bits match nothing.
    """
    left, right = left.select(*keys, left_id, bits).dropna(), right.select(*keys, right_id, bits).dropna()
    of = lambda df, name: df.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    sizes = stored(of(left, "__nl").join(of(right, "__nr"), keys))

    def dealt(df: DataFrame, i: str, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        df = df.join(sizes, keys).withColumn(mine, F.pmod(F.xxhash64(i), F.col(own)).cast("int")).withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        # columns of their own, as both sides may come from one table
        return df.select(*(F.col(c).alias(c) for c in (*keys, i, bits, "__l", "__r")))

    group = [*keys, "__l", "__r"]
    a, b = dealt(left, left_id, "__nl", "__nr", "__l", "__r"), dealt(right, right_id, "__nr", "__nl", "__r", "__l")
    fields = [*(left.schema[k] for k in keys), left.schema[left_id], right.schema[right_id], T.StructField("d", T.IntegerType())]

    def meet(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        theirs = theirs.take(pc.sort_indices(theirs.column(right_id)))
        words = lambda t: t.column(bits).combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(t.num_rows, -1)
        if not mine.num_rows or not theirs.num_rows:
            return mine.select([*keys, left_id]).slice(0, 0).append_column(right_id, theirs.column(right_id).slice(0, 0)).append_column("d", pa.array([], pa.int32()))
        x, y, own, other = words(mine), words(theirs), mine.column(left_id).to_pylist(), theirs.column(right_id)
        if others:
            number = {v: i for i, v in enumerate(set(other.to_pylist()))}
            its, theirs_n = np.array([number.get(v, -1) for v in own]), np.array([number[v] for v in other.to_pylist()])
        rows, found, far = [], [], []
        for k in range(0, len(x), 256):
            d = np.bitwise_count(x[k : k + 256, None] ^ y[None]).sum(2, dtype=np.int64)
            if others:
                d[its[k : k + 256, None] == theirs_n] = 1 << 20
            # the place breaks ties, as right rows lie by id
            near = np.sort(np.partition((d << 32) | np.arange(len(y)), min(1, len(y) - 1), axis=1)[:, :2], axis=1)
            for c in range(near.shape[1]):
                good = np.flatnonzero(near[:, c] >> 32 < 1 << 20)
                rows.append(k + good)
                found.append(near[good, c] & 0xFFFFFFFF)
                far.append((near[good, c] >> 32).astype(np.int32))
        at = pa.array(np.concatenate(rows))
        columns = [mine.column(c).take(at) for c in (*keys, left_id)]
        return pa.table([*columns, other.take(pa.array(np.concatenate(found))), pa.array(np.concatenate(far))], names=[*keys, left_id, right_id, "d"])

    both = a.groupBy(*group).cogroup(b.groupBy(*group)).applyInArrow(meet, T.StructType(fields))
    rank = F.row_number().over(Window.partitionBy(*keys, left_id).orderBy("d", right_id))
    near = both.withColumn("rank", rank).filter("rank <= 2")
    of = lambda c, k: F.max(F.when(F.col("rank") == k, F.col(c)))
    return near.groupBy(*keys, left_id).agg(of(right_id, 1).alias(right_id), of("d", 1).alias("d1"), of("d", 2).alias("d2"))


def unambiguous(matches: DataFrame, ratio: float = 0.75) -> DataFrame:
    """Matches clearly nearer than the second nearest."""
    return matches.filter(F.col("d1") < ratio * F.col("d2"))


def best_view(scores: DataFrame, keys: list[str], options: SceneOptions) -> DataFrame:
    """The accepted known view of the highest score, the earliest on ties; frames without one are left out."""
    accepted = scores.filter(view_accepted(options))
    return accepted.groupBy(*keys).agg(F.min_by(F.struct("view_id", "score"), F.struct(-F.col("score"), F.col("view_id"))).alias("b")).select(*keys, "b.*")
