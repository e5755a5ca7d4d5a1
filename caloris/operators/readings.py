"""Scale readings of recorded clips: labels read in sampled frames, suspicious ones read again, and each frame's trusted scale."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caloris.functions.scale import ScaleOptions
from caloris.functions.text import parse_temperature
from caloris.sources.readers import reader
from caloris.sources.store import stored

from . import fold
from .kernels import pixels as K
from .windows import carry_forward

# The recipes (method, page mode) that a suspicious frame is read with after its own.
RETRIES = (("green_difference", 7), ("green_difference", 8), ("hsv_green", 7), ("green_channel_otsu", 7), ("gray_otsu", 7), ("gray_adaptive", 7))
CANDIDATE_SCHEMA = "video_id string, frame int, label string, ord int, method string, psm int, text string, confidence double, is_primary boolean"


def label_candidates(frames: DataFrame, boxes: dict[str, dict], recipes: list[tuple[str, int]], engine: str, options: ScaleOptions | None = None) -> DataFrame:
    """A row for each frame, label and recipe: what the engine reads in the label's box; value is null where no number parses.

    boxes: of the labels MIN and MAX, x, y, w, h. The first recipe is the primary one; repeated ones are read once. Each frame is read
    where it is scanned. An unknown engine or method is an error.
    """
    o = options or ScaleOptions()
    unique = list(dict.fromkeys(recipes))
    reader(engine)
    for method, _ in unique:
        K.prepare(np.zeros((8, 8, 3), np.uint8), method)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = reader(engine).read
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                bgr = np.frombuffer(row.bgr, np.uint8).reshape(row.height, row.width, 3)
                for label, box in boxes.items():
                    crop = K.crop_padded(bgr, box, o.padding)
                    for k, (method, mode) in enumerate(unique):
                        found = read(K.prepare(crop, method), mode) if crop.size else []
                        text, sure = ("".join(t for t, _ in found), min(c for _, c in found)) if found else ("", 0.0)
                        out.append((row.video_id, row.frame, label, k, method, mode, text, sure, k == 0))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in CANDIDATE_SCHEMA.split(", ")])

    made = frames.select("video_id", "frame", "width", "height", "bgr").mapInPandas(run, CANDIDATE_SCHEMA)
    return made.withColumn("value", parse_temperature(F.col("text"), o.decimals))


_double, _string, _bool = T.DoubleType(), T.StringType(), T.BooleanType()
READING_FIELDS = [
    T.StructField(name, kind)
    for name, kind in (
        ("accepted_low", _double), ("accepted_high", _double), ("low_text", _string), ("high_text", _string), ("low_method", _string), ("high_method", _string),
        ("held_low", _double), ("held_high", _double), ("status", _string), ("again", _bool),
    )
]


def _quality(text: str | None) -> float:
    return 2.0 * ("." in (text or "")) + 0.25 * min(4, sum(c.isdigit() for c in text or ""))


def reading_step(gate: fold.ScaleGate):
    """A frame's own pair if it is plausible and near the last trusted one, else the best pair among all its candidates, else the last
    one is held. row: low, high, seed_low, seed_high (own pair: null low where it is not plausible) and candidates (an array of label
    readings by label). again: whether the candidates were needed. Texts and methods are given for retries only."""

    def near(low: float, high: float, last: tuple | None) -> bool:
        return last is None or (abs(low - last[0]) <= gate.max_jump and abs(high - last[1]) <= gate.max_jump)

    def step(state: tuple | None, row: dict) -> tuple[tuple | None, tuple]:
        last = state or ((row["seed_low"], row["seed_high"]) if gate.valid(row["seed_low"], row["seed_high"]) else None)
        low, high = row["low"], row["high"]
        if low is not None and near(low, high, last):
            return (low, high), (low, high, None, None, None, None, low, high, "ACCEPT_PRIMARY", False)
        named = lambda c: f"{c['method']}/PSM{c['psm']}"
        best = None
        lows, highs = ([c for c in row["candidates"] or [] if c["label"] == k] for k in ("MIN", "MAX"))
        for a in lows:
            for b in highs:
                if gate.valid(a["value"], b["value"]) and near(a["value"], b["value"], last):
                    away = abs(a["value"] - last[0]) + abs(b["value"] - last[1]) if last else 0.0
                    rank = (away, -_quality(a["text"]) - _quality(b["text"]), (not a["is_primary"]) + (not b["is_primary"]), a["ord"], b["ord"])
                    best = min(best, (rank, a, b), key=lambda x: x[0]) if best else (rank, a, b)
        if best:
            _, a, b = best
            pair = (a["value"], b["value"])
            return pair, (*pair, a["text"], b["text"], named(a), named(b), *pair, "ACCEPT_RETRY", True)
        return last, (None,) * 6 + (*(last or (None, None)), "HOLD_PREVIOUS", True)

    return step


def _own_pairs(samples: DataFrame, gate: fold.ScaleGate) -> DataFrame:
    """samples with flat columns of `own` in its place: low and high, null where they are not plausible, and the readings shown."""
    at = lambda label, k: F.try_element_at(F.filter("own", lambda c: c["label"] == label), F.lit(k))
    a, b = at("MIN", -1), at("MAX", -1)
    inside = lambda v: v.between(gate.min_allowed, gate.max_allowed)
    valid = inside(a["value"]) & inside(b["value"]) & (b["value"] > a["value"]) & (b["value"] - a["value"] >= gate.min_span)
    named = lambda c: F.concat(F.coalesce(c["method"], F.lit("None")), F.lit("/PSM"), F.coalesce(c["psm"].cast("string"), F.lit("None")))
    shown = {f"p_{k}_{f}": at(label, 1)[f] for k, label in (("min", "MIN"), ("max", "MAX")) for f in ("value", "text")}
    accepted = {"own_low_text": a["text"], "own_high_text": b["text"], "own_low_method": named(a), "own_high_method": named(b)}
    return samples.withColumns({"low": F.when(valid, a["value"]), "high": F.when(valid, b["value"])} | shown | accepted).drop("own")


def _grouped(candidates: DataFrame, name: str) -> DataFrame:
    item = F.struct("label", "ord", "value", "text", "method", "psm", "is_primary")
    return candidates.groupBy("video_id", "frame").agg(F.array_sort(F.collect_list(item)).alias(name))


def provided_scale(frames: DataFrame, cached: DataFrame, key: list[str], live: str, held: str) -> DataFrame:
    """frames with scale and source: the value that a table of readings holds for a frame (CACHE), else the one read now (LIVE)."""
    both = frames.join(cached.select(*key, F.col(held).alias("__held")), key, "left")
    return both.withColumns({"scale": F.coalesce("__held", live), "source": F.when(F.col("__held").isNull(), "LIVE").otherwise("CACHE")}).drop("__held")


def memoised(requests: DataFrame, frame: list[str], order: str, reading: list[str], cache: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The rule of the paused viewer: a frame is read when it is first looked at, and that reading, error or not, holds for every later look.

    requests: a row a look, with what a reading then would give (an error is a reading with an error text). No jump is refused. Returns the
    looks with the readings that hold and whether each was remembered, and the cache with what was read now; the cache's readings win.
    Frames with a null in their key are frames like others.
    """
    value = F.struct(*reading)
    first = requests.groupBy(*frame).agg(F.min_by(value, F.col(order)).alias("__r"), F.min(order).alias("__at"))
    if cache is not None:
        old = cache.select(*frame, value.alias("__old"))
        on = None
        for k in frame:
            on = first[k].eqNullSafe(old[k]) if on is None else on & first[k].eqNullSafe(old[k])
        joined = first.join(old, on, "full")
        known = F.col("__old").isNotNull()
        first = joined.select(*(F.coalesce(first[k], old[k]).alias(k) for k in frame), F.when(known, F.col("__old")).otherwise(F.col("__r")).alias("__r"), F.when(~known, F.col("__at")).alias("__at"))
    held = first.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(frame)), "__r", "__at")
    on = None
    for i, k in enumerate(frame):
        same = requests[k].eqNullSafe(held[f"__k{i}"])
        on = same if on is None else on & same
    looks = requests.drop(*reading).join(held, on)
    remembered = F.coalesce(F.col(order) > F.col("__at"), F.lit(True))
    return looks.select(*[c for c in requests.columns if c not in reading], "__r.*", remembered.alias("remembered")), first.select(*frame, "__r.*")


def scale_readings(frames: DataFrame, primary: DataFrame, retry: Callable[[DataFrame], DataFrame], gate: fold.ScaleGate, seeds: DataFrame | None = None, rounds: int = 4) -> DataFrame:
    """video_id and the 17 columns of a clip's scale readings, a row a frame.

    frames: video_id, frame, timestamp_seconds. primary: label_candidates of the sampled frames by the configured recipe. retry: gives
    the candidates of all recipes for a table of (video_id, frame); it is called for the frames alone in which the configured recipe
    fails, until no further frame needs it: an accepted retry moves the trusted scale, which may put later frames in doubt; each round
    runs over the videos alone that asked for readings. After `rounds`
    rounds all sampled frames from a video's first open one on are read by all recipes, so a long clip takes no more than rounds + 1. seeds:
    video_id, seed_low, seed_high, trusted before the first frame. A video whose first frames have no trusted scale is an error.
    """
    samples = _grouped(primary, "own")
    kind = samples.schema["own"].dataType
    samples = _own_pairs(samples, gate)
    if seeds is None:
        samples = samples.withColumns({"seed_low": F.lit(None).cast("double"), "seed_high": F.lit(None).cast("double")})
    else:
        samples = samples.join(seeds.select("video_id", "seed_low", "seed_high"), "video_id", "left")
    samples, more, done, ended = stored(samples), None, 0, []
    own = [c for c in samples.columns if c.startswith(("p_", "own_"))]
    while True:
        rows = samples.withColumn("candidates", F.lit(None).cast(kind)) if more is None else samples.join(more, ["video_id", "frame"], "left")
        found = fold.ordered_fold(rows, "video_id", ["frame"], ["low", "high", "candidates", "seed_low", "seed_high"], reading_step(gate), READING_FIELDS, keep=own)
        found = stored(found)
        needed = found.filter("again").select("video_id", "frame")
        needed = stored(needed if more is None else needed.join(more, ["video_id", "frame"], "left_anti"))
        if needed.isEmpty():
            ended.append(found)
            break
        # the other videos' logs are complete
        open_ones = needed.select("video_id").distinct()
        ended.append(found.join(open_ones, "video_id", "left_anti"))
        samples = samples.join(open_ones, "video_id", "left_semi")
        done += 1
        if done > rounds:
            since = needed.groupBy("video_id").agg(F.min("frame").alias("since"))
            rest = samples.select("video_id", "frame").join(since, "video_id").filter("frame >= since").select("video_id", "frame")
            needed = stored(rest if more is None else rest.join(more, ["video_id", "frame"], "left_anti"))
        made = _grouped(retry(needed), "candidates")
        # a frame without any candidate has an empty list, so that it is not asked for again
        made = stored(needed.join(made, ["video_id", "frame"], "left").withColumn("candidates", F.coalesce("candidates", F.array().cast(kind))))
        more = made if more is None else more.unionByName(made)
    found = reduce(DataFrame.unionByName, ended)
    texts = ("low_text", "high_text", "low_method", "high_method")
    found = found.withColumns({c: F.when(F.col("status") == "ACCEPT_PRIMARY", F.col(f"own_{c}")).otherwise(F.col(c)) for c in texts})
    both = carry_forward(frames.join(found, ["video_id", "frame"], "left"), "video_id", "frame", ["held_low", "held_high"])
    log = both.select(
        "video_id", "frame", "timestamp_seconds", F.col("status").isNotNull().cast("int").alias("was_ocr_sampled"), F.col("p_min_value").alias("primary_min_temp"), F.col("p_max_value").alias("primary_max_temp"),
        F.col("p_min_text").alias("primary_min_text"), F.col("p_max_text").alias("primary_max_text"), F.col("accepted_low").alias("accepted_sample_min_temp"), F.col("accepted_high").alias("accepted_sample_max_temp"),
        F.col("low_text").alias("accepted_min_text"), F.col("high_text").alias("accepted_max_text"), F.col("low_method").alias("accepted_min_method"), F.col("high_method").alias("accepted_max_method"),
        F.col("held_low").alias("clean_min_temp_used"), F.col("held_high").alias("clean_max_temp_used"), F.coalesce("status", F.lit("UNSAMPLED")).alias("status"), F.coalesce(F.col("again").cast("int"), F.lit(0)).alias("retry_attempted"),
    )
    return log.withColumn("clean_min_temp_used", F.when(F.col("clean_min_temp_used").isNull(), F.raise_error(F.lit("no trustworthy scale is known for a frame")).cast("double")).otherwise(F.col("clean_min_temp_used")))
