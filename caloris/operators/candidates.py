"""Ranking of label readings: the best pair of a frame's MIN and MAX candidates, the best single reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caloris.functions.scale import ScaleOptions, near_pair, valid_pair
from caloris.functions.text import has_point, scan_quality, setup_quality


def pairs(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """All pairs of a group's MIN and MAX candidates (ord, value, text, method, psm, is_primary, label): seven by seven at most in a
    frame, so they are paired within the group's row after one aggregation."""
    item = F.struct("ord", "value", "text", "method", "psm", "is_primary")
    of = lambda label: F.array_sort(F.collect_list(F.when(F.col("label") == label, item)))
    grouped = candidates.groupBy(*keys).agg(of("MIN").alias("lows"), of("MAX").alias("highs"))
    both = grouped.withColumn("lo", F.explode("lows")).withColumn("hi", F.explode("highs"))
    return both.drop("lows", "highs")


def best_pair(candidates: DataFrame, keys: list[str], options: ScaleOptions, last: tuple[Column, Column] | None = None) -> DataFrame:
    """The plausible pair nearest to the last trusted one, then of better text, then of more primary readings, then first found."""
    found = pairs(candidates, keys)
    low, high = F.col("lo.value"), F.col("hi.value")
    last_low, last_high = last or (F.lit(None).cast("double"), F.lit(None).cast("double"))
    found = found.filter(valid_pair(low, high, options) & near_pair(low, high, last_low, last_high, options.max_jump))
    distance = F.coalesce(F.abs(low - last_low) + F.abs(high - last_high), F.lit(0.0))
    quality = scan_quality(F.col("lo.text")) + scan_quality(F.col("hi.text"))
    penalty = F.when(F.col("lo.is_primary"), 0).otherwise(1) + F.when(F.col("hi.is_primary"), 0).otherwise(1)
    rank = F.struct(distance, -quality, penalty, F.col("lo.ord"), F.col("hi.ord"))
    return _first(found, keys, rank)


def recipe_pair(candidates: DataFrame, keys: list[str], options: ScaleOptions, strict: bool = True) -> DataFrame:
    """The pair that sets a recipe: of best texts, one more for the same method and mode in both, then first found.

    A group without a plausible pair fails the query rather than have its recipe guessed; without `strict` it is left out.
    """
    found = pairs(candidates, keys)
    found = found.filter(valid_pair(F.col("lo.value"), F.col("hi.value"), options))
    same = ((F.col("lo.method") == F.col("hi.method")) & (F.col("lo.psm") == F.col("hi.psm"))).cast("double")
    score = setup_quality(F.col("lo.text")) + setup_quality(F.col("hi.text")) + same
    best = _first(found, keys, F.struct(-score, F.col("lo.ord"), F.col("hi.ord")))
    if not strict:
        return best
    named = F.concat(F.lit("no plausible pair of labels for "), F.to_json(F.struct(*keys)))
    whole = candidates.select(*keys).distinct().join(best, keys, "left")
    return whole.withColumn("min_value", F.when(F.col("min_value").isNull(), F.raise_error(named)).otherwise(F.col("min_value")))


def _first(found: DataFrame, keys: list[str], rank: Column) -> DataFrame:
    best = found.groupBy(*keys).agg(F.min_by(F.struct("lo", "hi"), rank).alias("best"))
    return best.select(*keys, *(F.col(f"best.{a}.{b}").alias(f"{n}_{b}") for a, n in (("lo", "min"), ("hi", "max")) for b in ("value", "text", "method", "psm")))


def best_reading(readings: DataFrame, keys: list[str], least_confidence: float = 0.25) -> DataFrame:
    """The reading (text, value, confidence, ord) of most confidence, then with a point, then longest, then first; the strongest
    text without a value where none parses. Readings below the least confidence don't count."""
    able = readings.filter(F.col("confidence") >= least_confidence)
    parsed = F.col("value").isNotNull()
    full = F.struct(F.when(parsed, 0).otherwise(1), -F.col("confidence"), F.when(parsed, -has_point(F.col("text"))).otherwise(0), F.when(parsed, -F.length("text")).otherwise(0), F.col("ord"))
    return able.groupBy(*keys).agg(F.min_by(F.struct("text", "value", "confidence"), full).alias("b")).select(*keys, "b.*")


def joined_text(readings: DataFrame, keys: list[str]) -> DataFrame:
    """The texts of a label's items in order as one, with the least confidence, where there is more than one item."""
    found = readings.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("ord", "text"))).alias("items"), F.min("confidence").alias("confidence"))
    return found.filter(F.size("items") > 1).select(*keys, F.array_join(F.transform("items", lambda x: x["text"]), "").alias("text"), "confidence")


def recipes(first: Column, others: Column) -> Column:
    """The configured recipe, then the others, each once, in order."""
    return F.array_distinct(F.concat(F.array(first), others))
