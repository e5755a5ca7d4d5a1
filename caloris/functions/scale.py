"""Column functions for pairs of scale labels, and the thresholds that go with them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


# Defaults of the scale readings.
@dataclass(frozen=True)
class ScaleOptions:
    ocr_hz: float = 3.0
    min_allowed: float = -100.0
    max_allowed: float = 1000.0
    min_span: float = 5.0
    max_jump: float = 2.5
    confirm_tolerance: float = 1.0
    channel_difference: int = 18
    erode: int = 0
    inner_fraction: float = 0.20
    padding: int = 6
    decimals: int = 1


def is_number(x: Column) -> Column:
    return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))


def valid_pair(low: Column, high: Column, options: ScaleOptions) -> Column:
    """Both labels are numbers within the allowed range, and high is above low by the least span."""
    inside = lambda x: is_number(x) & x.between(options.min_allowed, options.max_allowed)
    return F.coalesce(inside(low) & inside(high) & (high > low) & (high - low >= options.min_span), F.lit(False))


def near_pair(low: Column, high: Column, last_low: Column, last_high: Column, max_jump: float) -> Column:
    """Whether a pair is within the jump of the last trusted one; any is where there is none yet."""
    none = last_low.isNull() | last_high.isNull()
    return none | ((F.abs(low - last_low) <= max_jump) & (F.abs(high - last_high) <= max_jump))
