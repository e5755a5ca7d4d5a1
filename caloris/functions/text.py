"""Column functions for label texts, names and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"-?[0-9]+(?:\.[0-9]+)?"


def parse_temperature(text: Column, decimals: int = 1) -> Column:
    """The temperature that a label's text states, or null.

    Characters other than digits, points and minus signs go first; the first number counts. A number without a point is taken to
    have lost it: it needs decimals + 2 digits at least, and its last `decimals` digits are decimals.
    """
    number = F.regexp_extract(F.regexp_replace(text, r"[^0-9.\-]", ""), _NUMBER, 0)
    value = number.try_cast("double")
    if decimals <= 0:
        return value
    digits = F.length(F.regexp_replace(number, "[^0-9]", ""))
    return F.when(F.contains(number, F.lit(".")), value).when(digits >= decimals + 2, value / float(10**decimals))


def digit_count(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), "[^0-9]", ""))


def has_point(text: Column) -> Column:
    return F.contains(F.coalesce(text, F.lit("")), F.lit(".")).cast("int")


def scan_quality(text: Column) -> Column:
    """How well a text reads as a label, for the scan of a clip: two for a point, a quarter for each of up to four digits."""
    return 2.0 * has_point(text) + 0.25 * F.least(digit_count(text), F.lit(4))


def setup_quality(text: Column) -> Column:
    """The same when a recipe is chosen: four for a point, one for each of up to four digits."""
    return (4 * has_point(text) + F.least(digit_count(text), F.lit(4))).cast("double")


def finite(value: Column) -> Column:
    """value as a double; null where it is none, not a number or infinite."""
    x = value.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def safe_name(name: Column) -> Column:
    """Letters and digits of any script stay; runs of anything else become one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(name, r"[^\p{L}\p{N}]+", "_"), "^_+|_+$", "")


def preset_name(name: Column, fallback: str = "preset") -> Column:
    """Points, underscores and hyphens stay as well; an empty result becomes the fallback."""
    kept = F.regexp_replace(F.regexp_replace(name, r"[^A-Za-z0-9._\-]+", "_"), r"^[._]+|[._]+$", "")
    return F.when(kept == "", F.lit(fallback)).otherwise(kept)


def human_time(seconds: Column) -> Column:
    """mm:ss.ss of a time at or after zero."""
    whole = F.greatest(seconds, F.lit(0.0))
    minutes = F.floor(whole / 60)
    return F.format_string("%02d:%05.2f", minutes, whole - minutes * 60)


def now_utc() -> Column:
    """The current time in UTC, to the second, as ISO 8601 text; the session's time zone doesn't matter."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def frame_time(frame: Column, fps: Column) -> Column:
    """Seconds from the start of the video; null where fps is not positive."""
    return F.when(fps > 0, frame / fps)


def ocr_interval(fps: Column, hz: Column) -> Column:
    """Frames between two readings: at least one, halves to even."""
    return F.greatest(F.lit(1), F.rint(fps / hz).cast("int"))


def redact_url(url: Column) -> Column:
    """A stream address without user and password."""
    return F.regexp_replace(url, r"^(rtsps?://)[^/@]*@", "$1")


def with_login(url: str, user: str | None, password: str | None) -> str:
    """A stream address with a percent-encoded login, unless it has one. Only rtsp addresses pass."""
    from urllib.parse import quote

    scheme, mark, rest = url.partition("://")
    if not mark or scheme.lower() != "rtsp":
        raise ValueError("a stream address begins with rtsp://")
    host = rest.split("/", 1)[0]
    if not user or "@" in host:
        return url
    login = quote(user, safe="") + (f":{quote(password, safe='')}" if password else "")
    return f"{scheme}://{login}@{rest}"


def mirrored(path: Column, root: str) -> Column:
    """The folders of a path below the last folder called root (in any case) and the file's stem; the stem alone without one."""
    clean = F.regexp_replace(path, r"\\", "/")
    below = F.regexp_extract(clean, rf"(?i)(?:^|.*/){root}/(.+)$", 1)
    rest = F.when(below != "", below).otherwise(F.regexp_extract(clean, "[^/]*$", 0))
    return F.regexp_replace(rest, r"\.[^./]*$", "")
