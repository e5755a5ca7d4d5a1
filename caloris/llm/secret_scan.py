"""Secret scans: key patterns, and a randomness test battery for other tokens. DataFrame functions alone.

Tokens are the long runs of either base-64 alphabet: '=' parts them (NAME=value) unless it is padding, and of a path that mixes '/'
with '-' or '_' the parts between either are taken. Each that mixes letters and digits gets the smallest encoding that holds it (hex, base32, base36,
base62, base64). Three statistics are taken over its symbols: chi-squared against a uniform alphabet, the number of runs of
character classes, and lag-one serial correlation. Each is used twice. A token is only a candidate if no test rejects that it was
drawn uniformly. Its p-value asks the opposite: how likely text-like tokens (skewed letters, few class changes, correlated
neighbours) would look so random; the three z-scores are added and scaled. Within a document, candidates are then accepted by the
Benjamini-Hochberg rule with weights in proportion to length, as longer tokens carry more evidence. Of accepted tokens
that lie in one another the outer one is reported.

Defined results: a null or empty text has no spans. Rows are independent of each other: repeated rows give repeated results, an empty
table an empty one. Columns made here are named with two leading underscores until the end; only asked-for columns are returned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as S
from .common import neutral, restored, text_or_empty

KINDS = ("assign", "access", "hex", "random")
# The base patterns. Runs that end a pattern are possessive, which changes no match.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
# Runs of each base-64 alphabet; an equals sign only belongs to one as padding, which no symbol follows.
PADDING = r"(?:={1,6}+(?![A-Za-z0-9+/_=-]))?+"
TOKENS = (r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{20,}+" + PADDING, r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+" + PADDING)
# The symbols of each encoding, smallest first.
ENCODINGS = (
    ("hex", "0123456789abcdef"),
    ("hex", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)


@dataclass(frozen=True)
class Battery:
    """alpha: level at which one test rejects that a token is uniform. q: false-discovery rate in a document. The last three
    describe text-like tokens: chance that two symbols are equal, rate of class changes, serial correlation."""

    alpha_z: float = 3.1
    q: float = 1e-4
    coincidence: float = 0.066
    changes: float = 0.15
    correlation: float = 0.4


def _normal_tail(z: Column) -> Column:
    """P(Z > z), by the logistic approximation with a cubic term."""
    return 1.0 / (1.0 + F.exp(F.least(F.lit(600.0), F.greatest(F.lit(-600.0), 1.5976 * z + 0.070565992 * z * z * z))))


def _classes(symbols: str) -> list[int]:
    return [sum(f(c) for c in symbols) for f in (str.isdigit, str.isupper, str.islower, lambda c: not c.isalnum())]


def _measure(token: Column, battery: Battery) -> Column:
    """struct(z, uniform) of a token: its summed z-score against text, and whether no test rejects uniformity."""
    body = F.rtrim(token, F.lit("="))
    encoding = F.coalesce(*(F.when(body.rlike("^[" + s.replace("-", r"\-").replace("+", r"\+") + "]+$"), F.struct(F.lit(s).alias("symbols"), F.lit(float(len(s))).alias("a"), F.lit(1.0 - sum((n / len(s)) ** 2 for n in _classes(s))).alias("r"))) for _, s in ENCODINGS))
    start = F.struct(body.alias("body"), F.length(body).cast("double").alias("n"), encoding.alias("e"))

    def with_codes(x: Column) -> Column:
        chars = F.filter(F.split(x["body"], ""), lambda c: c != "")
        codes = F.transform(chars, lambda c: F.call_function("instr", x["e"]["symbols"], c).cast("double"))
        kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(x["body"], "[0-9]", "0"), "[A-Z]", "A"), "[a-z]", "a"), "[^0Aa]", "+")
        runs = F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")).cast("double")
        distinct = F.array_distinct(chars)
        squares = F.aggregate(distinct, F.lit(0.0), lambda acc, c: acc + F.pow(F.length(x["body"]) - F.length(F.replace(x["body"], c, F.lit(""))), F.lit(2.0)))
        return F.struct(x["n"].alias("n"), x["e"]["a"].alias("a"), x["e"]["r"].alias("r"), codes.alias("codes"), (runs - 1).alias("changes"), squares.alias("squares"))

    def with_moments(x: Column) -> Column:
        total = F.aggregate(x["codes"], F.lit(0.0), lambda acc, c: acc + c)
        return F.struct(x["n"].alias("n"), x["a"].alias("a"), x["r"].alias("r"), x["codes"].alias("codes"), x["changes"].alias("changes"), (x["a"] / x["n"] * x["squares"] - x["n"]).alias("chi"), (total / x["n"]).alias("mean"))

    def with_serial(x: Column) -> Column:
        off = F.transform(x["codes"], lambda c: c - x["mean"])
        both = F.zip_with(F.slice(off, F.lit(1), F.size(off) - 1), F.slice(off, F.lit(2), F.size(off) - 1), lambda a, b: a * b)
        spread = F.aggregate(off, F.lit(0.0), lambda acc, c: acc + c * c)
        rho = F.when(spread > 0, F.aggregate(both, F.lit(0.0), lambda acc, c: acc + c) / spread).otherwise(1.0)
        return F.struct(*(x[k].alias(k) for k in ("n", "a", "r", "changes", "chi")), rho.alias("rho"))

    def verdict(x: Column) -> Column:
        n, a, r, df = x["n"], x["a"], x["r"], x["a"] - 1.0
        cube = F.lit(2.0) / (9.0 * df)
        uniform_chi = (F.cbrt(F.greatest(F.lit(0.0), x["chi"]) / df) - (1.0 - cube)) / F.sqrt(cube)
        uniform_runs = (x["changes"] - (n - 1.0) * r) / F.sqrt((n - 1.0) * r * (1.0 - r))
        uniform_serial = (x["rho"] + 1.0 / n) * F.sqrt(n)
        uniform = (uniform_chi <= battery.alpha_z) & (F.abs(uniform_runs) <= battery.alpha_z) & (F.abs(uniform_serial) <= battery.alpha_z)
        text_chi = n * (a * battery.coincidence - 1.0) + a * (1.0 - battery.coincidence)
        # an alphabet as small as hex is hardly more uneven in text: where the two can't be told apart, this test says nothing
        z_chi = F.when(text_chi > df, (text_chi - x["chi"]) / F.sqrt(2.0 * text_chi)).otherwise(0.0)
        z_runs = (x["changes"] - (n - 1.0) * battery.changes) / F.sqrt((n - 1.0) * battery.changes * (1.0 - battery.changes))
        z_serial = (battery.correlation - x["rho"]) * F.sqrt(n)
        return F.struct(((z_chi + z_runs + z_serial) / F.sqrt(F.lit(3.0))).alias("z"), uniform.alias("uniform"))

    value = F.array(start)
    for f in (with_codes, with_moments, with_serial, verdict):
        value = F.transform(value, f)
    return F.when(encoding.isNotNull(), value[0])


def scan(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, battery: Battery | None = None) -> DataFrame:
    """The kept columns, then base and spans: arrays of spans (start, end, match, kind), by start and kind."""
    battery = battery or Battery()
    keep = [k for k in (df.columns if keep is None else keep) if k not in ("base", "spans")]
    rows = df.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keep)), text_or_empty(text_col).alias("__text"))
    text = F.col("__text")
    kinds = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("random0", TOKENS[0]), ("random1", TOKENS[1]))
    mixed = lambda t: t.rlike("[0-9]") & t.rlike("[A-Za-z]")
    rows = rows.withColumns({f"__{k}": S.hits(text, p) for k, p in kinds})
    # tokens without both letters and digits are dropped once their places are known; most texts have none
    rows = rows.withColumn("__some", F.exists("__random0", mixed) | F.exists("__random1", mixed))
    placed = {k: S.placed(text, F.col(f"__{k}"), p, k.rstrip("01")) for k, p in kinds}
    placed["random"] = S.distinct(F.concat(placed["random0"], placed["random1"]))
    placed["assign"] = F.filter(placed["assign"], lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 6)
    placed["random"] = F.filter(F.when(F.col("__some"), placed["random"]).otherwise(F.expr(S.NO_SPANS)), lambda s: mixed(s["match"]))
    rows = rows.withColumn("__base", S.ordered(F.concat(placed["assign"], placed["access"], placed["hex"]), KINDS)).withColumn("__random", placed["random"])
    rows = rows.withColumn("__random", S.apart(F.col("__random"), F.col("__base")))
    judged = F.transform("__random", lambda s: F.struct(s.alias("span"), _measure(s["match"], battery).alias("m"), F.length(s["match"]).cast("double").alias("n")))
    rows = rows.withColumn("__judged", F.when(F.size("__random") > 0, F.filter(judged, lambda x: x["m"]["uniform"])))
    rows = rows.withColumn("__mean", F.aggregate("__judged", F.lit(0.0), lambda acc, x: acc + x["n"]) / F.size("__judged"))
    weighted = F.transform("__judged", lambda x: F.struct((_normal_tail(x["m"]["z"]) / (x["n"] / F.col("__mean"))).alias("p"), x["span"].alias("span")))
    rows = rows.withColumn("__p", F.when(F.size("__judged") > 0, F.array_sort(weighted)))
    m = F.size("__p")
    accepted = F.array_max(F.filter(F.transform("__p", lambda x, i: F.when(x["p"] <= (i + 1) * battery.q / m, i + 1).otherwise(0)), lambda k: k > 0))
    added = F.transform(F.slice("__p", F.lit(1), F.coalesce(accepted, F.lit(0))), lambda x: x["span"])
    rows = rows.withColumn("__added", F.coalesce(added, F.expr(S.NO_SPANS)))
    rows = rows.withColumn("__added", F.when(F.size("__added") > 0, S.outermost(F.col("__added"))).otherwise(F.col("__added")))
    all_spans = F.when(F.size("__added") > 0, S.ordered(F.concat("__base", "__added"), KINDS)).otherwise(F.col("__base"))
    return rows.select(*(F.col(f"__k{i}").alias(k) for i, k in enumerate(keep)), F.col("__base").alias("base"), all_spans.alias("spans"))


def redact(df: DataFrame, text_col: str = "text", size_col: str | None = None, battery: Battery | None = None) -> DataFrame:
    """df with each secret in text replaced by a mark that names its kind; size_col, if given, gets the new length. Nulls stay."""
    own, names = neutral(df)
    text = names[text_col]
    found = scan(own, text, battery=battery)
    clean = S.replaced(F.col(text), F.col("spans"), lambda s: F.concat(F.lit("[SECRET:"), s["kind"], F.lit("]")))
    found = found.withColumn(text, F.when(F.size("spans") > 0, clean).otherwise(F.col(text)))
    if size_col:
        size = names[size_col]
        found = found.withColumn(size, F.when(F.size("spans") > 0, F.length(text).cast(df.schema[size_col].dataType)).otherwise(F.col(size)))
    return restored(found, names)


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the counts of base spans, and the base spans' digest and all spans as text."""
    found = scan(df, text_col, [id_col])
    base = F.col("base")
    return found.select(id_col, *(S.counted(base, k).alias(f"n_{k}") for k in KINDS[:3]), F.sha2(S.joined(base), 256).alias("base_sha256"), S.joined(F.col("spans")).alias("spans"))
