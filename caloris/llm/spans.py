"""Spans of pattern matches as arrays, with DataFrame functions alone.

A span is a struct of start, end (code points, end exclusive), match and kind. Java counts UTF-16 units, Spark's length counts code
points: so starts come from summing the lengths of what split() leaves between the matches and of the matches. Patterns avoid
nested backtracking: repeated groups are possessive, which Java runs without recursion, and runs start only where the run begins.

Time is in proportion to the number of spans but for sorting: running sums and maxima are taken in blocks of blocks, and spans are
held against others by sorting both together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,match:string,kind:string>"
#: Values merged at a time.
BLOCK = 64
NO_SPANS = f"cast(array() as array<{SPAN}>)"


def hits(text: Column, pattern: str) -> Column:
    """The leftmost non-overlapping matches."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.transform(F.array(value), f)[0]


def running(values: Column, zero: Column, merge: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """For each value what merging the ones before it gives; values must be bound. Blocks of BLOCK values are merged level by level."""
    if not levels:
        return F.transform(values, lambda _, i: F.aggregate(F.slice(values, F.lit(1), i), zero, merge))
    n_blocks = F.ceil(F.size(values) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), n_blocks - 1)), lambda b: F.aggregate(F.slice(values, b * BLOCK + 1, F.lit(BLOCK)), zero, merge))
    before = bound(blocks, lambda v: running(v, zero, merge, levels - 1))
    within = lambda known: F.transform(values, lambda _, i: F.aggregate(F.slice(values, i - i % BLOCK + 1, i % BLOCK), F.get(known, F.floor(i / BLOCK).cast("int")), merge))
    return bound(before, within)


def sums(values: Column) -> Column:
    return running(values, F.lit(0), lambda a, x: a + x)


def maxima(values: Column) -> Column:
    """-1 where there is nothing before."""
    return running(values, F.lit(-1), lambda a, x: F.greatest(a, x))


def placed(text: Column, found: Column, pattern: str, kind: str) -> Column:
    """Spans of found, the column of hits() for this text and pattern. Pieces are only cut where something was found."""
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    pairs = F.zip_with(found, between, lambda m, gap: F.struct(m.alias("m"), F.length(m).alias("own"), (F.length(gap) + F.length(m)).alias("n")))

    def spans(v: Column) -> Column:
        before = bound(F.transform(v, lambda x: x["n"]), sums)
        return F.zip_with(v, before, lambda x, at: F.struct((at + x["n"] - x["own"]).alias("start"), (at + x["n"]).alias("end"), x["m"].alias("match"), F.lit(kind).alias("kind")))

    return F.when(F.size(found) > 0, bound(pairs, spans)).otherwise(F.expr(NO_SPANS))


def apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others. Both are sorted together: before a span's end stand the others that start before it."""

    def held(v: Column) -> Column:
        ends = F.transform(v["spans"], lambda s, i: F.struct(s["end"].alias("at"), F.lit(0).alias("rank"), F.lit(-1).alias("reach"), s["start"].alias("from"), i.alias("i")))
        starts = F.transform(v["others"], lambda o: F.struct(o["start"].alias("at"), F.lit(1).alias("rank"), o["end"].alias("reach"), F.lit(-1).alias("from"), F.lit(-1).alias("i")))

        def free(both: Column) -> Column:
            reach = bound(F.transform(both, lambda x: x["reach"]), maxima)
            known = F.zip_with(both, reach, lambda x, r: F.when((x["rank"] == 0) & (r <= x["from"]), x["i"]))
            return F.transform(F.array_sort(F.filter(known, lambda i: i.isNotNull())), lambda i: F.get(v["spans"], i))

        return bound(F.array_sort(F.concat(ends, starts)), free)

    return F.when((F.size(spans) > 0) & (F.size(others) > 0), bound(F.struct(spans.alias("spans"), others.alias("others")), held)).otherwise(spans)


def distinct(spans: Column) -> Column:
    """Spans in order, equal ones once."""
    return bound(F.array_sort(spans), lambda v: F.filter(v, lambda s, i: ~s.eqNullSafe(F.get(v, i - 1))))


def outermost(spans: Column) -> Column:
    """Spans, by start, that lie in no other; equal ones once."""

    def outer(v: Column) -> Column:
        reach = bound(F.transform(v, lambda x: x["s"]["end"]), maxima)
        return F.transform(F.filter(F.zip_with(v, reach, lambda x, r: F.struct(x["s"].alias("s"), (r < x["s"]["end"]).alias("out"))), lambda x: x["out"]), lambda x: x["s"])

    return bound(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("low"), s.alias("s")))), outer)


def ordered(spans: Column, kinds: tuple[str, ...]) -> Column:
    """Spans by start, then by the place of their kind in kinds, then by end."""
    rank = F.create_map(*(F.lit(x) for i, k in enumerate(kinds) for x in (k, i)))
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["match"].alias("match"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match"), s["kind"].alias("kind")))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def replaced(text: Column, spans: Column, mark: Callable[[Column], Column]) -> Column:
    """text with each span replaced by mark(span); spans must be ordered; one that starts inside an earlier one adds nothing but its length."""

    def parts(v: Column) -> Column:
        done = bound(F.transform(v, lambda s: s["end"]), maxima)

        def part(s: Column, r: Column) -> Column:
            at = F.greatest(F.lit(0), r)
            return F.when(s["start"] >= at, F.concat(F.substring(text, at + 1, s["start"] - at), mark(s))).otherwise(F.lit(""))

        rest = F.substring(text, F.array_max(F.transform(v, lambda s: s["end"])) + 1, F.length(text))
        return F.concat(F.array_join(F.zip_with(v, done, part), ""), rest)

    return F.when(F.size(spans) > 0, bound(spans, parts)).otherwise(text)
