"""Exact duplicates by progressive refinement: equal lengths, then equal hashes of a prefix, then equal hashes of whole texts.

Texts never enter a shuffle on the way to a decision. One scan leaves the length and the prefix's hash of each text; what survives
each level is a set of fixed size (a table of bits, one in each class of 2 ** BITS), which is broadcast; a second scan hashes the whole
of those texts alone whose class survives. Two classes that share a bit cost a needless hash, never a wrong result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import neutral, stored

#: Characters of the prefix.
PREFIX = 256
#: A set holds 2 ** BITS bits in at most 2 ** (BITS - 6) rows of two longs, 4 MB of data, whatever the number of texts.
BITS = 24
#: Groups of more rows than LARGE meet their result in SHARES places.
LARGE, SHARES = 1000, 64


def normalised(text: str | Column) -> Column:
    """Each run of white space as one space; null as the empty text. Single spaces, the usual case, are no match."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def _place(bits: int, *key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(1 << bits))


def _surviving(rows: DataFrame, key: list[str], bits: int) -> DataFrame:
    """The set of those keys that more than one row has."""
    return _bits(rows.groupBy(*key).count().filter("count > 1"), key, bits)


def _bits(keys: DataFrame, key: list[str], bits: int) -> DataFrame:
    """A set of keys: (word, held), a bit a key."""
    return keys.select(_place(bits, *key).alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("held"))


def _marked(rows: DataFrame, key: list[str], members: DataFrame, bits: int, name: str) -> DataFrame:
    """rows with a column that tells whether the set has their key. The set's size is bounded by its bits, so it may be broadcast."""
    rows = rows.withColumn("place", _place(bits, *key)).withColumn("word", F.shiftright("place", 6))
    found = rows.join(F.broadcast(members), "word", "left")
    on = F.coalesce(F.expr("shiftright(held, cast(place & 63 as int)) & 1L"), F.lit(0)) == 1
    return found.withColumn(name, on).drop("place", "word", "held")


def _grouped(df: DataFrame, id_col: str, text_col: str, prefix: int, bits: int) -> tuple[DataFrame, dict[str, str]]:
    """df's rows, its columns renamed, with keep_id, group_size and kept."""
    named, names = neutral(df)
    own = F.col(names[id_col])
    marks = named.withColumn("whole", normalised(names[text_col]))
    marks = marks.withColumns({"size": F.octet_length("whole"), "prefix": F.xxhash64(F.substring("whole", 1, prefix))})

    lengths = stored(marks.select("size", "prefix"))
    alike = _marked(lengths, ["size"], _surviving(lengths, ["size"], bits), bits, "alike").filter("alike")
    classes = stored(_surviving(alike, ["size", "prefix"], bits))
    marks = _marked(marks, ["size", "prefix"], classes, bits, "alike")
    full = F.when(F.col("alike"), F.unhex(F.sha2("whole", 256)))
    rows = stored(marks.select(*names.values(), F.monotonically_increasing_id().alias("row"), full.alias("full")))

    hashed = rows.filter("full IS NOT NULL")
    # of equal ids in a group the first row stays, and a null id only where all are null
    first = F.min(F.struct(own.isNull().alias("missing"), own.alias("id"), F.col("row").alias("row")))
    groups = stored(hashed.groupBy("full").agg(F.count("*").alias("n"), first.alias("first")).filter("n > 1"))
    # a large group is dealt out: its rows by row number, its one result to each share. What shares a bit with one is dealt out as well
    large = _bits(groups.filter(F.col("n") > LARGE).select("full"), ["full"], bits)
    groups = _marked(groups, ["full"], large, bits, "dealt").withColumn("share", F.explode(F.when(F.col("dealt"), F.sequence(F.lit(0), F.lit(SHARES - 1))).otherwise(F.array(F.lit(0)))))
    hashed = _marked(hashed, ["full"], large, bits, "dealt").withColumn("share", F.when(F.col("dealt"), F.pmod(F.xxhash64("row"), F.lit(SHARES))).otherwise(0).cast("int"))
    shared = hashed.join(groups.drop("dealt"), ["full", "share"], "left").select(
        *names.values(), F.when(F.col("n").isNull(), own).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), F.coalesce(F.col("row") == F.col("first.row"), F.lit(True)).alias("kept"),
    )
    alone = rows.filter("full IS NULL").select(*names.values(), own.alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    return shared.union(alone), names


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, prefix: int = PREFIX, bits: int = BITS) -> DataFrame:
    """Columns `keep` of every row (the id, if not given), then keep_id, group_size and kept. Native: DataFrame functions alone.

    Texts are equal when identical after each run of [\\x20\\x09-\\x0D] has become one space. Of equal texts the row with the
    smallest id stays; keep_id is its id. A null text is an empty one, and all empty texts are one group. A null id counts as the
    largest; of rows that repeat both id and text one stays, which of them is open. A text of any length is hashed whole. An empty
    table gives an empty result; columns of any names are carried along, but a kept column of a made one's name gives way to it.
    """
    keep = [id_col] if keep is None else keep
    found, names = _grouped(df.select(*dict.fromkeys([*keep, id_col, text_col])), id_col, text_col, prefix, bits)
    made = ["keep_id", "group_size", "kept"]
    return found.select(*(F.col(names[k]).alias(k) for k in keep if k not in made), *made)


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX, bits: int = BITS) -> DataFrame:
    """The rows of df that stay, one of each group, with the columns of df."""
    found, names = _grouped(df, id_col, text_col, prefix, bits)
    return found.filter("kept").select(*(F.col(c).alias(k) for k, c in names.items()))
