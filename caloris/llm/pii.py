"""Personal data, and information-theoretic sanitisation of terms that reveal it. DataFrame functions alone.

Base patterns find the protected entities: e-mail and IP addresses, card and phone numbers. A context is the whole words around one
occurrence of an entity, of any length, as many on each side as the limits say. Over all contexts of the corpus, equal ones (copies) counted once, co-occurrence estimates how strongly a
term t reveals an entity e: PMI(e, t) = log2 p(e, t) / (p(e) p(t)), against the entity's own information IC(e) = -log2 p(e). A term
that gives at least `disclosure` of it, in at least `support` contexts of e, exceeds the threshold and is a span of kind `term`
wherever it stands in a document that holds e.

Nothing is gathered by document or entity: contexts are exploded, counted with partial sums and joined on (entity, term), sides
that Spark can split; texts never enter a shuffle.

Defined results: a null or empty text has no spans. Rows are told apart by a number given when base spans are stored, so null and
repeated ids keep a row each; copies have equal spans. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as S
from .common import WORD, neutral, restored, stored, text_or_empty

KINDS = ("email", "ip", "card", "phone", "term")
# The base patterns. A run of local characters is only tried from its start or from where the last match ended;
# repeated groups that end a pattern are possessive. Neither changes a match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


@dataclass(frozen=True)
class Disclosure:
    """words: of a context, on each side. disclosure: share of an entity's information. shortest: letters and digits of a term."""

    words: int = 6
    support: int = 3
    disclosure: float = 0.9
    shortest: int = 4


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def base_spans(text: Column, found: dict[str, Column]) -> Column:
    """The base spans of a text, by start and kind. found: the columns of its hits by kind."""
    email = S.placed(text, found["email"], EMAIL, "email")
    ip = F.filter(S.placed(text, found["ip"], IP, "ip"), lambda s: s["match"].rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
    card = F.filter(S.placed(text, found["card"], CARD, "card"), lambda s: F.length(_digits(s["match"])).between(14, 19) & F.call_function("luhn_check", _digits(s["match"])))
    phone = F.filter(S.placed(text, found["phone"], PHONE, "phone"), lambda s: F.length(_digits(s["match"])).between(10, 15))
    return S.ordered(F.concat(email, ip, card, phone), KINDS)


def _found(rows: DataFrame) -> DataFrame:
    """rows(__text, ...) with __base. Patterns are only run where a character they need stands in the text."""
    text = F.col("__text")
    none = F.expr("cast(array() as array<string>)")
    needs = {"email": (EMAIL, text.contains("@")), "ip": (IP, text.rlike(r"[0-9]\.[0-9]")), "card": (CARD, text.rlike("[0-9][0-9 -]{13}")), "phone": (PHONE, text.contains("+"))}
    rows = rows.withColumns({f"__{k}": F.when(when, S.hits(text, p)).otherwise(none) for k, (p, when) in needs.items()})
    # a number too long or too short to be a card is dropped before it is placed only if all are: places need every match
    card = F.exists("__card", lambda c: F.length(_digits(c)).between(14, 19))
    rows = rows.withColumn("__card", F.when(card, F.col("__card")).otherwise(none))
    return rows.withColumn("__base", base_spans(text, {k: F.col(f"__{k}") for k in needs}))


def _term(word: Column) -> Column:
    return F.lower(F.regexp_replace(word, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))


def _words(text: Column, base: Column) -> Column:
    """The words of a text that touch no base span, as spans with their terms for matches."""
    words = S.apart(S.placed(text, S.hits(text, WORD), WORD, "term"), base)
    return F.transform(words, lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), _term(w["match"]).alias("match"), w["kind"].alias("kind")))


def _with_contexts(rows: DataFrame, limits: Disclosure) -> DataFrame:
    """rows with __contexts: for each base span its entity, and the terms of the words before and behind it; null where there is none."""
    some = F.size("__base") > 0
    rows = rows.withColumn("__words", F.when(some, _words(F.col("__text"), F.col("__base"))))
    # sorted together, a span has as many words before it as stand before it in the text
    words = F.transform("__words", lambda w: F.struct(w["start"].alias("at"), F.lit(1).alias("n"), F.lit(-1).alias("i")))
    spans = F.transform("__base", lambda b, i: F.struct(b["start"].alias("at"), F.lit(0).alias("n"), i.alias("i")))
    rows = rows.withColumn("__order", F.when(some, F.array_sort(F.concat(words, spans))))
    rows = rows.withColumn("__before", F.when(some, S.bound(F.transform("__order", lambda x: x["n"]), S.sums)))
    places = F.zip_with("__order", "__before", lambda x, k: F.struct(x["i"].alias("i"), k.alias("k")))
    rows = rows.withColumn("__places", F.when(some, F.filter(places, lambda x: x["i"] >= 0)))

    def context(x: Column) -> Column:
        k, n = x["k"], F.lit(limits.words)
        near = F.slice("__words", F.greatest(F.lit(1), k - n + 1), F.least(k, n) + n)
        terms = F.transform(F.filter(near, lambda w: (F.length(w["match"]) >= limits.shortest) & w["match"].rlike(r"\p{L}")), lambda w: w["match"])
        base = F.get("__base", x["i"])
        return F.struct(F.concat_ws(":", base["kind"], base["match"]).alias("entity"), terms.alias("terms"))

    return rows.withColumn("__contexts", F.transform("__places", context)).drop("__words", "__order", "__before", "__places")


def scan(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, limits: Disclosure | None = None) -> DataFrame:
    """The kept columns, then base and spans: arrays of spans (start, end, match, kind), by start and kind."""
    limits = limits or Disclosure()
    keep = [k for k in (df.columns if keep is None else keep) if k not in ("base", "spans")]
    own = [f"k{i}" for i in range(len(keep))]
    rows = _found(df.select(*(F.col(k).alias(o) for k, o in zip(keep, own, strict=True)), text_or_empty(text_col).alias("__text")))
    some = F.size("__base") > 0
    rows = _with_contexts(rows, limits)
    rows = stored(rows.select(*own, F.col("__base").alias("base"), F.when(some, F.col("__text")).alias("text"), F.col("__contexts").alias("contexts"), F.monotonically_increasing_id().alias("row")))
    each = rows.filter(F.size("contexts") > 0).select("row", F.explode("contexts").alias("c")).select("row", "c.entity", "c.terms")
    each = each.withColumn("context", F.xxhash64("terms"))
    triples = stored(each.select("entity", "context", F.explode("terms").alias("term")).distinct())
    of_entity = stored(each.select("entity", "context").distinct().groupBy("entity").agg(F.count("*").alias("n_e")))
    total = F.lit(of_entity.agg(F.sum("n_e")).first()[0] or 0)
    of_term = triples.groupBy("term").agg(F.count("*").alias("n_t"))
    pairs = triples.groupBy("entity", "term").agg(F.count("*").alias("n_et")).filter(F.col("n_et") >= limits.support)
    scored = pairs.join(of_entity, "entity").join(of_term, "term")
    pmi = F.log2(F.col("n_et") * total / (F.col("n_e") * F.col("n_t")))
    information = -F.log2(F.col("n_e") / total)
    telling = stored(scored.filter((information > 0) & (pmi >= limits.disclosure * information)).select("entity", "term"))
    flagged = each.select("row", "entity").distinct().join(telling, "entity").groupBy("row").agg(F.collect_set("term").alias("telling"))
    both = rows.join(flagged, "row", "left")
    both = both.withColumn("words", F.when(F.col("telling").isNotNull(), _words(F.col("text"), F.col("base"))))
    added = F.filter("words", lambda w: F.array_contains("telling", w["match"]))
    all_spans = F.when(F.col("telling").isNotNull(), S.ordered(F.concat("base", added), KINDS)).otherwise(F.col("base"))
    return both.select(*(F.col(o).alias(k) for k, o in zip(keep, own, strict=True)), "base", all_spans.alias("spans"))


def sanitise(df: DataFrame, text_col: str = "text", limits: Disclosure | None = None) -> DataFrame:
    """df with entities removed and telling terms generalised: an entity becomes a mark of its kind, a term its shape (letters to
    x, digits to 0). Nulls stay."""
    own, names = neutral(df)
    text = names[text_col]
    found = scan(own, text, limits=limits)
    shape = lambda s: F.regexp_replace(F.regexp_replace(s["match"], r"\p{L}", "x"), r"\p{N}", "0")
    mark = lambda s: F.when(s["kind"] == "term", shape(s)).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    clean = F.when(F.size("spans") > 0, S.replaced(F.col(text), F.col("spans"), mark)).otherwise(F.col(text))
    return restored(found.withColumn(text, clean), names)


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the counts of base spans, and the base spans' digest and all spans as text."""
    found = scan(df, text_col, [id_col])
    base = F.col("base")
    return found.select(id_col, *(S.counted(base, k).alias(f"n_{k}") for k in KINDS[:4]), F.sha2(S.joined(base), 256).alias("base_sha256"), S.joined(F.col("spans")).alias("spans"))
