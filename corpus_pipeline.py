"""A training corpus from the documents table: recognised languages, no near-duplicates, no secrets, mixed sources, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caloris.llm import bpe, langid, mixing, secret_scan, simhash
from caloris.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn the languages of the labelled documents; documents without a recognised language go.

    A null or empty text, or one without a letter, has no language and goes; of equal scores the language first by code point counts;
    repeated rows stay or go together. Without any labelled row none is recognised. An empty table stays empty.
    """
    return langid.recognised(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash of five-word shingles, checked exactly at a Jaccard similarity of 0.8: of each group of near copies the smallest id stays.

    Null and texts without words are copies of one another; rows with a null id stay; of rows that repeat an id and a text one stays.
    An empty table stays empty; other columns are carried along, whatever their names.
    """
    return simhash.dedup(docs, shingle=5, similarity=0.8)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by marks in the texts, n_chars follows; every document stays.

    Null and empty texts stay as they are; repeated rows are changed alike; n_chars is left alone if the table lacks it.
    """
    return secret_scan.redact(docs, size_col="n_chars" if "n_chars" in docs.columns else None)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh 5, 2, 1, repeating, up to three times their size; a document stands as often as the mix takes it.

    Null and empty texts have size 0 and stand as often as their hash says; a null source is the last source; rows of one id are taken
    alike. An empty table stays empty.
    """
    return mixing.repeated(docs, mixing.cycle_weights(5, 2, 1))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document in the mix, and their number; none for a null or empty text. Repeated rows give repeated results."""
    import public_tokenizers

    ids = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id", "lang", "source"])
    return ids.selectExpr("doc_id", "lang", "source", "cast(size(ids) as bigint) as n_tokens", "ids")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mix", mix), ("encode", encode)]
#: Fingerprints and merges are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
