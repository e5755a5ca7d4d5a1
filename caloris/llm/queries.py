"""The registered queries of this subpackage: thin layers that apply an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_is, stored, table


def _tokenizer(name: str) -> str:
    """The default place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import langid

    documents = table(spark, sf_dir, "documents")
    held_out = fold_is("doc_id", 4, 2)
    model = langid.fit(documents, where=~held_out)
    return langid.identify(documents.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])


def op2_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import vectors

    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import secret_scan

    return secret_scan.digests(table(spark, sf_dir, "documents"))


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import lm

    held_out = fold_is("doc_id", 5, 1)
    scored = lm.score(table(spark, sf_dir, "documents"), ~held_out)
    columns = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")
    return scored.select("doc_id", held_out.alias("held_out"), *columns)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import bpe

    return bpe.digests(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii

    return pii.digests(table(spark, sf_dir, "documents"))


def op7_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import fertility

    return fertility.quality(table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"), keep=["doc_id"])


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import simhash

    prints = stored(simhash.fingerprints(table(spark, sf_dir, "documents"), keep=["doc_id"]))
    found = simhash.near_duplicates(prints)
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing

    found = mixing.mix(table(spark, sf_dir, "documents"), mixing.cycle_weights(5, 2, 1), keep=["doc_id"])
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import licenses

    return licenses.digests(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import whitening

    return whitening.whiten(table(spark, sf_dir, "embeddings"), keep=["vec_id"])


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import phrases

    return phrases.mine(table(spark, sf_dir, "documents"))


def op13_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import exact

    documents = table(spark, sf_dir, "documents").withColumn("text_sha256", F.sha2(exact.normalised("text"), 256))
    return exact.groups(documents, keep=["doc_id", "text_sha256"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language, op2_vectors, op3_secrets, op4_lm, op5_bpe, op6_pii, op7_fertility, op8_simhash, op9_mixing, op10_licenses, op11_whitening, op12_phrases, op13_exact)}


def oracle_sql() -> dict[str, str]:
    from .sql import SQL

    return dict(SQL)
