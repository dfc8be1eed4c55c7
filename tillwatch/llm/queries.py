"""The checked queries of the training-data operators: op<N>_<name>, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm import (
    decontam, html_extract, imatch, langid, mixing, neardup, phrases, pii, quality, secrets, simhash, toxicity, whitening,
)
from tillwatch.llm.common import remainder, spans_text, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def number_of_kind(kind: int) -> Column:
    """How many base spans of a kind a row has."""
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


@query
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every use of every document in a mixture at 95 % of the sources' largest entropy."""
    return mixing.plan(table(spark, sf_dir, "documents"))


ORACLE["op2_source_mixing"] = mixing.PLAN_SQL


@query
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles are 80 % alike."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a network fitted to labels with remainder 0 or 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    network = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    scored = toxicity.score(docs, network)
    return scored.select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        (F.col("score") >= F.col("limit")).cast("int").alias("predicted_for_language"),
    )


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents by a model fitted to documents with remainder 0, 1 or 3."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs, remainder("doc_id", 4) != 2)
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "accepted")


@query
def op6_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base secrets and linked credential parts of all documents."""
    found = secrets.report(table(spark, sf_dir, "documents"))
    counts = [number_of_kind(n).alias(f"n_{kind}") for n, kind in enumerate(secrets.BASE_KINDS)]
    return found.select("doc_id", *counts, F.sha2(spans_text(F.col("base"), secrets.KINDS), 256).alias("base_sha256"),
                        spans_text(F.col("spans"), secrets.KINDS).alias("spans"))


@query
def op7_pii_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of personal data and what the random field adds, of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    counts = [number_of_kind(n).alias(f"n_{kind}") for n, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(spans_text(F.col("base"), pii.KINDS), 256).alias("base_sha256"),
                        spans_text(F.concat("base", "added"), pii.KINDS).alias("spans"))


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("items") > 0).alias("leaked"), "items", "share")


@query
def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of all documents and of their edited texts."""
    return imatch.compare(table(spark, sf_dir, "documents"))


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main texts of all pages."""
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op8_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; documents with remainder 1 lend no label."""
    scored = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "site_prior",
                         (F.col("score") >= 0.5).alias("keep"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the leading components of their covariance, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose SimHash fingerprints differ in at most three bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of each language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))
