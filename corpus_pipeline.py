"""A training corpus from ``documents``: five stages, each written before the next one reads it.

    toxicity       documents that the classifier rejects go
    near_dedup     one document of each group of near-duplicates stays
    decontaminate  documents that hold a benchmark item go
    secrets        secrets are replaced in the texts; every document stays
    mix            every use of every document in the mixture of sources
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm import decontam, mixing, neardup, secrets, toxicity
from tillwatch.llm.common import free_name, remainder, shared_folder, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below 0.7, by a network fitted to labels of remainder 0 and 2."""
    labels = table(spark, sf_dir, "labels")
    network = toxicity.train(docs, labels, remainder("doc_id", 3) != 1)
    name = free_name(docs.columns, "score")
    return toxicity.score(docs, network, score_name=name).where(F.col(name) < 0.7).select(docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of five-word shingle sets alike by 80 %.

    Rows of one id are one document and one of them stays; rows without an id stay.
    """
    found = neardup.near_duplicates(docs, size=5, percent=80)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    named = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    if docs.groupBy("doc_id").count().where("doc_id is not null and count > 1").isEmpty():
        return named
    return named.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(named.where("doc_id is null"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    name = free_name(docs.columns, "items")
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), items_name=name).where(F.size(name) == 0).select(docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced."""
    return secrets.redact(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, tokens, epoch, block, block_key, doc_key): the uses of all documents, in training order."""
    return mixing.plan(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("secrets", secrets_stage),
    ("mix", mix_stage),
]

#: The classifier, the sketches and the latent space have no SQL form; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
