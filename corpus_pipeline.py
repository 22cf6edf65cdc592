"""The corpus pipeline: documents that are not toxic, without repeated runs of lines and near
copies, mixed to target weights and encoded. Each stage works on all that the one before kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from foliospark.llm import line_dedup, mixing, sentencepiece_codec, simhash, toxicity
from foliospark.session import remove_folder, shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; labels of this folder teach."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs, toxicity.train(docs, labels))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines of 50 words or more that repeat an earlier one."""
    return line_dedup.remove_repeats(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints over three-word shingles link within two bits."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.apply(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids and digests of the ids and of the decoded text of each document."""
    return sentencepiece_codec.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: The network, the fingerprints and the encoding have no form in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written to the shared folder and read back,
    and goes when the next one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, last = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        at = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
        if last:
            remove_folder(spark, last)
        last = at
    return docs
