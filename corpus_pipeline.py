"""A training corpus from raw documents: stages over the operators of tendersift.llm, each written and reread."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tendersift.llm import nbsvm, toxicity
from tendersift.llm.bpe import Codec
from tendersift.llm.cube import mixture
from tendersift.llm.overlap import deduplicated
from tendersift.llm.texts import read
from tendersift.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return nbsvm.accepted(docs, nbsvm.fit(docs, read(spark, sf_dir, "labels")))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not found toxic."""
    return toxicity.accepted(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: fingerprints of five-word shingles by ball hashing, verified at Jaccard 0.8."""
    return deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixture(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids and their round trip, as digests."""
    return Codec(docs).round_trip(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("toxicity", clean),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("bpe", tokens),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every result but the last is a Parquet table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = f"{folder}/{i + 1}_{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
