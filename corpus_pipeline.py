"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), calls one operator of ``quire.llm`` and returns a DataFrame,
which is written as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``.
"""
from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import packing, repetition, sanitise, simhash, weak_labels
from quire.llm.common import read, workers_find_package
from quire.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat themselves too much, or have under ten words, go."""
    return docs.filter(repetition.repetition(F.col("text"))["kept"])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer trained on weak labels rejects go."""
    scorer, _ = weak_labels.quality(docs)
    return docs.filter(scorer["kept"])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-copies the document with the smallest id stays."""
    return simhash.unique(docs, shingle=3, max_bits=2)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced in the texts; n_chars follows."""
    clean = sanitise.sanitise(docs, everywhere=True)
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in training sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024)


STAGES = [("quality rules", quality_rules), ("quality classifier", quality_classifier), ("simhash near-dedup", near_dedup),
          ("pii", pii), ("packing", pack)]

#: SQL has no suffix arrays, training or tokenizers; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; what lies between them is written to the checkpoint folder."""
    workers_find_package(spark)
    docs = read(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
