"""Token counts through a cache of content digests.

A text's digest and the tokenizer's version are looked up in a table of stored counts; only the
distinct digests that it lacks are encoded, and their counts are appended to it.  Digests are
taken on normalised content: white space is folded where the tokenizer ignores its length.
"""
from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..session import ensure_checkpoint_dir, materialize
from . import tokens
from .common import inputs, slices

CACHE = "digest binary, version string, n_tokens long"


def version_of(tokenizer: str) -> str:
    """The version of a tokenizer file: the digest of its content."""
    with open(tokenizer, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def special_strings(tokenizer: str) -> list[str]:
    """The strings of the special tokens that a tokenizer file adds."""
    with open(tokenizer, encoding="utf-8") as file:
        return [x["content"] for x in json.load(file).get("added_tokens", [])]


def folded(text: Column, specials: list[str]) -> Column:
    """Runs of white space as one space, for tokenizers that drop white space.

    Texts that hold the string of a special token keep theirs.
    """
    plain = F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " ")
    return F.when(reduce(or_, [text.contains(x) for x in specials]), text).otherwise(plain) if specials else plain


def begin(spark: SparkSession, path: str) -> None:
    """The folder of the cache, by an append of no row: what is there stays."""
    spark.createDataFrame([], CACHE).write.mode("append").parquet(path)


def stored(spark: SparkSession, path: str, version: str) -> DataFrame:
    """(digest, n_tokens) of the cache at ``path`` for one tokenizer version."""
    rows = spark.read.schema(CACHE).parquet(path)
    # two jobs may have appended the same digest
    return rows.filter(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, fold_space: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row of ``docs``.

    ``tokenizer``: path of a ``tokenizers`` file; no special tokens are added.  ``cache``: folder of
    stored counts, in storage that all machines share; without one a new folder below the
    checkpoint folder is begun.  ``fold_space``: the tokenizer ignores how much white space there
    is (documents that differ in nothing else then share a count).  A null text counts as empty.
    Repeated rows stay; null ids stay null.
    """
    spark, version = docs.sparkSession, version_of(tokenizer)
    cache = cache or f"{ensure_checkpoint_dir(spark)}/token-counts-{uuid.uuid4().hex}"
    begin(spark, cache)
    rows = inputs(docs, id_col, text_col)
    text = F.col("text")
    digest = F.unhex(F.sha2(folded(text, special_strings(tokenizer)) if fold_space else text, 256))
    keyed = materialize(rows.select("doc_id", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")))
    misses = (keyed.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
              .join(stored(spark, cache, version), "digest", "left_anti"))

    @arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts = tokens.from_file(tokenizer).counts
        for batch in batches:
            yield pa.array([n for part in slices(batch) for n in counts(part)], pa.int64())

    # the texts travel once, dealt by document id: one document of each missing digest
    encoded = (rows.withColumn("digest", digest)
               .join(misses.withColumnRenamed("digest", "wanted"),
                     F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("digest") == F.col("wanted")), "left_semi")
               .select("digest", F.lit(version).alias("version"), count.asNondeterministic()("text").alias("n_tokens")))
    encoded.write.mode("append").parquet(cache)
    # written, so that the join reads them as they are and a digest with very many rows can be split
    counts = materialize(stored(spark, cache, version))
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")
