"""Incremental refresh with Structured Streaming.

New landed files (pages, document text) are picked up by a file-source
stream.  Each micro-batch runs the batch operators on its files and writes its
rows to a folder of its own, ``<root>/batch=<id>``.  A replayed batch overwrites
only that folder, with the same rows; what earlier batches wrote is never
read or replaced by a running one, so a failed commit loses nothing and readers
see no gaps.  The current state is the last row per key over all batches
(:func:`read_state`); :func:`compact` writes it to a new folder from time to time.

What a batch has to know of earlier ones is in Spark's state store, in the stream's checkpoint: the newest
row of each key (:func:`run_keyed`, update mode) or the keys seen so far (:func:`run_distinct`).  So a batch touches
and writes the keys of its own files only.  Counts of what the batches wrote come from an ``Observation`` of
each write; they decide whether a later step starts (:func:`gated`).
"""
from __future__ import annotations

import uuid

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from ..operators import store
from ..session import ensure_checkpoint_dir


def write_batch(rows: DataFrame, root: str, batch_id: int) -> None:
    """The change rows of one batch; writing it again replaces them."""
    rows.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")


def begin(empty: DataFrame, root: str) -> None:
    """The folder of a stream's batches with the schema of ``empty``, unless it is there: so it can be read before the first batch."""
    empty.limit(0).write.mode("ignore").parquet(f"{root}/batch=-1")


def run_available(spark: SparkSession, source_dir: str, schema: StructType,
                  process, root: str, checkpoint: str, files_per_batch: int | None = None) -> int:
    """Process every file not yet seen under ``source_dir`` and stop
    (``availableNow``); returns the number of micro-batches run."""
    return _run(_source(spark, source_dir, schema, files_per_batch), process, "append", root, checkpoint)["batches"]


def _source(spark: SparkSession, source_dir: str, schema: StructType, files_per_batch: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(source_dir)


def _run(stream: DataFrame, process, mode: str, root: str, checkpoint: str, metrics: dict[str, Column] | None = None) -> Counter:
    """Run the stream's batches through ``process`` into their folders; how many there were, and the sums of
    ``metrics`` (name to an aggregate that counts) over the rows that they wrote."""
    totals = Counter(batches=0, **{name: 0 for name in metrics or {}})

    def each(df: DataFrame, batch_id: int) -> None:
        rows = process(df)
        if metrics:
            seen = Observation()
            write_batch(rows.observe(seen, *[c.alias(name) for name, c in metrics.items()]), root, batch_id)
            totals.update(seen.get)
        else:
            write_batch(rows, root, batch_id)
        totals["batches"] += 1

    query = (stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return totals


def run_keyed(spark: SparkSession, source_dir: str, schema: StructType, process, keys: list[str], seq: list[str],
              root: str, checkpoint: str, files_per_batch: int | None = None, metrics: dict[str, Column] | None = None) -> Counter:
    """Keep the last row per key by ``seq`` over all files so far.

    ``process`` makes rows of a streaming DataFrame (column expressions, joins with tables).  The state store
    holds one row a key; a batch writes the rows, as they now are, of the keys that its files touch.
    Returns the number of batches and the sums of ``metrics`` over what they wrote.
    """
    newest = store.last_per_key(process(_source(spark, source_dir, schema, files_per_batch)), keys, seq)
    return _run(newest, lambda rows: rows, "update", root, checkpoint, metrics)


def read_keyed(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """The table that :func:`run_keyed` keeps: what the last batch to touch a key wrote of it."""
    return store.last_per_key(spark.read.parquet(root), keys, ["batch"]).drop("batch")


def run_distinct(spark: SparkSession, source_dir: str, schema: StructType, generate, keys: list[str], process,
                 root: str, checkpoint: str, files_per_batch: int | None = None, metrics: dict[str, Column] | None = None) -> Counter:
    """Process each key once, when the first file that names it arrives.

    ``generate`` makes rows of a streaming DataFrame; rows whose ``keys`` an earlier batch, or the same one, had are dropped by
    the state store; ``process`` makes what is written of a batch's new rows.  Rows of a key must not differ
    in what ``process`` reads.  Returns the number of batches and the sums of ``metrics`` over what they wrote.
    """
    new = generate(_source(spark, source_dir, schema, files_per_batch)).dropDuplicates(keys)
    return _run(new, process, "append", root, checkpoint, metrics)


def gated(counts: Counter, gate: str, step: Callable[[], Counter]) -> Counter | None:
    """The counts of ``step`` if ``counts[gate]`` is above zero; else None, and the step is not started."""
    return step() if counts[gate] > 0 else None


def read_state(spark: SparkSession, root: str, keys: list[str], seq: list[str]) -> DataFrame:
    """The last row per key, by ``seq``, over all batches written so far."""
    return store.last_per_key(spark.read.parquet(root).drop("batch"), keys, seq)


def compact(spark: SparkSession, root: str, target: str, keys: list[str], seq: list[str]) -> None:
    """The state as one batch in a new folder, from which later batches can go on."""
    write_batch(read_state(spark, root, keys, seq), target, 0)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/quire-{name}-{uuid.uuid4().hex[:12]}"
