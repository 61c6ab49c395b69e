"""What several of the text operators share: inputs, bounded memos, written intermediates."""
from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Rows that one Python step holds at a time; an Arrow batch is worked off in slices of it.
SLICE_ROWS = 512


def workers_find_package(spark: SparkSession) -> None:
    """Python workers on machines that share this folder import the package from it, whatever their
    working directory; elsewhere it has to be installed or shipped, as any library."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in (paths := known.get("PYTHONPATH", "").split(os.pathsep)):
        known["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the corpus, by any path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def inputs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           empty: bool = True) -> DataFrame:
    """(doc_id, text) alone, so that no other column of ``docs`` can clash with an operator's own.

    ``empty``: a null text becomes the empty text.
    """
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("doc_id"),
                       (F.coalesce(text, F.lit("")) if empty else text).alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has (upper or lower case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def slices(values: pa.Array, rows: int = SLICE_ROWS) -> Iterator[list]:
    """The values of an Arrow array as Python lists of at most ``rows``."""
    for at in range(0, len(values), rows):
        yield values.slice(at, rows).to_pylist()


#: Keys that hold more than this share of all rows count as hot; there are at most HOT_KEYS of them.
HOT_KEYS = 10_000


def lookup(rows: DataFrame, values: DataFrame, key: str, n: str, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``values`` by ``key``, which is unique in ``values``; ``how``: inner or left.

    Column ``n`` of ``values`` (not in the result) tells how many rows have the key.  Keys of more than one in HOT_KEYS
    of the rows are at most HOT_KEYS, whatever the input, so these are broadcast and their rows stay where
    they are; only the other rows are shuffled.  Both arguments should be written tables: they are read twice.
    """
    limit = max(rows.count() // HOT_KEYS, 1)
    hot, none = F.broadcast(values.filter(F.col(n) > limit).drop(n)), F.col(key).isNull()
    named = rows.filter(~none)
    rest = named.join(hot.select(key), key, "left_anti").join(values.filter(F.col(n) <= limit).drop(n), key, how)
    out = named.join(hot, key).select(rest.columns).unionAll(rest)
    if how == "left":  # rows without a key match nothing, however many they are
        out = out.unionAll(rows.filter(none).select([F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                                                     for f in rest.schema]))
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table below the checkpoint folder: read again by column, and by other tasks after a loss."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bits_of(values: DataFrame, column: str, size: int) -> bytes:
    """A filter of ``size`` bits (a power of two, 2^18 at least): the bit of the CRC-32 of each string in ``column`` is set.

    Its size is fixed whatever the table, so it may go to every task: a value whose bit is not set is not in
    the table.  The more values, the more others pass it.
    """
    place = F.crc32(F.col(column)) % size + 1
    rows = (values.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect())
    out = bytearray(size // 8)
    for r in rows:
        out[(r.bucket - 1) * len(r.bits):r.bucket * len(r.bits)] = r.bits
    return bytes(out)
