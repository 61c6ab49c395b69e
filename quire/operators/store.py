"""Keyed writes on plain parquet: upsert (last wins), insert-if-absent, keyed
column update, append and schema evolution (A12-A18, E3, J6).

Plain parquet has no MERGE, so every operator produces a DataFrame of the new
table state; which folder or table format keeps it is the caller's choice.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType



def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Row with the greatest ``order`` tuple per key (E3, "insert or replace").

    ``max(struct(order..., payload...))`` is a partial + final (map-side combined) aggregate:
    each map task keeps one row per key before the shuffle, so a key that holds
    a third of all rows costs one row per partition, not a one-task sort.
    """
    payload = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload])).alias("_b")
    g = df.groupBy(*keys).agg(best)
    cols = {c: F.col(f"_b.{c}") for c in order + payload}
    return g.select(*keys, *[cols[c].alias(c) for c in df.columns if c not in keys])


def upsert(current: DataFrame, new: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """New state after "INSERT OR REPLACE" of ``new`` into ``current``.

    Both sides carry ``seq`` (a write ordinal); the newest row per key wins.
    Columns missing on one side are added as NULL (A17).
    """
    u = current.unionByName(new, allowMissingColumns=True)
    return last_per_key(u, keys, seq)


def insert_if_absent(current: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """"INSERT OR IGNORE": rows of ``new`` whose key is absent are appended,
    existing rows are untouched (A14, A15, C5)."""
    fresh = new.join(current.select(*keys), keys, "left_anti")
    return current.unionByName(fresh, allowMissingColumns=True)


def absent_rows(current: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key ``current`` lacks: what an insert-if-absent appends."""
    return new.join(current.select(*keys), keys, "left_anti").select(*new.columns)


def append_table(rows: DataFrame, path: str) -> DataFrame:
    """Append rows to the table at ``path`` and read it."""
    rows.write.mode("append").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def refresh_table(rows: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` by ``rows``, which do not come from it, and read it."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def keyed_update(current: DataFrame, updates: DataFrame, keys: list[str],
                 set_cols: list[str]) -> DataFrame:
    """``UPDATE t SET cols = u.cols WHERE t.key = u.key`` (A16): matched rows
    take the update's values for ``set_cols``; others keep theirs.
    ``updates`` must hold at most one row per key."""
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in set_cols],
                       F.lit(True).alias("_hit"))
    j = current.join(u, keys, "left")
    out = []
    for c in current.columns:
        if c in set_cols:
            out.append(F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Add missing columns as typed NULLs and order columns like ``schema``
    (idempotent add-column-if-missing, A17)."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def stamp(df: DataFrame, col: str, as_of) -> DataFrame:
    """Column default ``now()`` made repeatable: the caller passes the time."""
    return df.withColumn(col, F.lit(as_of).cast("timestamp_ntz"))


def status_machine(fetch_error: Column, extracted: Column, keep: Column, score: Column,
                   threshold: float = 0.4) -> Column:
    """URL status after one crawl step (J6): failed / extract_failed /
    low_relevance / done."""
    return (F.when(fetch_error.isNotNull(), F.lit("failed"))
            .when(~extracted, F.lit("extract_failed"))
            .when(keep & (score >= threshold), F.lit("done"))
            .otherwise(F.lit("low_relevance")))
