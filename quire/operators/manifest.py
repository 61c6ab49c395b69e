"""Manifest operators: worklists, reconciliation with landed files, rebuilds
(A3, A5, A9, A12, B1, B5, C3, C4, C6, C7, D3, D4, D7, F3, G3, G4).

Joins here are equi-joins on a file key; the planner broadcasts a side only
when its statistics are under ``spark.sql.autoBroadcastJoinThreshold``, else
sort-merge (AQE can switch at runtime), so no size is assumed.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.text import first_truthy

MANIFEST_COLUMNS = ("pdf_url", "agency", "filename", "part_number", "is_dod")
CSV_HEADER = ("on_disk_filename", "url_hash", "original_filename", "agency",
              "part_number", "is_dod", "source_url", "pdf_size_bytes")


def manifest_rows(exploded: DataFrame) -> DataFrame:
    """Rows of the (pdf_url, part_number)-keyed manifest after a full refresh.

    All other columns derive from ``pdf_url``, so "insert or replace" on the
    key is a distinct (hash aggregate, partial per partition).
    """
    return exploded.select(*MANIFEST_COLUMNS).distinct()


def part_list(exploded: DataFrame, key: str, order: list[str], meta: list[str],
              part_col: str = "part_number") -> DataFrame:
    """Per ``key``: the first row's ``order`` + ``meta`` columns and the distinct
    sorted part numbers >= 0 joined by ';' (D4).

    Rows are first reduced to one per (key, part) in the map tasks (``min`` over a
    struct is a partial + final aggregate), then to one per key: what the second
    aggregate collects are a key's distinct part numbers.
    """
    first = F.min(F.struct(*[F.col(c) for c in order + meta])).alias("_first")
    pairs = exploded.groupBy(key, part_col).agg(first)
    parts = F.collect_list(F.when(F.col(part_col) >= 0, F.col(part_col))).alias("_parts")
    g = pairs.groupBy(key).agg(F.min("_first").alias("_first"), parts)
    return g.select(key, *[F.col(f"_first.{c}").alias(c) for c in order + meta],
                    F.array_join(F.array_sort("_parts"), ";").alias(part_col))


def profile(manifest: DataFrame, by: list[str], agency: str = "agency",
            dod: str = "is_dod") -> DataFrame:
    """Total, non-DoD count and sorted distinct non-DoD agencies (D3)."""
    return manifest.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col(dod)).alias("non_dod"),
        F.array_join(F.array_sort(F.collect_set(F.when(~F.col(dod), F.col(agency)))), ", ")
        .alias("agencies"))


def worklist(manifest: DataFrame, only_part: int | None = None) -> DataFrame:
    """Distinct (pdf_url, agency, filename) of non-DoD rows, optionally for one
    part (B1, B5, D7); the flag filter is pushed into the scan."""
    m = manifest.where(~F.col("is_dod"))
    if only_part:
        m = m.where(F.col("part_number") == only_part)
    return m.select("pdf_url", "agency", "filename").distinct()


def landed(listings: list[DataFrame], min_bytes: int = 1024) -> DataFrame:
    """Union of directory listings ``(name, length)`` keeping files larger
    than ``min_bytes`` (G3 + size test of C3)."""
    u = listings[0]
    for more in listings[1:]:
        u = u.unionByName(more)
    return u.where(F.col("length") > min_bytes).select("name").distinct()


def not_yet_landed(manifest: DataFrame, listings: list[DataFrame],
                   min_bytes: int = 1024) -> DataFrame:
    """Manifest URLs whose safe file name is not landed in any listing."""
    m = manifest.withColumn("name", urls.safe_filename(F.col("pdf_url")))
    return m.join(landed(listings, min_bytes), "name", "left_anti")


def mark_landed(manifest: DataFrame, listings: list[DataFrame], min_bytes: int = 1024) -> DataFrame:
    """Manifest rows with ``landed``: whether the URL's safe file name is in any listing."""
    m = manifest.withColumn("name", urls.safe_filename(F.col("pdf_url")))
    there = landed(listings, min_bytes).withColumn("landed", F.lit(True))
    return m.join(there, "name", "left").withColumn("landed", F.coalesce("landed", F.lit(False))).drop("name")


def missing_originals(work: DataFrame, listing: DataFrame) -> DataFrame:
    """Work rows whose original file name (hash prefix stripped from the listed
    names) is absent; no size test (C4)."""
    orig = listing.select(urls.original_from_safe(F.col("name")).alias("filename")) \
        .where(F.col("filename").isNotNull()).distinct()
    return work.join(orig, "filename", "left_anti")


def sync_report(manifest: DataFrame, listing: DataFrame, key: str = "on_disk_filename",
                name: str = "name") -> DataFrame:
    """Two-way reconcile in one full outer join (C6, G4): status is 'kept'
    (in both), 'removed' (manifest only) or 'missing' (disk only)."""
    m = manifest.select(F.col(key).alias("_k"), F.lit(True).alias("_in_m")).distinct()
    d = listing.select(F.col(name).alias("_k"), F.lit(True).alias("_in_d")).distinct()
    j = m.join(d, "_k", "full_outer")
    status = (F.when(F.col("_in_m") & F.col("_in_d"), F.lit("kept"))
              .when(F.col("_in_m"), F.lit("removed")).otherwise(F.lit("missing")))
    return j.select(F.col("_k").alias(key), status.alias("status"))


def last_rows(existing: DataFrame) -> DataFrame:
    """Manifest CSV rows, the last per file name by ``line`` where there is one."""
    order = "line" if "line" in existing.columns else F.struct(*CSV_HEADER[1:])
    row = F.struct(*CSV_HEADER[1:])
    last = existing.groupBy("on_disk_filename").agg(F.max_by(row, order).alias("r"))
    return last.select("on_disk_filename", "r.*")


def kept_rows(existing: DataFrame, listing: DataFrame, name: str = "name") -> DataFrame:
    """The manifest rows that a sync writes back (C6): those whose file is on disk,
    all columns, one row per file name."""
    on_disk = listing.select(F.col(name).alias("on_disk_filename")).distinct()
    return last_rows(existing).join(on_disk, "on_disk_filename", "left_semi")


def rebuild(listing: DataFrame, existing: DataFrame, db_meta: DataFrame) -> DataFrame:
    """Manifest rows for every listed file with per-column precedence
    existing CSV row > DB metadata > derived from the name > default (C7).

    ``listing``: name, length; a name listed twice counts once (the larger size).
    ``existing``: CSV_HEADER columns (strings) and optionally ``line``, the place
    of the row in the file: of rows with one name the last counts.
    ``db_meta``: on_disk_filename, url_hash, original_filename, agency,
    part_numbers (';'-joined string), is_dod ('0'/'1'), source_url.
    """
    listing = listing.groupBy("name").agg(F.max("length").alias("length"))
    existing = last_rows(existing)
    e = existing.select(*[F.col(c).alias(f"e_{c}") for c in CSV_HEADER])
    d = db_meta.select(*[F.col(c).alias(f"d_{c}") for c in db_meta.columns])
    j = (listing.join(e, listing["name"] == e["e_on_disk_filename"], "left")
         .join(d, listing["name"] == d["d_on_disk_filename"], "left"))
    name = F.col("name")
    prefix = F.get(F.split(name, "_", 2), 0)
    rest = F.coalesce(F.get(F.split(name, "_", 2), 1), name)
    return j.select(
        name.alias("on_disk_filename"),
        # the name-derived value is the last resort even when it is ''
        F.coalesce(first_truthy("e_url_hash", "d_url_hash"), prefix).alias("url_hash"),
        F.coalesce(first_truthy("e_original_filename", "d_original_filename"), rest)
        .alias("original_filename"),
        F.coalesce(first_truthy("e_agency", "d_agency"), F.lit("")).alias("agency"),
        F.coalesce(first_truthy("e_part_number", "d_part_numbers"), F.lit("")).alias("part_number"),
        F.coalesce(first_truthy("e_is_dod", "d_is_dod"), F.lit("0")).alias("is_dod"),
        F.coalesce(first_truthy("e_source_url", "d_source_url"), F.lit("")).alias("source_url"),
        F.col("length").cast("string").alias("pdf_size_bytes"),
    )


def download_plan(records: DataFrame, order: list[str], cap: int | None) -> DataFrame:
    """What one run attempts (F4, B1, B10): the first ``cap`` records in
    discovery order are taken; DoD records among them are skipped (and use up
    the cap), the rest are downloads.  Records past the cap are 'deferred'.
    ``records`` needs ``is_dod`` and the ``order`` columns, which identify a record."""
    from ..operators.report import global_rank

    r = global_rank(records, [F.col(c) for c in order], order, "ordinal")
    taken = F.lit(True) if cap is None else F.col("ordinal") <= cap
    action = (F.when(~taken, F.lit("deferred"))
              .when(F.col("is_dod"), F.lit("skipped: DoD"))
              .otherwise(F.lit("download")))
    return r.withColumn("action", action)


def attach_results(work: DataFrame, results: DataFrame, key: str = "pdf_url",
                   folder: str = "pdfs/") -> DataFrame:
    """Work rows with the error of their download, and the path of the saved file
    where there is none (J1, B10).  ``results``: key, status, size, exception."""
    from .report import download_outcome

    j = work.join(results, key, "left")
    error = download_outcome(F.col("is_dod"), F.col("status"), F.col("size"), F.col("exception"))
    return (j.withColumn("error", error).drop("status", "size", "exception")
            .withColumn("saved_path", F.when(F.col("error").isNull(),
                                             F.concat(F.lit(folder), urls.safe_filename(F.col(key))))))


def attach_outcomes(work: DataFrame, outcomes: DataFrame, key: str = "pdf_url") -> DataFrame:
    """Work rows with their download outcome (C2): a left join on the URL; a
    row without an outcome, or whose outcome has no saved path, is failed.
    ``outcomes``: key, saved_path, error (at most one row per key)."""
    o = outcomes.select(key, "saved_path", "error", F.lit(True).alias("_has"))
    j = work.join(o, key, "left")
    failed = F.col("_has").isNull() | F.col("saved_path").isNull()
    return j.withColumn("failed", failed).drop("_has")
