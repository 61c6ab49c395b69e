"""Report-side aggregates and sorted exports.

All aggregates here run as partial (map-side) + final hash aggregates, so a
hot group value costs one row per input partition in the shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percent_1dp(part: Column, total: Column) -> Column:
    """``round(100 * part / total, 1)`` computed exactly in integers (half up)."""
    num = part.cast("bigint") * 2000 + total.cast("bigint")
    den = total.cast("bigint") * 2
    return F.when(total == 0, F.lit(0.0)).otherwise(
        (F.floor(num / den)).cast("double") / 10)


def kind_distribution(df: DataFrame, kind_col: str) -> DataFrame:
    """Count and percent per kind, ranked by count desc (then kind)."""
    g = df.groupBy(F.col(kind_col).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    # one row per kind: the grand-total window runs on a handful of rows
    w_all = Window.partitionBy()
    g = g.withColumn("total", F.sum("n").over(w_all))
    w = Window.orderBy(F.col("n").desc(), F.col("kind"))
    return g.select(
        "kind", "n", percent_1dp(F.col("n"), F.col("total")).alias("pct"),
        F.row_number().over(w).cast("bigint").alias("rank"))


def coverage(df: DataFrame, value_col: str) -> DataFrame:
    """Total rows, non-null ``value_col`` rows and their percentage."""
    c = df.agg(F.count(F.lit(1)).alias("total"), F.count(value_col).alias("resolved"))
    return c.select("total", "resolved",
                    percent_1dp(F.col("resolved"), F.col("total")).alias("pct"))


def running_total(df: DataFrame, ts: str, unit: str = "day") -> DataFrame:
    """Count per ``unit`` and its running total.

    Rows are aggregated per period first (partial + final), and the running
    sum is a window over the small per-period result only.
    """
    # a day is a DATE (no session time zone involved); other units truncate
    period = F.to_date(F.col(ts)) if unit == "day" else F.date_trunc(unit, F.col(ts))
    g = df.groupBy(period.alias("period")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return g.select("period", "n", F.sum("n").over(w).alias("running_total"),
                    F.row_number().over(Window.orderBy("period")).cast("bigint").alias("ordinal"))


def is_expected_error(err: Column) -> Column:
    """Errors that do not fail a run: skipped items and missing sources."""
    return err.startswith("skipped") | err.startswith("status 404")


def download_outcome(is_dod: Column, status: Column, size: Column, exception: Column,
                     min_bytes: int = 1024) -> Column:
    """Error of one download, NULL when the file was saved (B10): DoD rows are
    skipped, then an exception (``Type: message``), a status other than 200 and
    a body under ``min_bytes`` count as errors, in that order."""
    return (F.when(is_dod, F.lit("skipped: DoD"))
            .when(exception.isNotNull(), exception)
            .when(status != 200, F.concat(F.lit("status "), status.cast("string")))
            .when(size < min_bytes, F.concat(F.lit("too small ("), size.cast("string"), F.lit(" bytes)"))))


def fetch_outcome(status: Column, content_type: Column, exception: Column) -> Column:
    """Error of one page fetch, NULL for an HTML page with status 200."""
    return (F.when(exception.isNotNull(), exception)
            .when(status != 200, F.concat(F.lit("HTTP "), status.cast("string")))
            .when(~F.coalesce(content_type, F.lit("")).contains("text/html"),
                  F.concat(F.lit("not html: "), F.coalesce(content_type, F.lit("")))))


def run_summary(records: DataFrame, by: list[str], ts: str = "ts") -> DataFrame:
    """Per run: stamps, duration, counts and the failure flag.

    ``records``: one row per candidate with ``saved_path`` and ``error``.
    failed = error and no saved path; real failure = an unexpected error.
    """
    fmt = "yyyyMMdd'T'HHmmss'Z'"
    err = F.col("error")
    g = records.groupBy(*by).agg(
        F.min(ts).alias("_start"), F.max(ts).alias("_end"),
        F.count(F.lit(1)).alias("new_pdfs_count"),
        F.count_if(F.col("saved_path").isNotNull()).alias("downloaded_count"),
        F.count_if(err.isNotNull() & F.col("saved_path").isNull()).alias("failed_count"),
        F.coalesce(F.bool_or(err.isNotNull() & ~is_expected_error(err)), F.lit(False))
        .alias("has_real_failure"))
    micros = F.expr("timestampdiff(MICROSECOND, _start, _end)")
    return g.select(
        *by, F.date_format("_start", fmt).alias("started_utc"),
        F.date_format("_end", fmt).alias("finished_utc"),
        (F.floor((micros + 50000) / 100000).cast("double") / 10).alias("duration_sec"),
        "new_pdfs_count", "downloaded_count", "failed_count", "has_real_failure")


def discovery_counts(found: DataFrame) -> DataFrame:
    """One row of counts over the links of a run (D5): ``found`` has one row per link
    with ``new`` (NULL if its file had landed before), ``saved_path`` and ``error``."""
    err = F.col("error")
    return found.agg(
        F.count(F.lit(1)).alias("total_pdfs_on_guide"), F.count("new").alias("new_pdfs_count"),
        F.count("saved_path").alias("downloaded_count"),
        F.count_if(err.isNotNull() & F.col("saved_path").isNull()).alias("failed_count"),
        F.coalesce(F.bool_or(err.isNotNull() & ~is_expected_error(err)), F.lit(False)).alias("has_real_failure"))


def column_widths(df: DataFrame, caps: dict[str, int], floor: int = 10, pad: int = 2) -> DataFrame:
    """Display width per column: ``max(floor, max(min(len(str(v)), cap))) + pad``
    over the header and every non-null value, in one aggregate pass (D8)."""
    aggs = [F.max(F.least(F.length(F.col(c).cast("string")), F.lit(cap))).alias(c)
            for c, cap in caps.items()]
    m = df.agg(*aggs)
    rows = [F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column"),
                     (F.greatest(F.lit(floor), F.lit(min(len(c), cap)),
                                 F.coalesce(F.col(c), F.lit(0))) + pad).cast("bigint").alias("width"))
            for i, (c, cap) in enumerate(caps.items())]
    return m.select(F.inline(F.array(*rows)))


def global_rank(df: DataFrame, order: list[Column], key: list[str], name: str = "rank") -> DataFrame:
    """1-based position of every row in ``order``; ``key`` columns identify a row.

    Only the keys and the ordering columns are sorted: they are range-partitioned,
    sorted and written once (so partition numbers are stable), and a row's rank is
    its partition's offset plus its place in the partition.  The offsets are
    one row per partition, so their running sum is small and they are broadcast.
    The ranks are then joined back to the rows by key.  ``df`` is computed once and written: what the
    sort samples and sorts are two or three columns of that table.
    """
    from ..session import materialize, written

    df = written(df, "ranked")
    keys = materialize(df.orderBy(*order).select(*key, F.spark_partition_id().alias("_pid"),
                                                 F.monotonically_increasing_id().alias("_mid")))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keys.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).select(
        "_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    place = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    ranks = keys.join(F.broadcast(offsets), "_pid").select(
        *key, (F.col("_off") + place + 1).cast("bigint").alias(name))
    return df.join(ranks, key).select(*df.columns, name)


def sorted_report(df: DataFrame, columns: list[tuple[str, str]], order: list[Column],
                  key: list[str]) -> DataFrame:
    """Report projection with renamed headers and its 1-based sort rank
    (A11, B14, F1, F2)."""
    ranked = global_rank(df, order, key)
    return ranked.select(*[F.col(src).alias(dst) for src, dst in columns], "rank")


def preview(df: DataFrame, group: str, name: str, n: int = 5) -> DataFrame:
    """Per group: its size, the first ``n`` names in sorted order and how many
    more there are ("... and N more", F4).

    Only the first ``n`` names per group are kept (row_number limit, applied
    per map partition before the shuffle), so a large group never gathers in
    one task; the size comes from a separate partial + final count.
    """
    w = Window.partitionBy(group).orderBy(name)
    first = (df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
             .groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_rn", name))).alias("_f")))
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    j = sizes.join(first, group)
    return j.select(group, "n",
                    F.array_join(F.transform("_f", lambda x: x[name]), ", ").alias("first_names"),
                    F.greatest(F.col("n") - n, F.lit(0)).alias("more"))
