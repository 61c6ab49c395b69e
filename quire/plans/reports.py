"""Report queries: running totals, run summaries, width profile, work queue
and the two sorted exports."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import report as R
from ..operators import sections as SEC
from ..session import table
from ..sources import files
from ..streaming.incremental import scratch
from .dates import DATE_NORMALIZE_SQL, normalized_orders
from .registry import query
from .sections import _fields_sql, _sections_sql, clause_docs


@query("running_total", """
WITH g AS (SELECT CAST(ts AS DATE) AS period, count(*) AS n FROM events GROUP BY 1)
SELECT period, n, CAST(sum(n) OVER (ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_total,
       row_number() OVER (ORDER BY period) AS ordinal
FROM g
""")
def running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events", "ts")
    return R.running_total(e, "ts")


def run_records(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Download outcomes per event: saved, failed (404 / real error) or skipped."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value")
    t = F.col("event_type")
    saved = F.when(t.isin("view", "click", "purchase"),
                   F.concat(F.lit("pdfs/"), F.col("event_id").cast("string")))
    err = (F.when(t == "error", F.when(F.col("value") > 50, F.lit("ConnectError: timeout"))
                  .otherwise(F.lit("status 404")))
           .when(t == "signup", F.lit("skipped: DoD")))
    return e.select(*keep, F.to_date("ts").alias("run_day"), "ts", saved.alias("saved_path"), err.alias("error"))


@query("run_summary", """
WITH r AS (
  SELECT CAST(ts AS DATE) AS run_day, ts,
    CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'pdfs/' || CAST(event_id AS VARCHAR) END AS saved_path,
    CASE WHEN event_type = 'error' THEN CASE WHEN value > 50 THEN 'ConnectError: timeout' ELSE 'status 404' END
         WHEN event_type = 'signup' THEN 'skipped: DoD' END AS error
  FROM events
), g AS (
  SELECT run_day, min(ts) AS s, max(ts) AS f, count(*) AS new_pdfs_count,
    count(*) FILTER (WHERE saved_path IS NOT NULL) AS downloaded_count,
    count(*) FILTER (WHERE error IS NOT NULL AND saved_path IS NULL) AS failed_count,
    coalesce(bool_or(error IS NOT NULL AND NOT (starts_with(error, 'skipped') OR starts_with(error, 'status 404'))), false) AS has_real_failure
  FROM r GROUP BY run_day
)
SELECT 'run-' || strftime(run_day, '%Y%m%d') AS run_id, run_day,
  strftime(s, '%Y%m%dT%H%M%SZ') AS started_utc, strftime(f, '%Y%m%dT%H%M%SZ') AS finished_utc,
  CAST((epoch_us(f) - epoch_us(s) + 50000) // 100000 AS DOUBLE) / 10 AS duration_sec,
  new_pdfs_count, downloaded_count, failed_count, has_real_failure
FROM g
""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = R.run_summary(run_records(spark, sf_dir), ["run_day"])
    # run id is a parameterised stamp, not random, so reruns repeat
    return s.withColumn("run_id", F.concat(F.lit("run-"), F.date_format("run_day", "yyyyMMdd")))


@query("run_manifest_files", """
SELECT 'run-' || strftime(CAST(ts AS DATE), '%Y%m%d') AS started_utc, 'u' || CAST(event_id AS VARCHAR) AS pdf_url,
  CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'pdfs/' || CAST(event_id AS VARCHAR) END AS saved_path,
  CASE WHEN event_type = 'error' THEN CASE WHEN value > 50 THEN 'ConnectError: timeout' ELSE 'status 404' END
       WHEN event_type = 'signup' THEN 'skipped: DoD' END AS error
FROM events
""")
def run_manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run manifests written as a document per run beside the records by run, and the records read back."""
    runs, records = _written_runs(spark, sf_dir)
    return records.join(runs.select("run_id"), "run_id").select(F.col("run_id").alias("started_utc"), "pdf_url", "saved_path", "error")


def _written_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A run a day of events, written and read: runs and records."""
    run = F.concat(F.lit("run-"), F.date_format("run_day", "yyyyMMdd"))
    r = run_records(spark, sf_dir, "event_id").withColumn("run_id", run)
    records = r.select("run_id", F.concat(F.lit("u"), F.col("event_id").cast("string")).alias("pdf_url"),
                       F.lit("f").alias("filename"), F.lit("a").alias("agency"), F.lit(False).alias("is_dod"),
                       F.array(F.lit(1)).alias("part_numbers"), "saved_path", "error")
    summary = R.run_summary(r, ["run_id"]).drop("has_real_failure").withColumn("guide_url", F.lit("https://docs.example.org/guide"))
    path = scratch(spark, "run-manifests")
    files.write_runs(summary, records, path)
    return files.read_runs(spark, path), files.read_records(spark, path)


@query("latest_run", """
WITH e AS (
  SELECT CAST(ts AS DATE) AS day, ts, event_id, event_type,
    CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'pdfs/' || CAST(event_id AS VARCHAR) END AS saved_path FROM events
), l AS (SELECT max(day) AS day FROM e)
SELECT 'run-' || strftime(day, '%Y%m%d') AS run_id, strftime(min(ts) OVER (), '%Y%m%dT%H%M%SZ') AS started_utc,
  CAST(count(*) OVER () AS INTEGER) AS new_pdfs_count, CAST(count(saved_path) OVER () AS INTEGER) AS downloaded_count, 'u' || CAST(event_id AS VARCHAR) AS pdf_url, saved_path
FROM e JOIN l USING (day)
""")
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest run with new files and its records (the "latest" pointer, A10)."""
    runs, records = _written_runs(spark, sf_dir)
    newest = files.latest_run(runs)
    return records.join(newest, "run_id").select("run_id", "started_utc", "new_pdfs_count", "downloaded_count", "pdf_url", "saved_path")


WIDTH_CAPS = {"c_custkey": 16, "c_name": 60, "c_nationkey": 12, "c_acctbal": 14, "c_mktsegment": 18}


@query("column_width_profile", " UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS column, "
    f"greatest(10, {min(len(c), cap)}, coalesce(max(least(length(CAST({c} AS VARCHAR)), {cap})), 0)) + 2 AS width "
    f"FROM customer" for i, (c, cap) in enumerate(WIDTH_CAPS.items())))
def column_width_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer", *WIDTH_CAPS)
    return R.column_widths(c, WIDTH_CAPS)


@query("work_queue", """
SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) AS rank
FROM documents
WHERE text LIKE '%an%the%' AND doc_id NOT IN (SELECT doc_id FROM labels)
ORDER BY doc_id LIMIT 50
""")
def work_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next 50 documents needing enrichment: pattern on the whole text and no
    label yet (the limit is the feature: a batch of work)."""
    from pyspark.sql import Window

    d = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    lab = table(spark, sf_dir, "labels", "doc_id")
    q = d.where(F.like("text", F.lit("%an%the%"))).join(lab, "doc_id", "left_anti")
    top = q.orderBy("doc_id").limit(50).select("doc_id", "source")
    return top.withColumn("rank", F.row_number().over(Window.orderBy("doc_id")).cast("bigint"))


SCRAPED_AT = "2026-01-31 06:30:00"
DEV_COLUMNS = [("agency", "Agency"), ("deviation_number", "Deviation #"), ("title", "Title"),
               ("effective_date", "Effective Date (raw)"),
               ("effective_date_iso", "Effective Date (ISO)"),
               ("effective_date_kind", "Date Kind"), ("scope", "Scope"), ("link", "Link"),
               ("scraped_at", "Scraped At")]
EXCLUDED_AGENCIES = ("DoD", "DOD", "Department of Defense")


def deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = normalized_orders(spark, sf_dir, extra=("o_orderpriority",))
    pr = F.col("o_orderpriority")
    agency = (F.when(pr.startswith("1"), F.lit("DoD")).when(pr.startswith("5"), F.lit(None))
              .otherwise(F.substring(pr, 3, 100)))
    return n.select(
        agency.alias("agency"), F.concat(F.lit("D-"), F.col("o_orderkey").cast("string"))
        .alias("deviation_number"), F.concat(F.lit("Deviation "), F.col("o_orderkey").cast("string")).alias("title"),
        "effective_date", "effective_date_iso", "effective_date_kind",
        F.when(F.col("o_orderkey") % 2 == 0, pr).alias("scope"),
        F.concat(F.lit("https://docs.example.org/"), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("link"),
        F.lit(SCRAPED_AT).cast("timestamp_ntz").alias("scraped_at"))


@query("export_deviations", f"""
WITH n AS ({DATE_NORMALIZE_SQL}),
d AS (
  SELECT CASE WHEN starts_with(o.o_orderpriority, '1') THEN 'DoD' WHEN starts_with(o.o_orderpriority, '5') THEN NULL
              ELSE substr(o.o_orderpriority, 3, 100) END AS agency,
         'D-' || CAST(n.o_orderkey AS VARCHAR) AS deviation_number,
         'Deviation ' || CAST(n.o_orderkey AS VARCHAR) AS title,
         n.effective_date, n.effective_date_iso, n.effective_date_kind,
         CASE WHEN n.o_orderkey % 2 = 0 THEN o.o_orderpriority END AS scope,
         'https://docs.example.org/' || CAST(n.o_orderkey AS VARCHAR) || '.pdf' AS link
  FROM n JOIN orders o USING (o_orderkey)
)
SELECT agency AS "Agency", deviation_number AS "Deviation #", title AS "Title", effective_date AS "Effective Date (raw)",
       effective_date_iso AS "Effective Date (ISO)", effective_date_kind AS "Date Kind",
       scope AS "Scope", link AS "Link", TIMESTAMP '{SCRAPED_AT}' AS "Scraped At",
       row_number() OVER (ORDER BY effective_date_iso DESC NULLS LAST, agency, deviation_number) AS rank
FROM d WHERE agency NOT IN ('DoD', 'DOD', 'Department of Defense')
""")
def export_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = deviations(spark, sf_dir).where(~F.col("agency").isin(*EXCLUDED_AGENCIES))
    return R.sorted_report(d, DEV_COLUMNS, [F.col("effective_date_iso").desc_nulls_last(),
                                            F.col("agency"), F.col("deviation_number")],
                           ["deviation_number"])


CLAUSE_COLUMNS = [("number", "Number"), ("title", "Title"), ("kind", "Type"),
                  ("effective_date", "Effective Date"), ("full_text", "Full Text"),
                  ("doc_id", "Source"), ("source_url", "Source URL"), ("scraped_at", "Scraped At")]


@query("export_clauses", f"""
SELECT number AS "Number", title AS "Title", kind AS "Type", effective_date AS "Effective Date",
       full_text AS "Full Text", doc_id AS "Source",
       'https://docs.example.org/' || CAST(doc_id AS VARCHAR) AS "Source URL", TIMESTAMP '{SCRAPED_AT}' AS "Scraped At",
       row_number() OVER (ORDER BY number, doc_id) AS rank
FROM ({_fields_sql(_sections_sql(True))})
""")
def export_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = SEC.clause_fields(SEC.segment(clause_docs(spark, sf_dir), keep=("doc_id",), first_only=True))
    c = c.withColumns({"source_url": F.concat(F.lit("https://docs.example.org/"), F.col("doc_id").cast("string")),
                       "scraped_at": F.lit(SCRAPED_AT).cast("timestamp_ntz")})
    return R.sorted_report(c, CLAUSE_COLUMNS, [F.col("number"), F.col("doc_id")], ["number", "doc_id"])
