"""Incremental (streaming) queries: a file-source stream over the landed files of a
table writes the change rows of each micro-batch, and the state that they add up to
must equal the one-shot batch result."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields
from ..functions.urls import safe_filename
from ..functions.dates import with_normalized_date
from ..operators import extract as X
from ..operators import links as L
from ..operators import manifest as M
from ..operators import report as R
from ..session import table
from ..streaming import incremental as INC
from . import sqlfrag as S
from .dates import NORMALIZED_SQL
from .extract import DOC_TEXT_SQL, synth_doc_text
from .links import DOC_LINK_RE, MANIFEST_SQL, WRITTEN_EXPR
from .registry import query


def extract_batch(docs: DataFrame, model: DataFrame | None = None) -> DataFrame:
    """Extraction of one batch of documents (J2 + J3): regex fields, model
    title/scope when a model answer table is given (left join on the URL;
    without one it degrades to regex-only with the file-name title), row id
    and the normalised date."""
    d = synth_doc_text(docs).withColumn("agency", fields.agency_label("filename"))
    m = X.merge_fields(d.select("pdf_url", "agency", "filename", "text", "doc_id"), model,
                       take_model_date=False, carry=("doc_id",), title_fallback_when_blank=True,
                       drop_dod=False)
    out = m.drop("filename") if model is not None else m.drop("scope", "filename")
    return with_normalized_date(out)


def extract_batch_with(model: DataFrame | None):
    """``extract_batch`` bound to an (optional) model answer table."""
    return lambda docs: extract_batch(docs, model)


# A second version of the French documents arrives later, with another date
_LATER = "Effective Date: December 24, 2026 "
VERSIONS_SQL = f"""
SELECT *, 1 AS version FROM ({DOC_TEXT_SQL})
UNION ALL SELECT * REPLACE ('{_LATER}' || text AS text), 2 FROM ({DOC_TEXT_SQL}) WHERE lang = 'fr'
"""


def land_versions(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Both versions of the documents as landed files, by language."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    later = docs.where("lang = 'fr'").withColumn("text", F.concat(F.lit(_LATER), F.col("text"))).withColumn("version", F.lit(2))
    docs.withColumn("version", F.lit(1)).unionByName(later).write.partitionBy("version", "lang").parquet(folder)


def extract_versions(docs: DataFrame) -> DataFrame:
    """``extract_batch`` with the version of each row."""
    d = synth_doc_text(docs, "version").withColumn("agency", fields.agency_label("filename"))
    m = X.merge_fields(d.select("pdf_url", "agency", "filename", "text", "doc_id", "version"), None, take_model_date=False,
                       carry=("doc_id", "version"), title_fallback_when_blank=True, drop_dod=False)
    return with_normalized_date(m.drop("scope", "filename"))


EXTRACT_SQL = f"""
SELECT id, agency, deviation_number, title, effective_date, link FROM (
  SELECT {S.agency_label('filename')} || '|' || coalesce(nullif(rx_num, ''), nullif(filename, ''), 'None') AS id,
         {S.agency_label('filename')} AS agency, rx_num AS deviation_number,
         replace(replace(filename, '.pdf', ''), '_', ' ') AS title, rx_date AS effective_date,
         pdf_url AS link, doc_id, version
  FROM (SELECT *, {S.first_match('text', fields.EFFECTIVE_PATTERNS)} AS rx_date,
               {S.first_match('text', fields.DEVIATION_NUM_PATTERNS, 'filename')} AS rx_num
        FROM ({VERSIONS_SQL}) WHERE length(text) >= 200)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC, doc_id DESC) = 1
)
"""


def run_extraction(spark: SparkSession, landing: str, root: str, ckpt: str):
    """The extraction stream over what has landed, a third of the files in a batch."""
    landed = spark.read.parquet(landing)
    return INC.run_keyed(spark, landing, landed.schema, extract_versions, ["id"], ["version", "doc_id"], root, ckpt,
                         max(1, -(-len(landed.inputFiles()) // 3)), {"written": F.count(F.lit(1))})


@query("incremental_extract", NORMALIZED_SQL.format(raw=EXTRACT_SQL))
def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviations of documents that arrive over three batches or more, some in a later version."""
    landing, root, ckpt = (INC.scratch(spark, n) for n in ("landed", "deviations", "stream"))
    land_versions(spark, sf_dir, landing)
    run_extraction(spark, landing, root, ckpt)
    return INC.read_keyed(spark, root, ["id"]).drop("doc_id", "version")


def page_documents(pages: DataFrame, first: bool = True) -> DataFrame:
    """Document links of landed pages, written in the ways of the manifest query."""
    links = L.extract_links(pages, keep=("url",)).withColumn("href", F.expr(WRITTEN_EXPR))
    return L.document_links(links, F.col("url"), pattern=DOC_LINK_RE, first=first)


def _download_results(urls_: DataFrame) -> DataFrame:
    """Stand-in for the fetches of one run: status, size and exception by the URL's length."""
    n = F.length("pdf_url")
    return urls_.select(
        "pdf_url", F.when(n % 5 == 0, F.lit(404)).otherwise(F.lit(200)).alias("status"),
        F.when(n % 7 == 0, F.lit(100)).otherwise(F.lit(5000)).alias("size"),
        F.when(n % 11 == 0, F.lit("ConnectError: reset")).alias("exception"))


DISCOVER_SQL = f"""
WITH m AS (SELECT DISTINCT pdf_url, agency, filename, is_dod, part_numbers FROM ({MANIFEST_SQL})),
landed AS (
  SELECT DISTINCT {S.safe_filename('pdf_url')} AS name FROM ({MANIFEST_SQL}) WHERE page_id % 3 = 0
), o AS (
  SELECT *, CASE WHEN is_dod THEN 'skipped: DoD' WHEN length(pdf_url) % 11 = 0 THEN 'ConnectError: reset'
                 WHEN length(pdf_url) % 5 = 0 THEN 'status 404' WHEN length(pdf_url) % 7 = 0 THEN 'too small (100 bytes)' END AS error
  FROM m WHERE {S.safe_filename('pdf_url')} NOT IN (SELECT name FROM landed)
)
SELECT pdf_url, agency, filename, is_dod, part_numbers, error,
       CASE WHEN error IS NULL THEN 'pdfs/' || {S.safe_filename('pdf_url')} END AS saved_path
FROM o
"""


RECORD = ("pdf_url", "agency", "filename", "is_dod", "part_numbers", "landed", "error", "saved_path")


def discovered() -> dict[str, F.Column]:
    """The counts of a run's manifest, as aggregates over its records."""
    return {"total_pdfs_on_guide": F.count(F.lit(1)), "new_pdfs_count": F.count_if(~F.col("landed")), "downloaded_count": F.count("saved_path"),
            "failed_count": F.count_if(F.col("error").isNotNull() & F.col("saved_path").isNull())}


def run_discovery(spark: SparkSession, sf_dir: str, root: str, ckpt: str):
    """The discovery stream over the landed pages (J1): every link once, whether its file has landed, and else the outcome of
    its download (files linked from every third page have landed).  Returns the run's counts."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    landed = (page_documents(pages.where(F.col("page_id") % 3 == 0))
              .select(safe_filename(F.col("pdf_url")).alias("name"), F.lit(5000).alias("length")))

    def records(found: DataFrame) -> DataFrame:
        flagged = M.mark_landed(found, [landed])
        tried = M.attach_results(flagged, _download_results(flagged.where(~F.col("landed")).select("pdf_url")))
        outcome = {c: F.when(~F.col("landed"), F.col(c)).alias(c) for c in ("error", "saved_path")}
        return tried.select(*[outcome.get(c, F.col(c)) for c in RECORD])

    # a glob, because a table may be one file or a folder of files
    return INC.run_distinct(spark, f"{sf_dir}/pages.parque[t]", pages.schema, lambda p: page_documents(p, first=False).drop("page_id", "pos"),
                            ["pdf_url"], records, root, ckpt, metrics=discovered())


@query("incremental_discover", DISCOVER_SQL)
def incremental_discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run's records (J1): links whose file has not landed yet, with the outcome of their download."""
    root, ckpt = INC.scratch(spark, "manifest"), INC.scratch(spark, "stream")
    run_discovery(spark, sf_dir, root, ckpt)
    return spark.read.parquet(root).where(~F.col("landed")).select(*[c for c in RECORD if c != "landed"])


@query("discover_summary", f"""
WITH a AS (SELECT DISTINCT pdf_url FROM ({MANIFEST_SQL})), r AS ({DISCOVER_SQL})
SELECT count(*) AS total_pdfs_on_guide, count(r.pdf_url) AS new_pdfs_count, count(saved_path) AS downloaded_count,
  count(*) FILTER (WHERE error IS NOT NULL AND saved_path IS NULL) AS failed_count,
  coalesce(bool_or(error IS NOT NULL AND NOT (starts_with(error, 'skipped') OR starts_with(error, 'status 404'))), false) AS has_real_failure
FROM a LEFT JOIN r ON a.pdf_url = r.pdf_url
""")
def discover_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of one run's manifest (D5): links found, new ones, saved, failed."""
    root, ckpt = INC.scratch(spark, "manifest"), INC.scratch(spark, "stream")
    run_discovery(spark, sf_dir, root, ckpt)
    records = spark.read.parquet(root).withColumn("new", F.when(~F.col("landed"), True))
    return R.discovery_counts(records)


def pull_run(spark: SparkSession, sf_dir: str, folders: dict[str, str]) -> list[tuple[str, bool, int]]:
    """One scheduled run (J3): discovery, extraction only if something was downloaded, dates of what is there then.

    (step, whether it started, its count) of the three steps.  ``folders``: the landed documents, and where the streams write
    and keep their progress; a later run goes on from them."""
    pulled = run_discovery(spark, sf_dir, folders["manifest"], folders["manifest_progress"])
    INC.begin(extract_versions(spark.read.parquet(folders["landing"])), folders["deviations"])
    extracted = INC.gated(pulled, "downloaded_count", lambda: run_extraction(
        spark, folders["landing"], folders["deviations"], folders["deviations_progress"]))
    rows = INC.read_keyed(spark, folders["deviations"], ["id"]).agg(F.count(F.lit(1)), F.count("effective_date_iso")).first()
    return [("pull", True, pulled["downloaded_count"]), ("extract", extracted is not None, 0 if extracted is None else rows[0]),
            ("normalize", True, rows[1])]


@query("pull_gate", f"""
WITH d AS ({DISCOVER_SQL}), n AS ({NORMALIZED_SQL.format(raw=EXTRACT_SQL)})
SELECT 1 AS run, 'pull' AS step, true AS started, (SELECT count(saved_path) FROM d) AS n
UNION ALL SELECT 1, 'extract', true, (SELECT count(*) FROM n)
UNION ALL SELECT unnest([1, 2]), 'normalize', true, (SELECT count(effective_date_iso) FROM n)
UNION ALL SELECT 2, 'pull', true, 0 UNION ALL SELECT 2, 'extract', false, 0
""")
def pull_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scheduled runs (J3, D10): the second finds nothing new, so its extraction does not start."""
    names = ("landing", "manifest", "manifest_progress", "deviations", "deviations_progress")
    folders = {n: INC.scratch(spark, n) for n in names}
    land_versions(spark, sf_dir, folders["landing"])
    rows = [(run, *r) for run in (1, 2) for r in pull_run(spark, sf_dir, folders)]
    return spark.createDataFrame(rows, "run int, step string, started boolean, n long")
