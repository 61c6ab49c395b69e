"""Manifest reconciliation queries on ``documents`` + ``labels`` (stand-ins for
the PDF manifest and the landed-file listings), ``nation``/``supplier``
(pattern join) and ``events``/``customer`` (run-manifest candidates)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import urls
from ..operators import manifest as M
from ..session import table
from . import sqlfrag as S
from .extract import DOC_TEXT_SQL, doc_text, document_names, merge_sql, merged
from .registry import query


def doc_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest row per document: URL, agency (upper lang), file name,
    part number, DoD flag (German documents stand in for DoD)."""
    d = table(spark, sf_dir, "documents", "doc_id", "lang", "source", "n_chars")
    fname = F.concat(F.col("source"), F.lit("_"), F.col("lang"), F.lit("_doc_"),
                     F.col("doc_id").cast("string"), F.lit(".pdf"))
    return d.select(
        "doc_id", F.concat(F.lit("https://docs.example.org/"), F.col("source"), F.lit("/"), fname)
        .alias("pdf_url"),
        F.upper("lang").alias("agency"), fname.alias("filename"),
        (F.col("n_chars") % 53).cast("int").alias("part_number"),
        (F.col("lang") == "de").alias("is_dod"), "n_chars", "lang", "source")


DOC_MANIFEST_SQL = """
SELECT doc_id,
  'https://docs.example.org/' || source || '/' || source || '_' || lang || '_doc_' || CAST(doc_id AS VARCHAR) || '.pdf' AS pdf_url,
  upper(lang) AS agency,
  source || '_' || lang || '_doc_' || CAST(doc_id AS VARCHAR) || '.pdf' AS filename,
  CAST(n_chars % 53 AS INTEGER) AS part_number, lang = 'de' AS is_dod, n_chars, lang, source
FROM documents
"""


def listings(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two landed-file directories: documents labelled quality=1 and toxic=1,
    each file named by its safe file name, size = n_chars."""
    m = doc_manifest(spark, sf_dir)
    lab = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    j = m.join(lab, "doc_id")
    files = j.select(urls.safe_filename(F.col("pdf_url")).alias("name"),
                     F.col("n_chars").alias("length"), "quality", "toxic")
    return [files.where(F.col("quality") == 1).select("name", "length"),
            files.where(F.col("toxic") == 1).select("name", "length")]


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two listings as one, from a single join: a file in both directories is listed twice."""
    m = doc_manifest(spark, sf_dir)
    lab = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    times = F.when(F.col("quality") == 1, 1).otherwise(0) + F.when(F.col("toxic") == 1, 1).otherwise(0)
    return m.join(lab, "doc_id").select(urls.safe_filename(F.col("pdf_url")).alias("name"), F.col("n_chars").alias("length"),
                                        F.explode(F.array_repeat(F.lit(0), times)).alias("_i")).drop("_i")


LISTINGS_SQL = f"""
SELECT {S.safe_filename('m.pdf_url')} AS name, m.n_chars AS length, l.quality, l.toxic
FROM ({DOC_MANIFEST_SQL}) m JOIN labels l USING (doc_id)
"""
LISTING_A = f"SELECT name, length FROM ({LISTINGS_SQL}) WHERE quality = 1"
LISTING_B = f"SELECT name, length FROM ({LISTINGS_SQL}) WHERE toxic = 1"


@query("pdf_worklist", f"""
SELECT DISTINCT pdf_url, agency, filename FROM ({DOC_MANIFEST_SQL}) WHERE NOT is_dod
""")
def pdf_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.worklist(doc_manifest(spark, sf_dir)).orderBy("agency", "filename")


@query("not_yet_landed", f"""
SELECT pdf_url, filename FROM ({DOC_MANIFEST_SQL}) m
WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT * FROM ({LISTING_A}) UNION ALL SELECT * FROM ({LISTING_B})) f
  WHERE f.length > 1024 AND f.name = {S.safe_filename('m.pdf_url')})
""")
def not_yet_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = doc_manifest(spark, sf_dir)
    return M.not_yet_landed(m, listings(spark, sf_dir)).select("pdf_url", "filename")


@query("retry_missing", f"""
WITH w AS (SELECT DISTINCT pdf_url, agency, filename FROM ({DOC_MANIFEST_SQL}) WHERE NOT is_dod),
o AS (
  SELECT DISTINCT regexp_extract(name, '^[0-9a-f]{{16}}_(.+)$', 1) AS filename
  FROM (SELECT * FROM ({LISTING_A}) UNION ALL SELECT * FROM ({LISTING_B}))
  WHERE regexp_matches(name, '^[0-9a-f]{{16}}_(.+)$')
)
SELECT * FROM w WHERE filename NOT IN (SELECT filename FROM o)
""")
def retry_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = M.worklist(doc_manifest(spark, sf_dir))
    return M.missing_originals(w, landed_files(spark, sf_dir))


RETRY_SQL = f"""
SELECT pdf_url FROM ({DOC_MANIFEST_SQL}) WHERE NOT is_dod AND filename NOT IN (
  SELECT regexp_extract(name, '^[0-9a-f]{{16}}_(.+)$', 1)
  FROM (SELECT * FROM ({LISTING_A}) UNION ALL SELECT * FROM ({LISTING_B})))
"""


@query("retry_extract", merge_sql(f"SELECT * FROM ({DOC_TEXT_SQL}) WHERE pdf_url IN ({RETRY_SQL})", take_date=True,
                                    drop_dod=True, blank_title=False, take_number=True))
def retry_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retry run re-drives extraction for the missing files."""
    docs = doc_text(spark, sf_dir).join(retry_missing(spark, sf_dir).select("pdf_url"), "pdf_url", "left_semi")
    return merged(spark, sf_dir, docs, document_names(spark, sf_dir), take_model_number=True)


@query("sync_report", f"""
WITH m AS (
  SELECT DISTINCT {S.safe_filename('pdf_url')} AS k FROM ({DOC_MANIFEST_SQL}) WHERE lang IN ('en', 'fr')
), d AS (
  SELECT DISTINCT name AS k FROM (SELECT * FROM ({LISTING_A}) UNION ALL SELECT * FROM ({LISTING_B}))
)
SELECT coalesce(m.k, d.k) AS on_disk_filename,
  CASE WHEN m.k IS NOT NULL AND d.k IS NOT NULL THEN 'kept' WHEN m.k IS NOT NULL THEN 'removed'
       ELSE 'missing' END AS status
FROM m FULL OUTER JOIN d ON m.k = d.k
""")
def sync_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = doc_manifest(spark, sf_dir).where(F.col("lang").isin("en", "fr")).select(
        urls.safe_filename(F.col("pdf_url")).alias("on_disk_filename"))
    return M.sync_report(m, landed_files(spark, sf_dir))


def _existing_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing manifest rows (all strings) for English documents; blanks
    seeded in some fields to exercise the "'' counts as missing" rule."""
    m = doc_manifest(spark, sf_dir).where(F.col("lang") == "en")
    sfn = urls.safe_filename(F.col("pdf_url"))
    i = F.col("doc_id")
    return m.select(
        sfn.alias("on_disk_filename"),
        F.when(i % 3 == 0, F.lit("")).otherwise(urls.url_hash(F.col("pdf_url"))).alias("url_hash"),
        F.when(i % 4 == 0, F.lit("")).otherwise(F.col("filename")).alias("original_filename"),
        F.when(i % 5 == 0, F.lit(None)).otherwise(F.lower("agency")).alias("agency"),
        F.when(i % 2 == 0, F.lit("")).otherwise(F.col("part_number").cast("string")).alias("part_number"),
        F.lit("").alias("is_dod"),
        F.col("pdf_url").alias("source_url"),
        F.col("n_chars").cast("string").alias("pdf_size_bytes"))


EXISTING_SQL = f"""
SELECT {S.safe_filename('pdf_url')} AS on_disk_filename,
  CASE WHEN doc_id % 3 = 0 THEN '' ELSE {S.url_hash('pdf_url')} END AS url_hash,
  CASE WHEN doc_id % 4 = 0 THEN '' ELSE filename END AS original_filename,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lower(agency) END AS agency,
  CASE WHEN doc_id % 2 = 0 THEN '' ELSE CAST(part_number AS VARCHAR) END AS part_number,
  '' AS is_dod, pdf_url AS source_url, CAST(n_chars AS VARCHAR) AS pdf_size_bytes
FROM ({DOC_MANIFEST_SQL}) WHERE lang = 'en'
"""


def _db_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DB metadata per on-disk name: part numbers of the manifest rows joined."""
    m = doc_manifest(spark, sf_dir).where(F.col("lang") != "es")
    rows = m.select(urls.safe_filename(F.col("pdf_url")).alias("on_disk_filename"),
                    "pdf_url", "agency", "filename", "part_number", "is_dod", "doc_id")
    g = M.part_list(rows, "on_disk_filename", ["doc_id"],
                    ["pdf_url", "agency", "filename", "is_dod"])
    return g.select(
        "on_disk_filename", F.substring_index("on_disk_filename", "_", 1).alias("url_hash"),
        F.col("filename").alias("original_filename"), "agency",
        F.col("part_number").alias("part_numbers"),
        F.when(F.col("is_dod"), F.lit("1")).otherwise(F.lit("0")).alias("is_dod"),
        F.col("pdf_url").alias("source_url"))


DB_META_SQL = f"""
SELECT {S.safe_filename('pdf_url')} AS on_disk_filename,
  split_part({S.safe_filename('pdf_url')}, '_', 1) AS url_hash,
  arg_min(filename, doc_id) AS original_filename, arg_min(agency, doc_id) AS agency,
  coalesce(array_to_string(list_sort(list_distinct(list(part_number) FILTER (WHERE part_number >= 0))), ';'), '') AS part_numbers,
  CASE WHEN arg_min(is_dod, doc_id) THEN '1' ELSE '0' END AS is_dod,
  arg_min(pdf_url, doc_id) AS source_url
FROM ({DOC_MANIFEST_SQL}) WHERE lang <> 'es'
GROUP BY 1, 2
"""


@query("manifest_rebuild", f"""
WITH l AS (SELECT name, max(length) AS length FROM (SELECT * FROM ({LISTING_A}) UNION ALL SELECT * FROM ({LISTING_B})) GROUP BY name),
e AS ({EXISTING_SQL}), d AS ({DB_META_SQL})
SELECT l.name AS on_disk_filename,
  coalesce(nullif(e.url_hash, ''), nullif(d.url_hash, ''), split_part(l.name, '_', 1)) AS url_hash,
  coalesce(nullif(e.original_filename, ''), nullif(d.original_filename, ''),
           CASE WHEN contains(l.name, '_') THEN substr(l.name, strpos(l.name, '_') + 1) ELSE l.name END) AS original_filename,
  coalesce(nullif(e.agency, ''), nullif(d.agency, ''), '') AS agency,
  coalesce(nullif(e.part_number, ''), nullif(d.part_numbers, ''), '') AS part_number,
  coalesce(nullif(e.is_dod, ''), nullif(d.is_dod, ''), '0') AS is_dod,
  coalesce(nullif(e.source_url, ''), nullif(d.source_url, ''), '') AS source_url,
  CAST(l.length AS VARCHAR) AS pdf_size_bytes
FROM l LEFT JOIN e ON l.name = e.on_disk_filename LEFT JOIN d ON l.name = d.on_disk_filename
""")
def manifest_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.rebuild(landed_files(spark, sf_dir), _existing_csv(spark, sf_dir), _db_meta(spark, sf_dir))


@query("sync_kept", f"""
SELECT * FROM ({EXISTING_SQL}) WHERE on_disk_filename IN (
  SELECT name FROM (SELECT * FROM ({LISTING_A}) UNION ALL SELECT * FROM ({LISTING_B})))
""")
def sync_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest rows that a sync writes back."""
    return M.kept_rows(_existing_csv(spark, sf_dir), landed_files(spark, sf_dir))


@query("part_worklist", f"""
SELECT DISTINCT pdf_url, agency, filename FROM ({DOC_MANIFEST_SQL}) WHERE NOT is_dod AND part_number = 12
""")
def part_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The worklist of one part."""
    return M.worklist(doc_manifest(spark, sf_dir), only_part=12)


@query("manifest_csv", f"""
SELECT on_disk_filename, coalesce(url_hash, '') AS url_hash,
  coalesce(original_filename, '') || ' "v1, final"' || chr(10) || 'x' AS original_filename, coalesce(agency, '') AS agency,
  coalesce(part_number, '') AS part_number, is_dod, source_url, pdf_size_bytes FROM ({EXISTING_SQL})
""")
def manifest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest written as CSV and read again (A5, A9), with quotes, commas and line
    breaks in a field; missing and empty fields are both empty in a CSV."""
    from ..sources import files
    from ..streaming.incremental import scratch

    name = F.concat(F.coalesce("original_filename", F.lit("")), F.lit(' "v1, final"\nx'))
    path = scratch(spark, "manifest-csv")
    files.write_manifest_csv(_existing_csv(spark, sf_dir).withColumn("original_filename", name), path)
    return files.read_manifest_csv(spark, path)


@query("download_outcomes", f"""
WITH w AS (SELECT DISTINCT pdf_url, agency, filename FROM ({DOC_MANIFEST_SQL}) WHERE NOT is_dod),
o AS (
  SELECT m.pdf_url, CASE WHEN l.toxic = 0 THEN 'pdfs/' || m.filename END AS saved_path,
         CASE WHEN l.toxic = 1 THEN 'status 404' END AS error
  FROM ({DOC_MANIFEST_SQL}) m JOIN labels l USING (doc_id)
)
SELECT w.pdf_url, w.filename, o.saved_path, o.error, o.saved_path IS NULL AS failed
FROM w LEFT JOIN o USING (pdf_url)
""")
def download_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work rows with what became of their download (C2); labelled documents have an outcome."""
    m = doc_manifest(spark, sf_dir)
    lab = table(spark, sf_dir, "labels", "doc_id", "toxic")
    outcomes = m.join(lab, "doc_id").select(
        "pdf_url", F.when(F.col("toxic") == 0, F.concat(F.lit("pdfs/"), F.col("filename"))).alias("saved_path"),
        F.when(F.col("toxic") == 1, F.lit("status 404")).alias("error"))
    return M.attach_outcomes(M.worklist(m), outcomes).select("pdf_url", "filename", "saved_path", "error", "failed")


def _pattern_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    rows = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.concat(F.col("n_name"), F.lit("|"), F.col("r_name")).alias("id"))
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    sn = s.join(n, s["s_nationkey"] == n["n_nationkey"])
    region = F.element_at(F.array(*[F.lit(x) for x in ("AFRICA", "AMERICA", "ASIA", "EUROPE",
                                                        "MIDDLE EAST")]),
                          (F.col("s_suppkey") % 5 + 1).cast("int"))
    fname = F.concat(F.substring(F.sha2(F.col("s_name"), 256), 1, 16), F.lit("_"), F.col("n_name"),
                     F.lit("_Deviation_"), region, F.lit("_"), F.col("s_suppkey").cast("string"),
                     F.lit(".pdf"))
    files = sn.select(fname.alias("filename"),
                      F.when(F.col("s_acctbal") > 0, F.col("s_name")).otherwise(F.lit("")).alias("title"))
    return rows, files


@query("pattern_join", """
WITH rows AS (
  SELECT n_name || '|' || r_name AS id FROM nation JOIN region ON n_regionkey = r_regionkey
), files AS (
  SELECT left(sha256(s_name), 16) || '_' || n_name || '_Deviation_'
         || ['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'][s_suppkey % 5 + 1]
         || '_' || CAST(s_suppkey AS VARCHAR) || '.pdf' AS filename,
         CASE WHEN s_acctbal > 0 THEN s_name ELSE '' END AS title
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)
SELECT id, filename, title FROM rows JOIN files
  ON files.filename LIKE '%\\_' || split_part(id, '|', 1) || '%' || split_part(id, '|', 2) || '%' ESCAPE '\\'
WHERE title <> ''
QUALIFY row_number() OVER (PARTITION BY id ORDER BY filename) = 1
""")
def pattern_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.links import first_per
    from ..operators.join import glob_match_join

    rows, files = _pattern_rows(spark, sf_dir)
    m = glob_match_join(rows, files)
    return first_per(m.where(F.col("title") != ""), ["id"], ["filename"]) \
        .select("id", "filename", "title")


RUN_SCHEMA = T.StructType([
    T.StructField("started_utc", T.StringType()),
    T.StructField("new_pdfs", T.ArrayType(T.StructType([
        T.StructField("pdf_url", T.StringType()), T.StructField("filename", T.StringType()),
        T.StructField("agency", T.StringType()), T.StructField("is_dod", T.BooleanType()),
        T.StructField("part_numbers", T.ArrayType(T.IntegerType())),
        T.StructField("saved_path", T.StringType()), T.StructField("error", T.StringType())]))),
])


def run_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run-manifest JSON document per event (two records each)."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    i = F.col("event_id").cast("string")

    def rec(suffix: str, saved) -> F.Column:
        return F.concat(
            F.lit('{"pdf_url": "https://docs.example.org/'), i, F.lit(suffix), F.lit('.pdf", "filename": "'),
            i, F.lit(suffix), F.lit('.pdf", "agency": "'), F.col("event_type"), F.lit('", "is_dod": '),
            (F.col("event_type") == "error").cast("string"), F.lit(', "part_numbers": ['),
            (F.col("user_id") % 53).cast("string"), F.lit('], "saved_path": '), saved,
            F.lit(', "error": null}'))

    saved_a = F.when(F.col("value") > 10, F.concat(F.lit('"pdfs/'), F.col("user_id").cast("string"),
                                                   F.lit('.pdf"'))).otherwise(F.lit("null"))
    saved_b = F.concat(F.lit('"pdfs/'), (F.col("user_id") + 2000).cast("string"), F.lit('.pdf"'))
    doc = F.concat(F.lit('{"started_utc": "'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
                   F.lit('", "new_pdfs": ['), rec("a", saved_a), F.lit(", "), rec("b", saved_b),
                   F.lit("]}"))
    return e.select("event_id", doc.alias("manifest"))


RUN_MANIFEST_SQL = """
SELECT event_id, '{"started_utc": "' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '", "new_pdfs": ['
  || '{"pdf_url": "https://docs.example.org/' || CAST(event_id AS VARCHAR) || 'a.pdf", "filename": "'
  || CAST(event_id AS VARCHAR) || 'a.pdf", "agency": "' || event_type || '", "is_dod": '
  || CAST(event_type = 'error' AS VARCHAR) || ', "part_numbers": [' || CAST(user_id % 53 AS VARCHAR)
  || '], "saved_path": ' || CASE WHEN value > 10 THEN '"pdfs/' || CAST(user_id AS VARCHAR) || '.pdf"' ELSE 'null' END
  || ', "error": null}, '
  || '{"pdf_url": "https://docs.example.org/' || CAST(event_id AS VARCHAR) || 'b.pdf", "filename": "'
  || CAST(event_id AS VARCHAR) || 'b.pdf", "agency": "' || event_type || '", "is_dod": '
  || CAST(event_type = 'error' AS VARCHAR) || ', "part_numbers": [' || CAST(user_id % 53 AS VARCHAR)
  || '], "saved_path": "pdfs/' || CAST(user_id + 2000 AS VARCHAR) || '.pdf", "error": null}]}' AS manifest
FROM events
"""


@query("incremental_candidates", f"""
WITH r AS (
  SELECT event_id, unnest(from_json(json_extract(manifest, '$.new_pdfs'),
    '[{{"pdf_url": "VARCHAR", "filename": "VARCHAR", "agency": "VARCHAR", "is_dod": "BOOLEAN", "saved_path": "VARCHAR"}}]')) AS rec
  FROM ({RUN_MANIFEST_SQL})
)
SELECT event_id, rec.pdf_url AS pdf_url, rec.filename AS filename, rec.agency AS agency,
       rec.saved_path AS saved_path
FROM r
WHERE rec.saved_path IS NOT NULL AND NOT coalesce(rec.is_dod, false)
  AND rec.saved_path IN (SELECT 'pdfs/' || CAST(c_custkey AS VARCHAR) || '.pdf' FROM customer)
""")
def incremental_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of run manifests that were saved, are not DoD and whose file
    still exists (customers stand in for the landed files)."""
    rm = run_manifests(spark, sf_dir)
    recs = rm.select("event_id", F.inline(F.from_json("manifest", RUN_SCHEMA)["new_pdfs"]))
    cand = recs.where(F.col("saved_path").isNotNull() & ~F.coalesce(F.col("is_dod"), F.lit(False)))
    files = table(spark, sf_dir, "customer", "c_custkey").select(
        F.concat(F.lit("pdfs/"), F.col("c_custkey").cast("string"), F.lit(".pdf")).alias("saved_path"))
    return cand.join(files, "saved_path", "left_semi").select(
        "event_id", "pdf_url", "filename", "agency", "saved_path")



@query("sync_preview", f"""
WITH m AS (
  SELECT DISTINCT {S.safe_filename('pdf_url')} AS k FROM ({DOC_MANIFEST_SQL}) WHERE lang IN ('en', 'fr')
), d AS (
  SELECT DISTINCT name AS k FROM (SELECT * FROM ({LISTING_A}) UNION ALL SELECT * FROM ({LISTING_B}))
), r AS (
  SELECT coalesce(m.k, d.k) AS on_disk_filename,
    CASE WHEN m.k IS NOT NULL AND d.k IS NOT NULL THEN 'kept' WHEN m.k IS NOT NULL THEN 'removed'
         ELSE 'missing' END AS status
  FROM m FULL OUTER JOIN d ON m.k = d.k
)
SELECT status, count(*) AS n,
  array_to_string(list(on_disk_filename ORDER BY on_disk_filename)[1:5], ', ') AS first_names,
  greatest(count(*) - 5, 0) AS more
FROM r GROUP BY status
""")
def sync_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconcile summary: per status its count, five names and "and N more"."""
    from ..operators.report import preview
    from ..session import materialize

    # the reconcile result feeds both the counts and the name lists: written
    # once to the checkpoint directory instead of being computed twice
    return preview(materialize(sync_report(spark, sf_dir)), "status", "on_disk_filename", 5)


DOWNLOAD_CAP = 20


@query("download_plan", f"""
WITH n AS (
  SELECT m.doc_id, m.pdf_url, m.filename, m.is_dod FROM ({DOC_MANIFEST_SQL}) m
  WHERE NOT EXISTS (
    SELECT 1 FROM (SELECT * FROM ({LISTING_A}) UNION ALL SELECT * FROM ({LISTING_B})) f
    WHERE f.length > 1024 AND f.name = {S.safe_filename('m.pdf_url')})
), r AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS ordinal FROM n)
SELECT pdf_url, filename, is_dod, ordinal,
  CASE WHEN ordinal > {DOWNLOAD_CAP} THEN 'deferred' WHEN is_dod THEN 'skipped: DoD' ELSE 'download' END AS action
FROM r
""")
def download_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New (not yet landed) documents in discovery order with a per-run cap;
    DoD rows use up the cap without being fetched."""
    m = doc_manifest(spark, sf_dir)
    new = M.not_yet_landed(m, listings(spark, sf_dir)).select("doc_id", "pdf_url", "filename", "is_dod")
    plan = M.download_plan(new, ["doc_id"], DOWNLOAD_CAP)
    return plan.select("pdf_url", "filename", "is_dod", "ordinal", "action")


@query("landed_listing", f"""
WITH s AS (SELECT DISTINCT 'https://docs.example.org/' || source || '.pdf' AS pdf_url, source FROM documents),
f AS (SELECT DISTINCT d.source FROM documents d JOIN labels l USING (doc_id) WHERE quality = 1 OR toxic = 1)
SELECT pdf_url, source AS filename, pdf_url IN (SELECT 'https://docs.example.org/' || source || '.pdf' FROM f) AS landed FROM s
""")
def landed_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landing folders are written, one object per source in each, listed by file metadata and matched."""
    from ..sources import files
    from ..streaming.incremental import scratch

    url = F.concat(F.lit("https://docs.example.org/"), F.col("source"), F.lit(".pdf"))
    d = table(spark, sf_dir, "documents", "doc_id", "source")
    lab = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    named = d.join(lab, "doc_id").select("doc_id", urls.safe_filename(url).alias("name"), "quality", "toxic")
    folders = []
    for flag in ("quality", "toxic"):
        folders.append(scratch(spark, f"landed-{flag}"))
        named.where(F.col(flag) == 1).select("doc_id", "name").write.partitionBy("name").parquet(folders[-1])
    listed = files.list_files(spark, folders, "*.parquet", by_folder=True)
    manifest = d.select(url.alias("pdf_url"), F.col("source").alias("filename")).distinct()
    return M.mark_landed(manifest, [listed], min_bytes=0)
