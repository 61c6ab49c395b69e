"""Field-extraction queries on ``documents``, ``labels``, ``conversations``,
``events`` and ``pages`` (stand-ins for PDF text, model answers and fetches)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields
from ..operators import extract as X
from ..operators import store
from ..session import table
from . import sqlfrag as S
from .registry import query


def doc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a dated phrase and a deviation-number phrase appended
    (shapes chosen by doc_id), plus file name and URL."""
    return synth_doc_text(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


# Phrase shapes and names per document as Spark SQL expressions (each handed
# to the JVM in one call); the same formulas as DOC_TEXT_SQL below.
_DAY = "date_add(DATE'2025-01-01', CAST(doc_id % 365 AS INT))"
_DOC_TEXT_EXPR = f"""
concat_ws(' ', text,
  CASE doc_id % 6
    WHEN 0 THEN concat('Effective Date: ', date_format({_DAY}, 'MMMM d, yyyy'))
    WHEN 1 THEN concat('This deviation is effective on ', date_format({_DAY}, 'MMMM d, yyyy'), '.')
    WHEN 2 THEN concat('effective ', date_format({_DAY}, 'yyyy-MM-dd'))
    WHEN 3 THEN concat('effective: ', date_format({_DAY}, 'M/d/yyyy'))
    WHEN 4 THEN ''
    ELSE concat('effective ', date_format({_DAY}, 'yyyy-MM-dd'), ' and effective date: ',
                date_format({_DAY}, 'MMMM d, yyyy'))
  END,
  CASE doc_id % 5
    WHEN 0 THEN concat('Class Deviation CD-', CAST(2020 + doc_id % 6 AS STRING), '-0',
                       CAST(doc_id % 9 AS STRING), ' is issued')
    WHEN 1 THEN concat('Class Deviation ', CAST(doc_id % 90 + 10 AS STRING), '-0',
                       CAST(doc_id % 7 AS STRING), ' supersedes')
    WHEN 2 THEN 'this deviation notice'
    WHEN 3 THEN concat('Class Deviation (Number ', CAST(2000 + doc_id % 30 AS STRING), '-',
                       CAST(doc_id % 13 AS STRING), ')')
    ELSE ''
  END)
"""
_FILENAME_EXPR = "concat(source, '_', lang, '_doc_', CAST(doc_id AS STRING), '.pdf')"


def pdf_url() -> F.Column:
    return F.concat(F.lit("https://docs.example.org/"), F.col("source"), F.lit("/"), F.expr(_FILENAME_EXPR)).alias("pdf_url")


def synth_doc_text(d: DataFrame, *keep: str) -> DataFrame:
    return d.select(*keep, "doc_id", "lang", "source", F.expr(_DOC_TEXT_EXPR).alias("text"),
                    F.expr(_FILENAME_EXPR).alias("filename"), pdf_url())


DOC_TEXT_SQL = """
SELECT doc_id, lang, source,
  concat_ws(' ', text,
    CASE doc_id % 6
      WHEN 0 THEN 'Effective Date: ' || strftime(DATE '2025-01-01' + CAST(doc_id % 365 AS INTEGER), '%B %-d, %Y')
      WHEN 1 THEN 'This deviation is effective on ' || strftime(DATE '2025-01-01' + CAST(doc_id % 365 AS INTEGER), '%B %-d, %Y') || '.'
      WHEN 2 THEN 'effective ' || strftime(DATE '2025-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d')
      WHEN 3 THEN 'effective: ' || strftime(DATE '2025-01-01' + CAST(doc_id % 365 AS INTEGER), '%-m/%-d/%Y')
      WHEN 4 THEN ''
      ELSE 'effective ' || strftime(DATE '2025-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d')
           || ' and effective date: ' || strftime(DATE '2025-01-01' + CAST(doc_id % 365 AS INTEGER), '%B %-d, %Y')
    END,
    CASE doc_id % 5
      WHEN 0 THEN 'Class Deviation CD-' || CAST(2020 + doc_id % 6 AS VARCHAR) || '-0' || CAST(doc_id % 9 AS VARCHAR) || ' is issued'
      WHEN 1 THEN 'Class Deviation ' || CAST(doc_id % 90 + 10 AS VARCHAR) || '-0' || CAST(doc_id % 7 AS VARCHAR) || ' supersedes'
      WHEN 2 THEN 'this deviation notice'
      WHEN 3 THEN 'Class Deviation (Number ' || CAST(2000 + doc_id % 30 AS VARCHAR) || '-' || CAST(doc_id % 13 AS VARCHAR) || ')'
      ELSE ''
    END) AS text,
  source || '_' || lang || '_doc_' || CAST(doc_id AS VARCHAR) || '.pdf' AS filename,
  'https://docs.example.org/' || source || '/' || source || '_' || lang || '_doc_' || CAST(doc_id AS VARCHAR) || '.pdf' AS pdf_url
FROM documents
"""


@query("effective_date", f"""
SELECT doc_id, {S.first_match('text', fields.EFFECTIVE_PATTERNS)} AS effective_date
FROM ({DOC_TEXT_SQL})
""")
def effective_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = doc_text(spark, sf_dir)
    return d.select("doc_id", fields.effective_date("text").alias("effective_date"))


@query("deviation_number", f"""
SELECT doc_id, {S.first_match('text', fields.DEVIATION_NUM_PATTERNS, 'filename')} AS deviation_number
FROM ({DOC_TEXT_SQL})
""")
def deviation_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = doc_text(spark, sf_dir)
    return d.select("doc_id", fields.deviation_number("text", "filename")
                    .alias("deviation_number"))


@query("text_gate", """
SELECT doc_id, length(text) AS chars, md5(text) AS text_md5, md5(left(text, 20000)) AS model_input_md5
FROM documents WHERE length(text) >= 200
""")
def text_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = X.text_gate(table(spark, sf_dir, "documents", "doc_id", "text"))
    return d.select("doc_id", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("text_md5"),
                    F.md5(X.model_input(F.col("text"))).alias("model_input_md5"))


@query("assemble_text", """
SELECT conv_id, count(*) AS n_pages, string_agg(text, chr(10) ORDER BY turn) AS text
FROM conversations WHERE text IS NOT NULL GROUP BY conv_id
""")
def assemble_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole text of every document."""
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    return X.assemble_text(c, "conv_id", "turn", "text")


@query("assemble_text_60", """
WITH r AS (
  SELECT conv_id, turn, text FROM conversations WHERE text IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 60
)
SELECT conv_id, count(*) AS n_pages, string_agg(text, chr(10) ORDER BY turn) AS text
FROM r GROUP BY conv_id
""")
def assemble_text_60(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full run reads the first 60 pages of a PDF."""
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    return X.assemble_text(c, "conv_id", "turn", "text", max_pages=60)


def model_answers(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """A JSON model answer per labelled document: valid, empty, DoD, broken, without the
    required number, or with an invalid second element."""
    lab = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    j = lab.join(docs.select("doc_id", "lang", "source", "pdf_url"), "doc_id")
    q, t, i = F.col("quality"), F.col("toxic"), F.col("doc_id").cast("string")
    number = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(
        F.concat(F.lit('"deviation_number": "M-'), i, F.lit('", ')))
    second = F.when(F.col("doc_id") % 7 == 0, F.lit(', {"agency": "X"}')).otherwise(F.lit(""))
    resp = (F.when((t == 1) & (q == 0), F.lit('{"deviations": []}'))
            .when(t == 1, F.concat(F.lit('{"deviations": [{'), number, F.lit('"agency": "Department of Defense", "title": "T'),
                                   i, F.lit('", "scope": "s"}]}')))
            .when(q == 1, F.concat(F.lit('{"deviations": [{'), number, F.lit('"agency": "'), F.col("lang"),
                                   F.lit('", "title": "Deviation '), i,
                                   F.lit('", "scope": "Scope of '), F.col("source"),
                                   F.lit('", "effective_date": "March 3, 2026"}'), second, F.lit("]}")))
            .otherwise(F.lit("not json {")))
    return j.select("pdf_url", resp.alias("response"))


MODEL_SQL = f"""
SELECT d.pdf_url,
  CASE WHEN l.toxic = 1 AND l.quality = 0 THEN '{{"deviations": []}}'
       WHEN l.toxic = 1 THEN '{{"deviations": [{{' || num || '"agency": "Department of Defense", "title": "T' || CAST(l.doc_id AS VARCHAR) || '", "scope": "s"}}]}}'
       WHEN l.quality = 1 THEN '{{"deviations": [{{' || num || '"agency": "' || d.lang || '", "title": "Deviation ' || CAST(l.doc_id AS VARCHAR)
            || '", "scope": "Scope of ' || d.source || '", "effective_date": "March 3, 2026"}}'
            || CASE WHEN l.doc_id % 7 = 0 THEN ', {{"agency": "X"}}' ELSE '' END || ']}}'
       ELSE 'not json {{' END AS response
FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN '' ELSE '"deviation_number": "M-' || CAST(doc_id AS VARCHAR) || '", ' END AS num FROM labels) l
JOIN ({DOC_TEXT_SQL}) d USING (doc_id)
"""

_VALID = " AND ".join(
    [f"coalesce(json_type(x, '$.{n}'), '') = 'VARCHAR'" for n in ("agency", "deviation_number", "title")]
    + [f"coalesce(json_type(x, '$.{n}'), 'NULL') IN ('VARCHAR', 'NULL')" for n in ("effective_date", "scope", "link")])


def merge_sql(docs: str, take_date: bool, drop_dod: bool, blank_title: bool, take_number: bool) -> str:
    """Regex fields first, model fields second, one row per id."""
    title = "replace(replace(filename, '.pdf', ''), '_', ' ')"
    title = f"coalesce(nullif(m_title, ''), {title})" if blank_title else f"CASE WHEN has_model THEN m_title ELSE {title} END"
    date = "CASE WHEN nullif(rx_date, '') IS NULL AND has_model THEN m_date ELSE rx_date END" if take_date else "rx_date"
    number = "coalesce(nullif(rx_num, ''), nullif(m_num, ''), rx_num)" if take_number else "rx_num"
    keep = "NOT (has_model AND coalesce(upper(m_agency) IN ('DOD', 'DEPARTMENT OF DEFENSE'), false))" if drop_dod else "true"
    return f"""
WITH d AS (
  SELECT pdf_url, filename, {S.agency_label('filename')} AS agency,
         {S.first_match('text', fields.EFFECTIVE_PATTERNS)} AS rx_date,
         {S.first_match('text', fields.DEVIATION_NUM_PATTERNS, 'filename')} AS rx_num
  FROM ({docs}) WHERE length(text) >= 200
), m AS (
  SELECT pdf_url, CASE WHEN json_valid(response) AND json_type(response, '$.deviations') = 'ARRAY'
      AND json_array_length(response, '$.deviations') > 0
      AND len(list_filter(json_extract(response, '$.deviations[*]'), lambda x: NOT ({_VALID}))) = 0
    THEN json_extract(response, '$.deviations[0]') END AS dv
  FROM ({MODEL_SQL})
), j AS (
  SELECT d.*, m.dv IS NOT NULL AS has_model, json_extract_string(m.dv, '$.deviation_number') AS m_num,
    json_extract_string(m.dv, '$.agency') AS m_agency, json_extract_string(m.dv, '$.title') AS m_title,
    json_extract_string(m.dv, '$.scope') AS m_scope, json_extract_string(m.dv, '$.effective_date') AS m_date
  FROM d LEFT JOIN m USING (pdf_url)
), n AS (SELECT *, {number} AS num FROM j), k AS (
  SELECT coalesce(agency, 'None') || '|' || coalesce(nullif(num, ''), nullif(filename, ''), 'None') AS id,
    agency, num AS deviation_number, {title} AS title, {date} AS effective_date,
    m_scope AS scope, pdf_url AS link, filename
  FROM n WHERE {keep}
)
SELECT id, agency, deviation_number, title, effective_date, scope, link FROM k
QUALIFY row_number() OVER (PARTITION BY id ORDER BY agency DESC, filename DESC, link DESC) = 1
"""


def merged(spark: SparkSession, sf_dir: str, docs: DataFrame, all_docs: DataFrame, **options) -> DataFrame:
    """Fields of ``docs`` and their model answers, the last row per id."""
    with_agency = docs.withColumn("agency", fields.agency_label("filename"))
    rows = X.merge_fields(with_agency.select("pdf_url", "agency", "filename", "text"),
                          model_answers(spark, sf_dir, all_docs), **options)
    return store.last_per_key(rows, ["id"], ["agency", "filename", "link"]).drop("filename")


def document_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, names and URLs of the documents, without their texts."""
    d = table(spark, sf_dir, "documents", "doc_id", "lang", "source")
    return d.select("doc_id", "lang", "source", pdf_url())


@query("incremental_merge", merge_sql(DOC_TEXT_SQL, take_date=False, drop_dod=False, blank_title=True, take_number=False))
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incremental rules: a model answer that names DoD drops nothing."""
    return merged(spark, sf_dir, doc_text(spark, sf_dir), document_names(spark, sf_dir), take_model_date=False,
                  title_fallback_when_blank=True, drop_dod=False)


@query("field_merge", merge_sql(DOC_TEXT_SQL, take_date=True, drop_dod=True, blank_title=False, take_number=False))
def field_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged(spark, sf_dir, doc_text(spark, sf_dir), document_names(spark, sf_dir))


def model_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-text model replies per event: bare JSON, JSON in prose, truncated,
    wrong key, extra field."""
    e = table(spark, sf_dir, "events", "event_id", "event_type", "props")
    t, p = F.col("event_type"), F.col("props")
    txt = (F.when(t == "view", p)
           .when(t == "click", F.concat(F.lit("Here is the result: "), p, F.lit(" hope it helps")))
           .when(t == "error", F.substring(p, 1, 5))
           .when(t == "purchase", F.replace(p, F.lit('"k"'), F.lit('"j"')))
           .otherwise(F.concat(F.substring_index(p, "}", 1), F.lit(', "note": "'), t, F.lit('"}'))))
    return e.select("event_id", txt.alias("response"))


MODEL_TEXT_SQL = """
SELECT event_id,
  CASE event_type
    WHEN 'view' THEN props
    WHEN 'click' THEN 'Here is the result: ' || props || ' hope it helps'
    WHEN 'error' THEN left(props, 5)
    WHEN 'purchase' THEN replace(props, '"k"', '"j"')
    ELSE split_part(props, '}', 1) || ', "note": "' || event_type || '"}'
  END AS response
FROM events
"""


@query("structured_validate", f"""
SELECT event_id, TRY_CAST(json_extract(response, '$.k') AS INTEGER) AS k,
       json_extract_string(response, '$.note') AS note
FROM ({MODEL_TEXT_SQL})
WHERE json_valid(response) AND json_type(response) = 'OBJECT'
  AND TRY_CAST(json_extract(response, '$.k') AS INTEGER) IS NOT NULL
""")
def structured_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.validate(model_texts(spark, sf_dir), "response", {"k": "int"}, {"note": "string"})


@query("json_from_text", f"""
WITH s AS (
  SELECT event_id, nullif(regexp_extract(response, '(?s)\\{{.*\\}}', 0), '') AS js FROM ({MODEL_TEXT_SQL})
), v AS (
  SELECT event_id, CASE WHEN json_valid(js) AND json_type(js) = 'OBJECT' THEN js END AS js FROM s
)
SELECT event_id, coalesce(json_extract_string(js, '$.k'), '') AS k,
       coalesce(json_extract_string(js, '$.note'), '') AS note
FROM v
""")
def json_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model_texts(spark, sf_dir)
    return m.select("event_id", X.json_fields(F.col("response"), ["k", "note"]).alias("f")) \
        .select("event_id", "f.k", "f.note")


@query("cache_resolve", f"""
WITH fresh AS (
  SELECT url, CASE WHEN page_id % 7 = 3 THEN NULL ELSE html END AS html,
         CASE WHEN page_id % 7 = 3 THEN 'status 404' END AS error
  FROM pages
), cache AS (
  SELECT {S.url_hash('url')} AS url_hash, '<html>cached ' || CAST(page_id AS VARCHAR) || '</html>' AS cached
  FROM pages WHERE page_id % 2 = 0
)
SELECT url, md5(CASE WHEN cached IS NOT NULL THEN cached ELSE html END) AS html_md5,
       CASE WHEN cached IS NOT NULL THEN NULL ELSE error END AS error
FROM fresh LEFT JOIN cache ON {S.url_hash('fresh.url')} = cache.url_hash
""")
def cache_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.urls import url_hash

    p = table(spark, sf_dir, "pages", "page_id", "url", "html")
    failed = F.col("page_id") % 7 == 3
    fresh = p.select("url", F.when(failed, F.lit(None)).otherwise(F.col("html")).alias("html"),
                     F.when(failed, F.lit("status 404")).alias("error"))
    cache = p.where(F.col("page_id") % 2 == 0).select(
        url_hash(F.col("url")).alias("url_hash"),
        F.concat(F.lit("<html>cached "), F.col("page_id").cast("string"), F.lit("</html>")).alias("html"))
    r = X.cache_resolve(fresh, cache, use_cache=True)
    return r.select("url", F.md5("html").alias("html_md5"), "error")
