"""Section segmentation queries on ``documents`` (stand-in for Part 52 text).

Every line of every document becomes part of a clause layout by a rule on
its line index: heading lines (``52.<doc % 50>-<i % 7> ...``), prescribe lines
(``insert the following clause|provision: ... (MON YYYY)``), body lines and
end-marker lines.  Numbers repeat inside a document, so keep-first matters.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import paged as PG
from ..operators import sections as SEC
from ..session import table
from . import sqlfrag as S
from .registry import query

MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")


_MONTHS_ARRAY = "array(" + ", ".join(f"'{m}'" for m in MONTHS) + ")"
# every line rewritten by its 0-based index i (one Spark SQL expression)
_CLAUSE_TEXT_EXPR = f"""
array_join(transform(split(text, '\\n', -1), (x, i) ->
  CASE i % 4
    WHEN 0 THEN concat('52.', CAST(doc_id % 50 AS STRING), '-', CAST(i % 7 AS STRING), ' ', x)
    WHEN 1 THEN concat('As prescribed in ', CAST(i AS STRING), ', insert the following ',
                       CASE WHEN doc_id % 2 = 0 THEN 'provision' ELSE 'clause' END, ': ', x,
                       ' (', element_at({_MONTHS_ARRAY}, i % 12 + 1), ' ', CAST(2000 + i % 27 AS STRING), ')')
    WHEN 2 THEN x
    ELSE concat(x, ' (End of ', CASE i % 3 WHEN 0 THEN 'clause' WHEN 1 THEN 'provision'
                                   ELSE 'Solicitation Provision' END, ')')
  END), '\\n')
"""


def clause_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    return d.select("doc_id", F.expr(_CLAUSE_TEXT_EXPR).alias("text"))


_MON = "[" + ", ".join(S.q(m) for m in MONTHS) + "]"
CLAUSE_DOCS_SQL = f"""
SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x, j:
  CASE (j - 1) % 4
    WHEN 0 THEN '52.' || CAST(doc_id % 50 AS VARCHAR) || '-' || CAST((j - 1) % 7 AS VARCHAR) || ' ' || x
    WHEN 1 THEN 'As prescribed in ' || CAST(j - 1 AS VARCHAR) || ', insert the following '
                || CASE WHEN doc_id % 2 = 0 THEN 'provision' ELSE 'clause' END || ': ' || x
                || ' (' || {_MON}[((j - 1) % 12) + 1] || ' ' || CAST(2000 + (j - 1) % 27 AS VARCHAR) || ')'
    WHEN 2 THEN x
    ELSE x || ' (End of ' || CASE (j - 1) % 3 WHEN 0 THEN 'clause' WHEN 1 THEN 'provision'
                                 ELSE 'Solicitation Provision' END || ')'
  END), chr(10)) AS text
FROM documents
"""

_SPLIT = (f"list_slice(string_split(regexp_replace(text, {S.q('(?m)' + SEC.SECTION_RE)}, "
          f"chr(1) || '\\0', 'g'), chr(1)), 2, 2147483647)")


def _sections_sql(first_only: bool) -> str:
    items = "list_transform(secs, lambda sec, j: {'pos': CAST(j - 1 AS INTEGER), 'section': sec})"
    if first_only:
        nums = f"list_transform(secs, lambda sec: {S.rx('sec', '^(52\\.\\d+-\\d+)', 1)})"
        items = (f"list_filter({items}, lambda z: "
                 f"list_position({nums}, {nums}[z.pos + 1]) = z.pos + 1)")
    return f"""
WITH d AS ({CLAUSE_DOCS_SQL}),
sp AS (SELECT doc_id, {_SPLIT} AS secs FROM d),
e AS (SELECT doc_id, unnest({items}) AS z FROM sp)
SELECT doc_id, z.pos AS pos, {S.rx('z.section', '^(52\\.\\d+-\\d+)', 1)} AS number,
       {S.strip(S.rx('z.section', SEC.SECTION_RE, 2))} AS title, z.section AS section
FROM e
"""


def _fields_sql(sections_sql: str) -> str:
    marker = SEC.END_MARKER_RE.replace("(?i)", "(?i:") + ")"
    return f"""
WITH x AS ({sections_sql}),
y AS (
  SELECT *, regexp_extract(section, {S.q('(?s)^.*?' + marker)}, 0) AS btm,
         regexp_extract(section, {S.q(SEC.END_MARKER_RE)}, 1) AS endw,
         regexp_extract(left(section, {SEC.KIND_WINDOW}), {S.q(SEC.KIND_RE)}, 1) AS kw
  FROM x
)
SELECT doc_id, pos, number, title,
  CASE WHEN kw <> '' THEN upper(left(kw, 1)) || lower(substr(kw, 2))
       WHEN endw = 'solicitation provision' THEN 'Provision'
       WHEN endw <> '' THEN upper(left(endw, 1)) || lower(substr(endw, 2))
       ELSE 'Unknown' END AS kind,
  nullif(regexp_extract(left(section, {SEC.DATE_WINDOW}), {S.q(SEC.DATE_RE)}, 1), '') AS effective_date,
  {S.strip("CASE WHEN btm <> '' THEN btm ELSE section END")} AS full_text
FROM y
"""


@query("section_segment", f"SELECT doc_id, pos, number, title, length(section) AS section_chars "
                          f"FROM ({_sections_sql(False)})")
def section_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = SEC.segment(clause_docs(spark, sf_dir), keep=("doc_id",))
    return s.select("doc_id", "pos", "number", "title",
                    F.length("section").cast("bigint").alias("section_chars"))


@query("dedup_keep_first", f"SELECT doc_id, pos, number FROM ({_sections_sql(True)})")
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = SEC.segment(clause_docs(spark, sf_dir), keep=("doc_id",), first_only=True)
    return s.select("doc_id", "pos", "number")


@query("clause_fields", _fields_sql(_sections_sql(True)))
def clause_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = SEC.segment(clause_docs(spark, sf_dir), keep=("doc_id",), first_only=True)
    return SEC.clause_fields(s)


# the clause text with the title of every third heading on the line below its number, and its pages of three lines
_PAGED_TEXT_EXPR = """array_join(transform(split(text, '\\n', -1), (x, i) -> CASE WHEN i % 12 = 0 THEN regexp_replace(x, '^([0-9.-]+) ', '$1\n') ELSE x END), '\n')"""
_PAGES_EXPR = """transform(sequence(0, (size(lines) - 1) div 3), p -> array_join(slice(lines, p * 3 + 1, 3), '\n'))"""
PAGED_TEXT_SQL = f"""
SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x, i:
  CASE WHEN (i - 1) % 12 = 0 THEN regexp_replace(x, '^([0-9.-]+) ', '\\1' || chr(10)) ELSE x END), chr(10)) AS text
FROM ({CLAUSE_DOCS_SQL})
"""


def clause_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clause documents as pages of three lines: headings straddle pages."""
    d = clause_docs(spark, sf_dir).select("doc_id", F.expr(_PAGED_TEXT_EXPR).alias("text"))
    lines = d.where(F.col("text").isNotNull()).select("doc_id", F.split("text", "\n", -1).alias("lines"))
    return lines.select("doc_id", F.posexplode(F.expr(_PAGES_EXPR)).alias("page_no", "text"))


@query("section_pages", f"""
WITH d AS ({PAGED_TEXT_SQL}),
sp AS (SELECT doc_id, {_SPLIT} AS secs FROM d),
e AS (SELECT doc_id, unnest(list_transform(secs, lambda sec, j: {{'pos': j - 1, 'section': sec}})) AS z FROM sp)
SELECT doc_id, z.pos AS pos, {S.rx('z.section', '^(52\\.\\d+-\\d+)', 1)} AS number,
       {S.strip(S.rx('z.section', SEC.SECTION_RE, 2))} AS title, length(z.section) AS section_chars
FROM e
""")
def section_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of documents that land as page texts (A4), found without joining a document's pages."""
    from ..sources import files
    from ..streaming.incremental import scratch

    path = scratch(spark, "page-text")
    clause_pages(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc"), "page_no", F.col("text").alias("page_text")).write.parquet(path)
    landed = files.read_page_text(spark, path).select(F.col("doc").cast("bigint").alias("doc_id"), "page_no", F.col("page_text").alias("text"))
    chunks = PG.segment_pages(landed)
    g = chunks.groupBy("doc_id", "pos").agg(F.max("number").alias("number"), F.max("title").alias("title"),
                                            F.sum(F.length("chunk")).alias("section_chars"))
    return g.select("doc_id", "pos", "number", "title", "section_chars")
