"""Link, manifest-name and page-text queries on ``pages``, ``documents`` and
``lineitem`` (stand-ins for the guide page and the PDF file names)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields, urls
from ..operators import links as L
from ..operators import manifest as M
from ..operators import store as ST
from ..session import table
from ..streaming.incremental import scratch
from . import markup_sql as MS
from . import sqlfrag as S
from .registry import query

def page_links(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return L.extract_links(pages, keep=keep)


LINKS_SQL = f"""
WITH a AS (
  SELECT page_id, url, {S.anchors(S.visible('html'))} AS anchors FROM pages
), e AS (
  SELECT page_id, url, anchors, unnest(generate_series(1, len(anchors))) AS i FROM a
)
SELECT page_id, url, CAST(i - 1 AS INTEGER) AS pos, {S.href_of('anchors[i]')} AS href,
       {S.tag_text('anchors[i]')} AS anchor_text
FROM e
"""


@query("link_extract", f"SELECT page_id, pos, href, anchor_text FROM ({LINKS_SQL})")
def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(spark, sf_dir)


@query("top_links", f"SELECT page_id, pos, href FROM ({LINKS_SQL}) WHERE pos < 5")
def top_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.top_links(page_links(spark, sf_dir), n=5).select("page_id", "pos", "href")


@query("landed_pages", f"""
WITH l AS ({LINKS_SQL}), p AS (SELECT page_id, url, page_id % 9 = 4 AS failed FROM pages)
SELECT p.url, p.failed, count(l.pos) AS links, min(l.href) AS first_href
FROM p LEFT JOIN l ON l.page_id = p.page_id AND NOT p.failed GROUP BY p.page_id, p.url, p.failed
""")
def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch results landed by one job and read by the next (A1): the links of those that have a page."""
    from ..sources import files

    p = table(spark, sf_dir, "pages", "page_id", "url", "html")
    failed = F.col("page_id") % 9 == 4
    path = scratch(spark, "landed-pages")
    fetched = p.select("url", F.when(~failed, F.col("html")).alias("html"), F.when(failed, F.lit("status 404")).alias("error"))
    fetched.write.parquet(path)
    back = files.read_landed_pages(spark, path)
    links = L.anchors(L.visible("html"))
    return back.select("url", F.col("error").isNotNull().alias("failed"), F.coalesce(F.size(links), F.lit(0)).cast("bigint").alias("links"),
                       F.array_min(F.transform(links, L.href_of)).alias("first_href"))


# Stand-in for the PDF-upload pattern: nav links whose path is /t + letters.
DOC_LINK_RE = r"(?i)/t[a-z]+$"


# the same links written in other ways, by their place: from the page's folder, through another folder, as they are
WRITTEN_EXPR = """
CASE pos % 4 WHEN 1 THEN concat('..', href) WHEN 2 THEN concat('./x/../../', substring(href, 2)) WHEN 3 THEN concat('/a/./b/../..', href) ELSE href END
"""
_WRITTEN_SQL = """
CASE pos % 4 WHEN 1 THEN '..' || href WHEN 2 THEN './x/../../' || substr(href, 2) WHEN 3 THEN '/a/./b/../..' || href ELSE href END
"""


def _manifest_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = page_links(spark, sf_dir, "url").withColumn("href", F.expr(WRITTEN_EXPR))
    return L.link_manifest(links, F.col("url"), pattern=DOC_LINK_RE)


MANIFEST_SQL = f"""
WITH l AS (
  SELECT page_id, url, pos, {S.strip_query('href')} AS href FROM (SELECT page_id, url, pos, {_WRITTEN_SQL} AS href FROM ({LINKS_SQL}))
), f AS (
  SELECT * FROM l WHERE regexp_matches(href, {S.q(DOC_LINK_RE)})
  QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY pos) = 1
), r AS (
  SELECT page_id, pos, {S.resolve('href', 'url')} AS pdf_url, {S.basename('href')} AS filename FROM f
)
SELECT page_id, pos, pdf_url, filename, {S.agency_label('filename')} AS agency,
       {S.is_dod('filename')} AS is_dod, {S.parts_from_filename('filename')} AS part_numbers
FROM r
"""


PART_PDFS_SQL = f"""
SELECT DISTINCT pdf_url, agency, filename,
       unnest(CASE WHEN len(part_numbers) > 0 THEN part_numbers ELSE [-1] END) AS part_number,
       is_dod
FROM ({MANIFEST_SQL})
"""


@query("pdf_manifest", PART_PDFS_SQL)
def pdf_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-refresh manifest keyed by (pdf_url, part_number)."""
    m = L.explode_parts(_manifest_links(spark, sf_dir))
    return M.manifest_rows(m)


@query("manifest_refresh", PART_PDFS_SQL)
def manifest_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest table of an earlier run (pages of other sites) is replaced by today's and read again."""
    path = scratch(spark, "part-pdfs")
    rows = pdf_manifest(spark, sf_dir)
    ST.append_table(rows.withColumn("pdf_url", F.concat(F.lit("https://old.example.org/"), F.col("filename"))), path)
    return ST.refresh_table(rows, path)


GUIDE_PART = "/far-overhaul/far-part-deviation-guide/far-overhaul-part-"


# what stands around a Part link, by page: the heading itself, a third ancestor, a fourth, an unclosed heading, an
# unclosed list item around it
_AROUND = (("<h3>", "</h3>"), ("<h2><span><b>", "</b></span></h2>"), ("<h4><i><span><b>", "</b></span></i></h4>"),
           ("<h3>", ""), ("<ul><li>x<li><h3><em>", "</em></h3></ul>"))


def guide_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page turned into a guide page: a heading holding a Part link
    (number from the page id), the page title as anchor text and dated status
    lines, followed by the page's own HTML.  The heading's shape goes by the page id."""
    p = table(spark, sf_dir, "pages", "page_id", "url", "html")
    title = F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    issued = F.date_format(F.date_add(F.lit("2025-01-01").cast("date"),
                                      (F.col("page_id") % 365).cast("int")), "MMMM d, yyyy")
    updated = F.when(F.col("page_id") % 3 == 0, F.concat(
        F.lit(" UPDATE: "), F.date_format(F.date_add(F.lit("2025-06-01").cast("date"),
                                                     (F.col("page_id") % 90).cast("int")),
                                          "MMMM d, yyyy"))).otherwise(F.lit(""))
    shape = (F.col("page_id") % len(_AROUND) + 1).cast("int")
    before, after = (F.element_at(F.array(*[F.lit(x[i]) for x in _AROUND]), shape) for i in (0, 1))
    head = F.concat(before, F.lit('<a href="'), F.lit(GUIDE_PART), (F.col("page_id") % 60).cast("string"),
                    F.lit('?x=1">'), title, F.lit("</a> Issuance Date: "), issued, updated, after)
    return p.select("page_id", urls.site_root(F.col("url")).alias("base"),
                    F.concat(head, F.col("html")).alias("html"))


_AROUND_SQL = ["[" + ", ".join(S.q(x[i]) for x in _AROUND) + f"][page_id % {len(_AROUND)} + 1]" for i in (0, 1)]
GUIDE_SQL = f"""
SELECT page_id, {S.site_root('url')} AS base,
  {_AROUND_SQL[0]} || '<a href="{GUIDE_PART}' || CAST(page_id % 60 AS VARCHAR) || '?x=1">'
  || regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)
  || '</a> Issuance Date: ' || strftime(DATE '2025-01-01' + CAST(page_id % 365 AS INTEGER), '%B %-d, %Y')
  || CASE WHEN page_id % 3 = 0 THEN ' UPDATE: ' || strftime(DATE '2025-06-01' + CAST(page_id % 90 AS INTEGER), '%B %-d, %Y') ELSE '' END
  || {_AROUND_SQL[1]} || html AS html
FROM pages
"""
_PART_HREF = f"split_part(split_part({S.href_of('tag')}, '?', 1), '#', 1)"


@query("heading_dates", f"""
WITH l AS ({MS.ancestor_links(f"({GUIDE_SQL}) g", "page_id, base", "html", _PART_HREF, f"regexp_matches(href, {S.q(L.PART_LINK_RE)})")}),
t AS (SELECT *, {S.tag_text('heading')} AS htxt FROM l),
p AS (
  SELECT page_id, pos, TRY_CAST(regexp_extract(href, {S.q(L.PART_LINK_RE)}, 1) AS INTEGER) AS part_number,
    CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href ELSE base || href END AS overview_url,
    nullif(regexp_extract(htxt, {S.q(L.ISSUANCE_RE)}, 1), '') AS issued,
    nullif(regexp_extract(htxt, {S.q(L.UPDATE_RE)}, 1), '') AS updated,
    {S.tag_text('anchor')} AS title_hint
  FROM t
)
SELECT page_id, part_number, overview_url, issued, updated, title_hint FROM p
WHERE part_number IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY page_id, part_number ORDER BY pos) = 1
""")
def heading_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.part_headings(guide_pages(spark, sf_dir))


@query("safe_filename", f"""
SELECT page_id, {S.url_hash('url')} AS url_hash, {S.safe_filename('url')} AS safe_filename,
       nullif(regexp_extract({S.safe_filename('url')}, '^[0-9a-f]{{16}}_(.+)$', 1), '') AS original_filename
FROM pages
""")
def safe_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages", "page_id", "url")
    sf = urls.safe_filename(F.col("url"))
    return p.select("page_id", urls.url_hash(F.col("url")).alias("url_hash"),
                    sf.alias("safe_filename"), urls.original_from_safe(sf).alias("original_filename"))


# a file name per document: an agency key or another word by its length, in upper or lower case, then its source and id
_NAME_WORDS = tuple(k for k, _ in fields.AGENCY_MAP) + ("DEFENSE", "mystery", "Dept-of Defense")
_AGENCY_NAME_EXPR = ("concat(CASE WHEN doc_id % 2 = 0 THEN {word} ELSE lower({word}) END, '_Class_Deviation_', source, '_', lang, '_', CAST(doc_id AS {string}), '.pdf')")
_DOC_NAME_EXPR = _AGENCY_NAME_EXPR.format(string="STRING", word="element_at(array(" + ", ".join(S.q(w) for w in _NAME_WORDS)
                                          + f"), CAST(n_chars % {len(_NAME_WORDS)} + 1 AS INT))")


def doc_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file name per document from its length, source, language and id."""
    d = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars")
    return d.select("doc_id", "lang", F.expr(_DOC_NAME_EXPR).alias("filename"))


DOC_NAMES_SQL = f"""
SELECT doc_id, lang, {_AGENCY_NAME_EXPR.format(string="VARCHAR", word="[" + ", ".join(S.q(w) for w in _NAME_WORDS)
                                               + f"][n_chars % {len(_NAME_WORDS)} + 1]")} AS filename
FROM documents
"""


@query("agency_lookup", f"""
SELECT doc_id, filename, {S.agency_label('filename')} AS agency, {S.is_dod('filename')} AS is_dod
FROM ({DOC_NAMES_SQL})
""")
def agency_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = doc_filenames(spark, sf_dir)
    return d.select("doc_id", "filename", fields.agency_label("filename").alias("agency"),
                    fields.is_dod("filename").alias("is_dod"))


# one file-name shape per line item (Spark SQL; same formula as below)
_LINEITEM_NAME_EXPR = """
CASE l_orderkey % 6
  WHEN 0 THEN concat('GSA_Class_Deviation_Parts-', CAST(l_linenumber AS STRING), '-',
                     CAST(l_partkey % 53 AS STRING), '.pdf')
  WHEN 1 THEN concat('USAID_RFO_Deviation_Parts-', CAST(l_linenumber AS STRING), '-',
                     CAST(l_suppkey % 53 AS STRING), '-and-', CAST(l_partkey % 11 AS STRING), '.PDF')
  WHEN 2 THEN concat('DOD_Deviation_Part-', CAST(l_partkey % 53 AS STRING), '.pdf')
  WHEN 3 THEN concat('GSA_Parts-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey % 7 AS STRING),
                     '_v2.pdf')
  WHEN 4 THEN concat('DEFENSE_Part_', CAST(l_linenumber AS STRING), '_memo.pdf')
  ELSE concat('mystery_', CAST(l_linenumber AS STRING), '.pdf')
END
"""


def lineitem_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of every shape the part-number parser handles, per line item."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return li.select("l_orderkey", "l_linenumber", F.expr(_LINEITEM_NAME_EXPR).alias("filename"))


LINEITEM_NAMES_SQL = """
SELECT l_orderkey, l_linenumber,
  CASE l_orderkey % 6
    WHEN 0 THEN 'GSA_Class_Deviation_Parts-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey % 53 AS VARCHAR) || '.pdf'
    WHEN 1 THEN 'USAID_RFO_Deviation_Parts-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_suppkey % 53 AS VARCHAR)
                || '-and-' || CAST(l_partkey % 11 AS VARCHAR) || '.PDF'
    WHEN 2 THEN 'DOD_Deviation_Part-' || CAST(l_partkey % 53 AS VARCHAR) || '.pdf'
    WHEN 3 THEN 'GSA_Parts-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey % 7 AS VARCHAR) || '_v2.pdf'
    WHEN 4 THEN 'DEFENSE_Part_' || CAST(l_linenumber AS VARCHAR) || '_memo.pdf'
    ELSE 'mystery_' || CAST(l_linenumber AS VARCHAR) || '.pdf'
  END AS filename
FROM lineitem
"""

PARTS_SQL = f"""
SELECT l_orderkey, l_linenumber, filename, {S.agency_label('filename')} AS agency,
       {S.is_dod('filename')} AS is_dod, {S.parts_from_filename('filename')} AS part_numbers
FROM ({LINEITEM_NAMES_SQL})
"""


def lineitem_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lineitem_names(spark, sf_dir)
    return n.select("*", fields.agency_label("filename").alias("agency"),
                    fields.is_dod("filename").alias("is_dod"),
                    fields.parts_from_filename("filename").alias("part_numbers"))


@query("parts_from_name", f"SELECT l_orderkey, l_linenumber, filename, part_numbers FROM ({PARTS_SQL})")
def parts_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_parts(spark, sf_dir).select("l_orderkey", "l_linenumber", "filename",
                                                "part_numbers")


EXPLODED_SQL = f"""
SELECT l_orderkey, l_linenumber, filename, agency, is_dod,
       unnest(CASE WHEN len(part_numbers) > 0 THEN part_numbers ELSE [-1] END) AS part_number
FROM ({PARTS_SQL})
"""


@query("parts_explode", f"SELECT l_orderkey, l_linenumber, filename, part_number FROM ({EXPLODED_SQL})")
def parts_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.explode_parts(lineitem_parts(spark, sf_dir)).select(
        "l_orderkey", "l_linenumber", "filename", "part_number")


@query("part_list", f"""
SELECT filename,
  min(l_orderkey) AS first_orderkey,
  arg_min(l_linenumber, (l_orderkey, l_linenumber)) AS first_linenumber,
  arg_min(agency, (l_orderkey, l_linenumber)) AS agency,
  arg_min(is_dod, (l_orderkey, l_linenumber)) AS is_dod,
  coalesce(array_to_string(list_sort(list_distinct(list(part_number) FILTER (WHERE part_number >= 0))), ';'), '') AS part_number
FROM ({EXPLODED_SQL})
GROUP BY filename
""")
def part_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per file name: its first line item first, then what the name says, worked out once a name."""
    order = ["l_orderkey", "l_linenumber"]
    first = lineitem_names(spark, sf_dir).groupBy("filename").agg(F.min(F.struct(*order)).alias("f")).select("filename", "f.*")
    named = first.select("*", fields.agency_label("filename").alias("agency"), fields.is_dod("filename").alias("is_dod"),
                         fields.parts_from_filename("filename").alias("part_numbers"))
    return M.part_list(L.explode_parts(named), "filename", order, ["agency", "is_dod"]) \
        .withColumnsRenamed({"l_orderkey": "first_orderkey", "l_linenumber": "first_linenumber"})


def text_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file name per document from its source and its whole text."""
    d = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "text")
    name = F.concat(F.col("source"), F.lit("_"),
                    F.regexp_replace("text", r"[^A-Za-z0-9]+", "_"), F.lit(".pdf"))
    return d.select("doc_id", "lang", name.alias("filename"))


TEXT_NAMES_SQL = """
SELECT doc_id, lang,
  source || '_' || regexp_replace(text, '[^A-Za-z0-9]+', '_', 'g') || '.pdf' AS filename
FROM documents
"""


@query("manifest_profile", f"""
WITH a AS (
  SELECT doc_id, lang, {S.agency_label('filename')} AS agency, {S.is_dod('filename')} AS is_dod
  FROM ({TEXT_NAMES_SQL})
)
SELECT lang, count(*) AS total, count(*) FILTER (WHERE NOT is_dod) AS non_dod,
       coalesce(array_to_string(list_sort(list_distinct(list(agency) FILTER (WHERE NOT is_dod))), ', '), '') AS agencies
FROM a GROUP BY lang
""")
def manifest_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = text_filenames(spark, sf_dir).select(
        "lang", fields.agency_label("filename").alias("agency"),
        fields.is_dod("filename").alias("is_dod"))
    return M.profile(d, ["lang"])


CLEAN_SQL = MS.main_text("pages")


@query("html_clean_text", CLEAN_SQL)
def html_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages", "page_id", "html")
    return p.select("page_id", L.clean_text(F.col("html")).alias("clean_text"))


@query("page_gate", f"""
SELECT page_id, length(clean_text) AS chars FROM ({CLEAN_SQL}) WHERE length(clean_text) >= 500
""")
def page_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with enough clean text for extraction."""
    from ..operators import extract as X

    p = table(spark, sf_dir, "pages", "page_id", "html")
    # a filter on the length and its column would each make the text; a generator's output is made once
    chars = F.explode_outer(F.array(F.length(L.clean_text(F.col("html")))))
    long = p.select("page_id", chars.alias("chars")).where(F.col("chars") >= X.MIN_PAGE_CHARS)
    return long.select("page_id", F.col("chars").cast("bigint").alias("chars"))


@query("fetch_outcomes", """
SELECT page_id, CASE WHEN page_id % 13 = 0 THEN 'Timeout: read' WHEN page_id % 5 = 0 THEN 'HTTP 404'
  WHEN NOT contains(html, '<html') THEN 'not html: text/plain' END AS error FROM pages
""")
def fetch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error class of every page fetch (B10); status and exception go by the page id."""
    from ..operators.report import fetch_outcome

    p = table(spark, sf_dir, "pages", "page_id", "html")
    i = F.col("page_id")
    return p.select("page_id", fetch_outcome(
        F.when(i % 5 == 0, F.lit(404)).otherwise(F.lit(200)),
        F.when(F.col("html").contains("<html"), F.lit("text/html; charset=utf-8")).otherwise(F.lit("text/plain")),
        F.when(i % 13 == 0, F.lit("Timeout: read"))).alias("error"))
