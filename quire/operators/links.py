"""Link extraction from landed HTML.

Pages arrive as a table ``(page key, url, html)``; every operator here is a
per-row generator (``posexplode`` of regex matches) or a keyed window, so work
splits by page and never gathers a page set on one task.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fields, urls
from ..functions.text import _c, blank_to_null, strip, without
from . import markup

# Fixed values that must equal the reference's patterns.
PART_LINK_RE = r"/far-overhaul/far-part-deviation-guide/far-overhaul-part-(\d+)$"
PDF_LINK_RE = r"(?i)/sites/default/files/page_file_uploads/.*\.pdf$"
ISSUANCE_RE = r"(?i)Issuance Date:\s*([A-Z][a-z]+\s+\d{1,2},?\s*\d{4})"
UPDATE_RE = r"(?i)UPDATE:\s*([A-Z][a-z]+\s+\d{1,2},?\s*\d{4})"

# an anchor's start tag, and its href value: double-quoted, single-quoted or bare
ANCHOR_TAG_RE = r"(?i)(<a\s[^>]*>)"
HREF_RE = r'(?is)^<a(?:\s[^>]*?)?\shref\s*=\s*(?:"([^"]*)"|\'([^\']*)\'|([^\s"\'>]+))'
AFTER_ANCHOR_RE = r"(?is)</a\s*>.*"
# comments and scripts hold no links
HIDDEN_RE = r"(?is)<!--.*?-->|<script\b.*?</script>"
SENTINEL = "\u0001"

ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
            ("&#39;", "'"), ("&amp;", "&"))


def decode_entities(x) -> Column:
    c = _c(x)
    for ent, ch in ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def tag_text(fragment) -> Column:
    """Visible text of an HTML fragment: tags -> space, entities decoded,
    whitespace runs collapsed, stripped (``get_text(' ', strip=True)``-like)."""
    t = F.regexp_replace(_c(fragment), r"<[^>]*>", " ")
    t = decode_entities(t)
    return strip(F.regexp_replace(t, r"\s+", " "))


def visible(html) -> Column:
    """HTML without comments and scripts."""
    return F.regexp_replace(_c(html), HIDDEN_RE, "")


def href_of(anchor) -> Column:
    """The href of an anchor's start tag, entities decoded; NULL without one.  An
    attribute written without quotes or in single quotes counts like any other."""
    groups = [F.regexp_extract(anchor, HREF_RE, i) for i in (1, 2, 3)]
    return F.when(_c(anchor).rlike(HREF_RE), decode_entities(F.concat(*groups)))


def anchors(html) -> Column:
    """array<string> of the anchors with an href in document order: start tag and
    content.  The page is marked once before every start tag and cut there, so an anchor
    without an end tag ends where the next one starts."""
    marked = F.regexp_replace(without(html, SENTINEL), ANCHOR_TAG_RE, SENTINEL + "$1")
    pieces = F.slice(F.split(marked, SENTINEL), 2, 1 << 30)
    return F.transform(F.filter(pieces, lambda a: a.rlike(HREF_RE)),
                       lambda a: F.regexp_replace(a, AFTER_ANCHOR_RE, ""))


def extract_links(pages: DataFrame, key: str = "page_id", html: str = "html",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``<a href>`` in document order: key, pos, href, anchor_text."""
    out = pages.select(key, *keep, F.posexplode(anchors(visible(html))).alias("pos", "a"))
    return out.select(key, *keep, "pos", href_of("a").alias("href"), tag_text("a").alias("anchor_text"))


def first_per(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per ``keys`` by ``order`` (document order).

    Planned as Window + WindowGroupLimit, so each partition keeps one row per
    key before the sort of the rest.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def part_headings(guide: DataFrame, key: str = "page_id", html: str = "html",
                  base_col: str = "base") -> DataFrame:
    """Part overview links with the dates of the heading around them.

    Output: key, part_number, overview_url, issued, updated, title_hint; the
    first link per (key, part_number) in document order wins.  A heading counts if it
    is one of the link's three nearest ancestors (see :func:`markup.ancestor_links`).
    """
    links = markup.ancestor_links(
        guide, [key, base_col], html, lambda tag: urls.strip_query_fragment(href_of(tag)),
        lambda href: href.rlike(PART_LINK_RE))
    parts = links.select(key, "pos", "href", base_col, "anchor", tag_text("heading").alias("htxt"))
    parts = parts.select(
        key, "pos",
        F.regexp_extract("href", PART_LINK_RE, 1).try_cast("int").alias("part_number"),
        urls.resolve(F.col("href"), F.col(base_col)).alias("overview_url"),
        blank_to_null(F.regexp_extract("htxt", "(?U)" + ISSUANCE_RE, 1)).alias("issued"),
        blank_to_null(F.regexp_extract("htxt", "(?U)" + UPDATE_RE, 1)).alias("updated"),
        tag_text("anchor").alias("title_hint"))
    parts = parts.where(F.col("part_number").isNotNull())
    return first_per(parts, [key, "part_number"], ["pos"]).drop("pos")


def link_manifest(links: DataFrame, base: Column, key: str = "page_id",
                  pattern: str = PDF_LINK_RE) -> DataFrame:
    """Document links of each page: query stripped, first per href, resolved
    against ``base``, then name-derived fields (agency, DoD flag, parts).

    ``links`` comes from :func:`extract_links` (needs ``key, pos, href`` and the
    columns used in ``base``).
    """
    return document_links(links, base, key, pattern, first=True)


def document_links(links: DataFrame, base: Column, key: str = "page_id", pattern: str = PDF_LINK_RE,
                   first: bool = False) -> DataFrame:
    """:func:`link_manifest` with every occurrence of a link (or the ``first`` per page and href); without a window, so
    ``links`` may be a stream."""
    l1 = links.withColumn("href", urls.strip_query(F.col("href")))
    l1 = l1.where(F.col("href").rlike(pattern))
    if first:
        l1 = first_per(l1, [key, "href"], ["pos"])
    fname = urls.basename(F.col("href"))
    return l1.select(
        key, "pos",
        urls.resolve(F.col("href"), base).alias("pdf_url"),
        fname.alias("filename"),
    ).select("*",
             fields.agency_label("filename").alias("agency"),
             fields.is_dod("filename").alias("is_dod"),
             fields.parts_from_filename("filename").alias("part_numbers"))


def explode_parts(df: DataFrame, col: str = "part_numbers") -> DataFrame:
    """One row per part number; -1 when the list is empty."""
    arr = F.when(F.size(col) > 0, F.col(col)).otherwise(F.array(F.lit(-1)))
    return df.select(*[c for c in df.columns if c != col],
                     F.explode(arr).alias("part_number"))


def top_links(links: DataFrame, key: str = "page_id", n: int = 5) -> DataFrame:
    """First ``n`` links per page by position (``follow_links[:5]``)."""
    return links.where(F.col("pos") < n)


def clean_text(html) -> Column:
    """Main text of a page, links kept with their targets (H21, see :func:`markup.main_text`)."""
    return markup.main_text(html, href_of, decode_entities)
