"""Numbered-section segmentation of long documents.

A heading is a line starting ``52.<n>-<m>`` followed by a title that ends at
the first period.  Sections run from one heading to the next (or the end of
the text); text before the first heading is dropped.

Spark has no regex "finditer with offsets", so the split is done by marking
every heading match with a sentinel character and splitting on it: the
regex engine scans left to right without overlap exactly like ``finditer``
(so ``52.1-1\\n52.2-2 Foo.`` is one heading whose title is ``52``).
Everything is per-row column work; documents are never grouped.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, capitalize, strip, without

# Fixed values that must equal the reference's patterns.
SECTION_RE = r"^(52\.\d+-\d+)\s+([^.\n]+?)\."
DATE_RE = r"\(([A-Z][a-z]{2,9}\.?\s+\d{4}|[A-Z]{3,9}\s+\d{4})\)"
KIND_RE = r"(?i)insert the following (provision|clause)"
END_MARKER_RE = r"(?i)\(End of (provision|clause|solicitation provision)\)"
KIND_WINDOW = 600
DATE_WINDOW = 1500

SENTINEL = "\u0001"


def split_sections(text) -> Column:
    """array<string> of sections (text before the first heading removed).

    The sentinel character itself is removed from the text first, so it can
    only stand before headings."""
    clean = without(text, SENTINEL)
    marked = F.regexp_replace(clean, "(?md)" + SECTION_RE, SENTINEL + "$0")
    parts = F.split(marked, SENTINEL)
    return F.slice(parts, 2, 1 << 30)


def segment(df: DataFrame, text: str = "text", keep: tuple[str, ...] = (),
            first_only: bool = False) -> DataFrame:
    """One row per section: keep..., pos (0-based, document order), number,
    title, section.

    ``first_only`` keeps the first section per number within each document
    (E1).  Sections of one document live in one row: sorted by (number, pos),
    the first of each run of a number stays (no shuffle, no window).
    """
    df = df.select(*keep, split_sections(F.col(text)).alias("_secs"))
    if first_only:
        numbered = F.transform("_secs", lambda x, i: F.struct(
            F.regexp_extract(x, r"^(52\.\d+-\d+)", 1).alias("number"), i.alias("pos")))
        # sorted once, as a column of its own: the filter below reads it by place
        df = df.select(*keep, "_secs", F.explode(F.array(F.array_sort(numbered))).alias("_nums"))
        before = F.concat(F.array(F.lit(None).cast("struct<number:string,pos:int>")), F.col("_nums"))
        runs = F.filter(F.arrays_zip(F.col("_nums").alias("cur"), before.alias("prev")),
                        lambda z: z["cur"].isNotNull() & (z["prev"].isNull() | (z["prev"]["number"] != z["cur"]["number"])))
        items = F.transform(runs, lambda z: F.struct(
            z["cur"]["pos"].alias("pos"), F.element_at("_secs", z["cur"]["pos"] + 1).alias("section")))
    else:
        items = F.transform("_secs", lambda x, i: F.struct(i.alias("pos"), x.alias("section")))
    out = df.select(*keep, F.explode(items).alias("z"))
    head = F.col("z.section")
    return out.select(
        *keep, F.col("z.pos").alias("pos"),
        F.regexp_extract(head, r"^(52\.\d+-\d+)", 1).alias("number"),
        strip(F.regexp_extract(head, SECTION_RE, 2)).alias("title"),
        head.alias("section"))


def clause_fields(sections: DataFrame, kind_window: int = KIND_WINDOW,
                  date_window: int = DATE_WINDOW) -> DataFrame:
    """Adds kind, effective_date and full_text (body cut after the end marker).

    The prescribing phrase counts within a section's first ``kind_window``
    characters and the revision date within its first ``date_window``."""
    s, marker = F.col("section"), F.col("_marker")
    # the section is searched once for its first end marker; the body ends where that text stands first
    marked = sections.withColumn("_marker", F.regexp_extract("section", END_MARKER_RE, 0))
    end_word = F.regexp_extract(marker, END_MARKER_RE, 1)
    kind_word = F.regexp_extract(F.substring(s, 1, kind_window), KIND_RE, 1)
    kind = (F.when(kind_word != "", capitalize(kind_word))
            .when(end_word == "solicitation provision", F.lit("Provision"))
            .when(end_word != "", capitalize(end_word))
            .otherwise(F.lit("Unknown")))
    body = F.substring(s, F.lit(1), F.instr(s, marker) + F.length(marker) - 1)
    full = strip(F.when(marker != "", body).otherwise(s))
    eff = blank_to_null(F.regexp_extract(F.substring(s, 1, date_window), DATE_RE, 1))
    return marked.select(*[c for c in sections.columns if c != "section"],
                         kind.alias("kind"), eff.alias("effective_date"),
                         full.alias("full_text"))
