"""Sections of documents that do not fit a row: segmentation on page rows.

A document is many rows (document, page number, text); its text is the pages joined by a line feed.  A page's own
headings are found in the page.  What crosses a page boundary is carried:

- a heading whose number ends one page and whose title begins the next (blank pages between them or not);
- a page whose first line is taken as the title of such a heading, so that it starts no section of its own;
- the section that is open when a page begins.

Whether a number is pending at the end of a page depends on whether one was at its beginning: every page is a
function of that one bit, constant, identity or negation, and the bit at a page is the composition of the pages before.
Compositions, counts of sections and the next page's beginning come from windows over runs of ``RUN`` pages,
and over one row a run, so no task sees all pages of a document, and texts are shuffled once, by page.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip, without
from ..session import written
from .sections import SECTION_RE

#: Pages that one window sees.
RUN = 1000
_OPEN, _CLOSE, _GUARD = "\u0001", "\u0003", "\u0002"
_HEADING = "(?md)" + SECTION_RE
_NUMBER = SECTION_RE.split(")", 1)[0].lstrip("^") + ")"
_TAIL = "(?md)^" + _NUMBER + r"\s*\z"
_TITLE = r"(?d)^0\n\s*([^.\n]+?)\."  # what follows a pending number


def _scan(text: Column) -> Column:
    """The text with a mark before and one after each heading of its own."""
    return F.regexp_replace(text, _HEADING, _OPEN + "$0" + _CLOSE)


def _tail(scanned: Column) -> Column:
    """The number that ends a scanned page, on a line of its own and not part of a heading; empty without one."""
    return F.regexp_extract(scanned, _TAIL, 1)


def _before(rows: DataFrame, keys: list[str], order: str, const: str, flips: str, out: str) -> DataFrame:
    """``out``: what the functions of the rows before make of an open argument, as a struct (known, bit, odd).

    A row is a constant (``const`` not NULL) or identity or negation (``flips`` 0 or 1).  ``bit`` if the result is known, else
    the argument negated if ``odd``."""
    w = Window.partitionBy(*keys).orderBy(order)
    upto, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_flips", F.sum(flips).over(upto))
    last = F.last(F.when(F.col(const).isNotNull(), F.struct(F.col(const).alias("bit"), F.col("_flips").alias("at"))), ignorenulls=True).over(ahead)
    rows = rows.withColumn("_last", last).withColumn("_seen", F.coalesce(F.max("_flips").over(ahead), F.lit(0)))
    odd = (F.col("_seen") - F.coalesce("_last.at", F.lit(0))) % 2 == 1
    return rows.withColumn(out, F.struct(F.col("_last").isNotNull().alias("known"), (F.col("_last.bit") != odd).alias("bit"), odd.alias("odd"))).drop(
        "_flips", "_last", "_seen")


def _applied(f: Column, argument: Column) -> Column:
    return F.when(f["known"], f["bit"]).otherwise(argument != f["odd"])


def page_facts(pages: DataFrame, doc: str, page_no: str, text: str) -> DataFrame:
    """What a page tells about its boundaries, without its text: doc, page_no, run, blank, title, tails and counts.

    ``title`` and ``taken``: the title that the page's beginning gives a pending number, and how many characters that
    takes.  ``tail0``, ``own0``: the number pending at its end and its own headings if none was pending before;
    ``tail1``, ``own1``: if the beginning was taken as a title.
    """
    t = without(text, _OPEN + _CLOSE + _GUARD)
    opening = pages.select(doc, page_no, t.alias("_t"), F.regexp_extract(F.concat(F.lit("0\n"), t), _TITLE, 0).alias("_begin"))
    taken = F.greatest(F.length("_begin") - 2, F.lit(0))
    scanned = opening.select(doc, page_no, taken.alias("taken"), F.regexp_extract("_begin", _TITLE, 1).alias("title"),
                             (strip(F.col("_t")) == "").alias("blank"), _scan(F.col("_t")).alias("_s0"),
                             _scan(F.concat(F.lit(_GUARD), F.substring(F.col("_t"), taken + 1, F.length("_t")))).alias("_s1"))
    own = lambda s: F.size(F.split(s, _OPEN)) - 1
    return scanned.select(doc, page_no, F.floor(F.col(page_no) / RUN).alias("run"), "blank", "taken", F.when(F.col("taken") > 0, strip("title")).alias("title"),
                          _tail(F.col("_s0")).alias("tail0"), own("_s0").alias("own0"),
                          F.when(F.col("taken") > 0, _tail(F.col("_s1"))).alias("tail1"), F.when(F.col("taken") > 0, own("_s1")).alias("own1"))


def page_states(facts: DataFrame, doc: str, page_no: str) -> DataFrame:
    """Every page with what reaches it from others: doc, page_no, taken (0 unless a title is taken), more (whether a page follows), pending (the number that
    ends the page as the start of a section, or NULL), its title, and ``first``: how many sections begin before the page."""
    after0, after1 = F.col("tail0") != "", F.coalesce(F.col("tail1"), F.col("tail0")) != ""
    const = F.when(~F.col("blank") & (after0 == after1), after0)
    rows = facts.withColumn("_const", const).withColumn("_flip", F.when(~F.col("blank") & after0 & ~after1, 1).otherwise(0))
    opens = F.when(~F.col("blank"), F.struct((F.col("taken") > 0).alias("opens"), "title"))
    rows = _before(rows.withColumn("_opens", opens), [doc, "run"], page_no, "_const", "_flip", "_f")
    ahead = Window.partitionBy(doc, "run").orderBy(page_no).rowsBetween(1, Window.unboundedFollowing)
    rows = rows.withColumn("_next", F.first("_opens", ignorenulls=True).over(ahead)).withColumn("_more", F.count(page_no).over(ahead) > 0)
    # one row a run: the function of the whole run, and the first page in it that is not blank
    end = F.max(F.struct(page_no, F.struct((F.col("_const").isNotNull() | F.col("_f.known")).alias("known"),
                                          F.coalesce("_const", F.col("_f.bit") != (F.col("_flip") == 1)).alias("bit"),
                                          (F.col("_f.odd") != (F.col("_flip") == 1)).alias("odd")).alias("f")))
    runs = rows.groupBy(doc, "run").agg(end.alias("_e"), F.min(F.when(~F.col("blank"), F.struct(page_no, "_opens"))).alias("_o"))
    runs = runs.select(doc, "run", F.when(F.col("_e.f.known"), F.col("_e.f.bit")).alias("_const"),
                       F.when(F.col("_e.f.odd"), 1).otherwise(0).alias("_flip"), F.col("_o._opens").alias("_opens"))
    runs = _before(runs, [doc], "run", "_const", "_flip", "_g")
    later = Window.partitionBy(doc).orderBy("run").rowsBetween(1, Window.unboundedFollowing)
    runs = runs.select(doc, "run", _applied(F.col("_g"), F.lit(False)).alias("_in"), F.first("_opens", ignorenulls=True).over(later).alias("_later"),
                       (F.count("run").over(later) > 0).alias("_after"))
    rows = rows.join(runs, [doc, "run"])
    carried = _applied(F.col("_f"), F.col("_in"))
    used = ~F.col("blank") & carried & (F.col("taken") > 0)
    rows = rows.withColumn("_used", used).withColumn("_next", F.coalesce("_next", "_later"))
    tail = F.when(F.col("_used"), F.col("tail1")).otherwise(F.col("tail0"))
    confirmed = (tail != "") & ~F.col("blank") & F.coalesce(F.col("_next.opens"), F.lit(False))
    rows = rows.select(doc, page_no, "run", F.when(F.col("_used"), F.col("taken")).otherwise(0).alias("taken"),
                       (F.col("_more") | F.col("_after")).alias("more"), F.when(confirmed, tail).alias("pending"), F.when(confirmed, F.col("_next.title")).alias("pending_title"),
                       (F.when(F.col("_used"), F.col("own1")).otherwise(F.col("own0")) + confirmed.cast("int")).alias("_n"))
    counts = rows.groupBy(doc, "run").agg(F.sum("_n").alias("_n"))
    earlier = Window.partitionBy(doc).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(doc, "run", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(doc, "run").orderBy(page_no).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_own", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return rows.join(counts, [doc, "run"]).select(doc, page_no, "taken", "more", "pending", "pending_title", (F.col("_base") + F.col("_own")).alias("first"))


def segment_pages(pages: DataFrame, doc: str = "doc_id", page_no: str = "page_no", text: str = "text") -> DataFrame:
    """Sections of paged documents in bounded chunks: doc, pos, page_no, number, title, chunk.

    ``pages``: one row per page, page numbers distinct within a document; pages with NULL text are skipped.  ``pos``: the section's
    place in the document; a section has one chunk for every page that it reaches into, which joined in page order are its
    text.  ``number`` and ``title`` stand in the section's first chunk, NULL in the others.  Text before the first heading is
    left out.  Equal to splitting the joined text at once (tested).
    """
    p = pages.where(F.col(text).isNotNull()).select(doc, page_no, text)
    # written, because several windows and groups read them; the texts are searched once for it
    states = page_states(written(page_facts(p, doc, page_no, text), "page-facts"), doc, page_no)
    rows = p.join(states, [doc, page_no])
    rows = rows.withColumn("_t", without(text, _OPEN + _CLOSE + _GUARD))
    t = F.col("_t")
    rest = F.when(F.col("taken") > 0, F.concat(F.lit(_GUARD), F.substring(t, F.col("taken") + 1, F.length(t)))).otherwise(t)
    marked = rows.select(doc, page_no, "pending", "pending_title", "first", F.substring(t, F.lit(1), F.col("taken")).alias("_prefix"), _scan(rest).alias("_s"),
                         F.when(F.col("more"), "\n").otherwise("").alias("_feed"))
    cut = F.when(F.col("pending").isNotNull(), F.regexp_replace("_s", _TAIL, _OPEN + "$0")).otherwise(F.col("_s"))
    whole = F.concat("_prefix", without(cut, _CLOSE + _GUARD), "_feed")
    pieces = marked.select(doc, page_no, "pending", "pending_title", "first", F.split(whole, _OPEN).alias("_p"))
    out = pieces.select(doc, page_no, "pending", "pending_title", "first", F.size("_p").alias("_n"), F.posexplode("_p").alias("_i", "chunk"))
    straddles = F.col("pending").isNotNull() & (F.col("_i") == F.col("_n") - 1)
    own = F.col("_i") > 0
    head = lambda g: F.regexp_extract("chunk", _HEADING, g)
    return out.where((F.col("first") + F.col("_i") > 0) & (own | (F.col("chunk") != ""))).select(
        doc, (F.col("first") + F.col("_i") - 1).alias("pos"), page_no,
        F.when(own, F.when(straddles, F.col("pending")).otherwise(head(1))).alias("number"),
        F.when(own, F.when(straddles, F.col("pending_title")).otherwise(strip(head(2)))).alias("title"), "chunk")


def paged_headings(sections: DataFrame, doc: str = "doc_id", first_only: bool = False) -> DataFrame:
    """One row per section of ``segment_pages``: doc, pos, number, title; ``first_only``: the first of each number."""
    heads = sections.where(F.col("number").isNotNull()).select(doc, "pos", "number", "title")
    if not first_only:
        return heads
    best = heads.groupBy(doc, "number").agg(F.min(F.struct("pos", "title")).alias("b"))
    return best.select(doc, F.col("b.pos").alias("pos"), "number", F.col("b.title").alias("title"))
