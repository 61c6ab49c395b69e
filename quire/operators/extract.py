"""Text assembly and field extraction (A2, A4, B3, B4, B11, B12, B13, C1, C8,
D9, E7, H18, H19).

Model output and page text arrive as tables; every step is a column
expression, an equi-join on the document key or a bounded aggregate.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fields
from ..functions.text import _c, first_truthy, truncate

MIN_TEXT_CHARS = 200
MIN_PAGE_CHARS = 500
MODEL_INPUT_CHARS = 20000


def text_gate(df: DataFrame, text: str = "text", min_chars: int = MIN_TEXT_CHARS) -> DataFrame:
    """Drop texts shorter than ``min_chars`` (200 for a PDF's text, ``MIN_PAGE_CHARS``
    for the clean text of a web page, B4)."""
    return df.where(F.length(text) >= min_chars)


def model_input(text: Column, max_chars: int = MODEL_INPUT_CHARS) -> Column:
    """What a model gets of a text (B11): its first ``max_chars`` code points."""
    return truncate(text, max_chars)


def assemble_text(pages: DataFrame, doc: str, page_no: str, text: str,
                  max_pages: int | None = None, sep: str = "\n") -> DataFrame:
    """One text per document from its pages in page order.

    A document's text is one value, so its pages meet in one row.  With
    ``max_pages`` the first pages are chosen by a row_number window whose
    limit Spark applies per map partition before the shuffle, so a document
    with very many pages sends at most ``max_pages`` rows per partition.
    Unreadable pages (NULL text) are skipped like the reference skips them.
    """
    p = pages.where(F.col(text).isNotNull())
    if max_pages is not None:
        w = Window.partitionBy(doc).orderBy(page_no)
        p = p.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_pages)
    g = p.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct(page_no, text))).alias("_pg"),
                           F.count(F.lit(1)).alias("n_pages"))
    return g.select(doc, "n_pages",
                    F.array_join(F.transform("_pg", lambda x: x[text]), sep).alias(text))


# Fields that every element of a model's answer must have as strings; one that
# lacks any makes the whole answer invalid.
REQUIRED_FIELDS = ("agency", "deviation_number", "title")
OPTIONAL_FIELDS = ("effective_date", "scope", "link")


def parse_model_deviation(resp) -> Column:
    """First deviation of a model response (JSON text) as a struct, NULL when the
    response is not valid JSON, lists none, or any listed element is invalid: lacks
    a required string or has an optional field that is neither a string nor null
    (E7, H19, C8)."""
    v = F.try_parse_json(_c(resp))
    listed = F.try_variant_get(v, "$.deviations", "array<variant>")

    def kind(x, name):
        return F.schema_of_variant(F.try_variant_get(x, f"$.{name}", "variant"))

    def valid(x):
        ok = F.schema_of_variant(x).startswith("OBJECT")
        for name in REQUIRED_FIELDS:
            ok = ok & (kind(x, name) == "STRING")
        for name in OPTIONAL_FIELDS:
            ok = ok & F.coalesce(kind(x, name).isin("STRING", "VOID"), F.lit(True))
        return F.coalesce(ok, F.lit(False))

    first = F.get(listed, 0)
    fields_ = [F.try_variant_get(first, f"$.{n}", "string").alias(n)
               for n in ("agency", "deviation_number", "title", "effective_date", "scope", "link")]
    return F.when((F.size(listed) > 0) & F.forall(listed, valid), F.struct(*fields_))


def merge_fields(docs: DataFrame, model: DataFrame | None, key: str = "pdf_url",
                 take_model_date: bool = True, carry: tuple[str, ...] = (),
                 title_fallback_when_blank: bool = False, drop_dod: bool = True,
                 take_model_number: bool = False) -> DataFrame:
    """Regex fields first, model fields second.

    ``docs``: key, agency, filename, text.  ``model``: key, response (JSON
    text) or None when no model ran (the fallback title is then used).
    Output rows: id, agency, deviation_number, title, effective_date, scope,
    link.  The full run drops rows whose model answer names DoD (``drop_dod``)
    and takes the model's date when the regexes found none
    (``take_model_date``); the incremental run does neither, and falls back to
    the file-name title for any blank model title
    (``title_fallback_when_blank``).  The retry run also takes the model's number
    where the regexes and the file name gave none (``take_model_number``).
    """
    d = text_gate(docs).select(
        key, "agency", "filename", *carry,
        fields.effective_date("text").alias("rx_date"),
        fields.deviation_number("text", "filename").alias("rx_num"))
    if model is not None:
        m = model.select(key, parse_model_deviation(F.col("response")).alias("m"))
        d = d.join(m, key, "left")
    else:
        d = d.withColumn("m", F.lit(None).cast(
            "struct<agency:string,deviation_number:string,title:string,effective_date:string,"
            "scope:string,link:string>"))
    has_model = F.col("m").isNotNull()
    eff = F.col("rx_date")
    if take_model_date:
        eff = F.when(first_truthy(eff).isNull() & has_model, F.col("m.effective_date")).otherwise(eff)
    fallback = fields.title_from_filename(F.col("filename"))
    if title_fallback_when_blank:
        # incremental path: any falsy model title falls back to the file name
        title = F.coalesce(first_truthy(F.col("m.title")), fallback)
    else:
        # full run: the file-name title only when the model gave no row
        title = F.when(has_model, F.col("m.title")).otherwise(fallback)
    number = F.col("rx_num")
    if take_model_number:
        number = F.coalesce(first_truthy(number, F.col("m.deviation_number")), number)
    out = d.where(~(has_model & fields.is_dod_agency(F.col("m.agency")))) if drop_dod else d
    return out.select(
        fields.deviation_id(F.col("agency"), number, F.col("filename")).alias("id"),
        "agency", number.alias("deviation_number"), title.alias("title"),
        eff.alias("effective_date"), F.col("m.scope").alias("scope"), F.col(key).alias("link"),
        "filename", *carry)


def json_fields(text, names: list[str]) -> Column:
    """Fields of the first ``{...}`` span of free text (greedy, DOTALL) as a
    struct of strings; '' for missing fields and for unparsable spans (H18)."""
    v = F.try_parse_json(fields.first_json_object(text))
    ok = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    return F.struct(*[
        F.when(ok, F.coalesce(F.try_variant_get(v, f"$.{n}", "string"), F.lit(""))).otherwise(F.lit(""))
        .alias(n) for n in names])


def validate(df: DataFrame, resp: str, required: dict[str, str],
             optional: dict[str, str] | None = None, observation=None) -> DataFrame:
    """Rows whose response is a JSON object carrying every required field with
    a value of the declared type; invalid responses yield no row (H19).

    With a ``pyspark.sql.Observation`` the accepted / rejected counts of the run
    (D10) can be read from it after an action."""
    v = F.try_parse_json(F.col(resp))
    cols = {n: F.try_variant_get(v, f"$.{n}", t) for n, t in required.items()}
    for n, t in (optional or {}).items():
        cols[n] = F.try_variant_get(v, f"$.{n}", t)
    ok = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    for n in required:
        ok = ok & cols[n].isNotNull()
    keep = [c for c in df.columns if c != resp]
    checked = df.select(*keep, *[c.alias(n) for n, c in cols.items()], ok.alias("_ok"))
    if observation is not None:
        checked = checked.observe(observation, F.count_if("_ok").alias("accepted"),
                                  F.count_if(~F.col("_ok")).alias("rejected"))
    return checked.where("_ok").drop("_ok")


def cache_resolve(fresh: DataFrame, cache: DataFrame, use_cache: bool) -> DataFrame:
    """Cache-first page resolution.

    ``fresh``: url, html, error (one row per requested URL, the fetch
    outcome).  ``cache``: url_hash, html.  With ``use_cache`` a cached copy
    wins; otherwise the fresh fetch decides.  Output: url, html, error.
    """
    from ..functions.urls import url_hash

    if not use_cache:
        return fresh.select("url", "html", "error")
    f = fresh.withColumn("url_hash", url_hash(F.col("url")))
    c = cache.select("url_hash", F.col("html").alias("cached"))
    j = f.join(c, "url_hash", "left")
    hit = F.col("cached").isNotNull()
    return j.select("url", F.when(hit, F.col("cached")).otherwise(F.col("html")).alias("html"),
                    F.when(hit, F.lit(None).cast("string")).otherwise(F.col("error")).alias("error"))
