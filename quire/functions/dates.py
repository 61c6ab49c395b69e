"""Free-text effective-date normaliser as one column expression.

``with_normalized_date(df, raw_col)`` adds ``effective_date_iso`` (date) and
``effective_date_kind``; rules are tried in order and the first that applies
wins:

1. NULL or blank                                -> (NULL, 'empty')
2. ``YYYY-MM-DD``, ``YYYY.MM.DD``, ``M/D/YYYY`` (whole string, padded by
   whitespace)                                  -> (date, 'iso')
3. ``Month D, YYYY`` anywhere (comma required)  -> (date, 'long')
4. starts with 'immediate' / 'effective upon'   -> (NULL, 'immediate')
5. mentions an issuance / release phrase        -> (NULL, 'issuance')
6. mentions 'days from' / 'days after'          -> (NULL, 'delta')
7. otherwise                                    -> (NULL, 'unparsed')

A rule whose pattern matches but whose date does not exist (``2025-13-40``,
``February 30, 2025``) falls through to the next rules, so it ends as
'unparsed' with a NULL date instead of aborting the run.  Years are limited
to 0001-9999.
"""
from __future__ import annotations

from pyspark.sql import functions as F

# Fixed values that must equal the reference's rules.
MONTHS = ("january", "february", "march", "april", "may", "june", "july",
          "august", "september", "october", "november", "december")
ISO_RE = r"^(\d{4})-(\d{2})-(\d{2})$"
DOTTED_RE = r"^(\d{4})\.(\d{2})\.(\d{2})$"
US_SLASH_RE = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
LONG_RE = (r"(?i)\b(January|February|March|April|May|June|July|August|September"
           r"|October|November|December)\s+(\d{1,2}),\s*(\d{4})\b")
IMMEDIATE_PREFIXES = ("immediate", "effective upon")
ISSUANCE_PHRASES = ("date of issuance", "document dated", "model language release",
                    "model text release")
DELTA_PHRASES = ("days from", "days after")

KINDS = ("empty", "iso", "long", "immediate", "issuance", "delta", "unparsed")


def _lit(v: str) -> str:
    """Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _any(fn: str, col: str, phrases) -> str:
    return "(" + " OR ".join(f"{fn}({col}, {_lit(p)})" for p in phrases) + ")"


_MONTHS_SQL = "array(" + ", ".join(_lit(m) for m in MONTHS) + ")"
_STAGE2 = {
    "_low": "lower(_s)",
    "_iso": (
        f"coalesce("
        f"CASE WHEN _s RLIKE {_lit(ISO_RE)} AND try_cast(substr(_s, 1, 4) AS INT) >= 1 "
        f"THEN try_to_date(_s, 'yyyy-MM-dd') END, "
        f"CASE WHEN _s RLIKE {_lit(DOTTED_RE)} AND try_cast(substr(_s, 1, 4) AS INT) >= 1 "
        f"THEN try_to_date(_s, 'yyyy.MM.dd') END, "
        f"CASE WHEN _s RLIKE {_lit(US_SLASH_RE)} AND try_cast(substring_index(_s, '/', -1) AS INT) >= 1 "
        f"THEN try_to_date(_s, 'M/d/yyyy') END)"),
    "_mon": f"array_position({_MONTHS_SQL}, lower(regexp_extract(_s, {_lit("(?U)" + LONG_RE)}, 1)))",
    "_ly": f"regexp_extract(_s, {_lit("(?U)" + LONG_RE)}, 3)",
    "_ld": f"regexp_extract(_s, {_lit("(?U)" + LONG_RE)}, 2)",
}
_LONG = ("CASE WHEN _mon > 0 AND try_cast(_ly AS INT) >= 1 "
         "THEN try_to_date(concat_ws('-', _ly, CAST(_mon AS STRING), _ld), 'yyyy-M-d') END")


def with_normalized_date(df, raw_col: str = "effective_date",
                         iso_col: str = "effective_date_iso",
                         kind_col: str = "effective_date_kind"):
    """Add (or recompute) the ISO date and kind columns next to ``raw_col``.

    Built as staged projections: each intermediate is computed once per row
    (Catalyst keeps non-trivial shared subexpressions in their own Project
    instead of inlining them into every branch of the CASE chain).  Each
    stage is handed to the JVM as SQL expressions in one call.
    """
    raw = f"`{raw_col}`"
    keep = [c for c in df.columns if c not in (iso_col, kind_col)]
    df = df.withColumn("_s", F.expr(f"regexp_replace({raw}, {_lit(r'(?U)^\s+|\s+$')}, '')"))
    df = df.withColumns({k: F.expr(v) for k, v in _STAGE2.items()})
    df = df.withColumn("_long", F.expr(_LONG))
    kind = (f"CASE WHEN {raw} IS NULL OR _s = '' THEN 'empty' "
            f"WHEN _iso IS NOT NULL THEN 'iso' WHEN _long IS NOT NULL THEN 'long' "
            f"WHEN {_any('startswith', '_low', IMMEDIATE_PREFIXES)} THEN 'immediate' "
            f"WHEN {_any('contains', '_low', ISSUANCE_PHRASES)} THEN 'issuance' "
            f"WHEN {_any('contains', '_low', DELTA_PHRASES)} THEN 'delta' "
            f"ELSE 'unparsed' END")
    df = df.withColumn(kind_col, F.expr(kind))
    iso = (f"CASE `{kind_col}` WHEN 'iso' THEN _iso WHEN 'long' THEN _long "
           f"ELSE CAST(NULL AS DATE) END")
    return df.select(*keep, F.expr(iso).alias(iso_col), kind_col)
