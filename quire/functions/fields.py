"""Field extraction from document text and file names.

Every function returns a native Column; nothing runs in Python per row.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, blank_to_null, first_truthy, strip

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's rules (patterns, key order).
# ---------------------------------------------------------------------------

# Effective-date patterns, tried in priority order over the whole text.
EFFECTIVE_PATTERNS = (
    r"(?i)effective\s+date[:\s]+([A-Za-z]+ \d{1,2},? \d{4})",
    r"(?i)effective\s+(?:on\s+)?([A-Za-z]+ \d{1,2},? \d{4})",
    r"(?i)effective[:\s]+(\d{1,2}/\d{1,2}/\d{2,4})",
    r"(?i)effective\s+(?:on\s+)?(\d{4}-\d{2}-\d{2})",
)

# Deviation-number patterns, tried in priority order; file name is the fallback.
DEVIATION_NUM_PATTERNS = (
    r"(?i)(?:Class\s+Deviation|CD)[\s#:]*([A-Z]{2,}-\d{4}-\d+[A-Z\-]*)",
    r"(?i)Class\s+Deviation\s*\(?\s*Number\s+(\d{2,4}-\d+)\)?",
    r"(?i)Class\s+Deviation\s+(\d{2,4}-\d+)",
    r"(?i)Deviation\s+(?:No\.?|Number)[\s:]*([A-Z0-9\-/]+)",
)

# Agency label by upper-case name fragment; first key contained in the
# normalised file name wins, in this order.
AGENCY_MAP = (
    ("USAID", "USAID"),
    ("PEACE_CORPS", "Peace Corps"),
    ("PEACECORPS", "Peace Corps"),
    ("PC_RFO", "Peace Corps"),
    ("TREASURY", "Treasury"),
    ("OSHRC", "OSHRC"),
    ("MSPB", "MSPB"),
    ("PBGC", "PBGC"),
    ("NARA", "NARA"),
    ("OPM", "OPM"),
    ("FMC", "FMC"),
    ("NLRB", "NLRB"),
    ("FEC", "FEC"),
    ("HUD", "HUD"),
    ("DOJ", "DOJ"),
    ("SSA", "SSA"),
    ("DOE", "DOE"),
    ("NRC", "NRC"),
    ("NSF", "NSF"),
    ("UDALL", "Udall Foundation"),
    ("HHS", "HHS"),
    ("NASA", "NASA"),
    ("DOT", "DOT"),
    ("CFTC", "CFTC"),
    ("DHS", "DHS"),
    ("DOS", "DOS"),
    ("SEC", "SEC"),
    ("DOC", "DOC"),
    ("DOL", "DOL"),
    ("MCC", "MCC"),
    ("CPSC", "CPSC"),
    ("GSA", "GSA"),
    ("DOI", "DOI"),
    ("EPA", "EPA"),
    ("VA", "VA"),
    ("ED", "ED"),
    ("USDA", "USDA"),
    ("DOD", "DoD"),
    ("DEPT_OF_DEFENSE", "DoD"),
)
UNKNOWN_AGENCY = "Unknown"

# from the first place where a pattern of the group above can begin to the end of the text
EFFECTIVE_BEGIN = r"(?Uis)effective.*"
DEVIATION_BEGIN = r"(?Uis)(?:class\s+deviation|cd[\s#:]*[a-z]{2,}-\d|deviation).*"
DOD_TOKENS = ("DOD", "DEPT_OF_DEFENSE", "DEPARTMENT_OF_DEFENSE", "DEFENSE")
DOD_MODEL_AGENCIES = ("DOD", "DEPARTMENT OF DEFENSE")

PARTS_LIST_RE = r"(?i)Parts?[-_]([0-9_\-andAND]+)\.pdf"
PART_SINGLE_RE = r"(?i)Part[-_](\d+)"


def first_match(text, patterns, fallback=None, begin: str | None = None) -> Column:
    """Group 1 of the first pattern (in list order) that matches anywhere, stripped.

    White space, digits and word characters are Unicode's: a no-break space counts.  ``begin`` finds the first place
    where any of the patterns can begin, and the rest of the text; the patterns then pass over that rest alone, so a
    text without such a place is read once."""
    if isinstance(text, str) and (fallback is None or isinstance(fallback, str)):
        # one SQL expression for a named column: a single JVM call
        strip_re = _sql_str(r"(?U)^\s+|\s+$")
        hits = ", ".join(f"nullif(regexp_replace(regexp_extract(x, {_sql_str('(?U)' + p)}, 1), {strip_re}, ''), '')" for p in patterns)
        rest = f"`{text}`" if begin is None else f"regexp_extract(`{text}`, {_sql_str(begin)}, 0)"
        found = f"get(transform(array({rest}), x -> coalesce({hits})), 0)"
        return F.expr(found if fallback is None else f"coalesce({found}, `{fallback}`)")
    t = _c(text) if begin is None else F.regexp_extract(_c(text), begin, 0)
    found = F.get(F.transform(F.array(t), lambda x: F.coalesce(
        *[blank_to_null(strip(F.regexp_extract(x, "(?U)" + p, 1))) for p in patterns])), F.lit(0))
    return found if fallback is None else F.coalesce(found, _c(fallback))


def effective_date(text) -> Column:
    return first_match(text, EFFECTIVE_PATTERNS, begin=EFFECTIVE_BEGIN)


def deviation_number(text, fallback_filename=None) -> Column:
    if isinstance(text, str) and (fallback_filename is None or isinstance(fallback_filename, str)):
        return first_match(text, DEVIATION_NUM_PATTERNS, fallback_filename, DEVIATION_BEGIN)
    fb = fallback_filename if fallback_filename is not None else F.lit(None).cast("string")
    return first_match(text, DEVIATION_NUM_PATTERNS, fb, DEVIATION_BEGIN)


def _norm_name(fname) -> Column:
    return F.translate(F.upper(_c(fname)), "- ", "__")


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _agency_sql(mapping) -> str:
    whens = " ".join(f"WHEN contains(__NAME__, {_sql_str(k)}) THEN {_sql_str(v)}" for k, v in mapping)
    return f"CASE {whens} ELSE {_sql_str(UNKNOWN_AGENCY)} END"


_AGENCY_SQL = _agency_sql(AGENCY_MAP)
_DOD_SQL = "(" + " OR ".join(f"contains(__NAME__, {_sql_str(t)})" for t in DOD_TOKENS) + ")"


def agency_label(fname, mapping=AGENCY_MAP) -> Column:
    """Label of the first key contained in the normalised name, else 'Unknown'.

    The ordered map compiles to one CASE chain (no join, no UDF).  For a named
    column the chain is handed to the JVM as one SQL expression instead of
    ~160 separate Column calls.
    """
    if isinstance(fname, str) and mapping is AGENCY_MAP:
        return F.expr(_AGENCY_SQL.replace("__NAME__", _norm_sql(fname)))
    up = _norm_name(fname)
    out = None
    for key, label in mapping:
        cond = up.contains(key)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(UNKNOWN_AGENCY))


def _norm_sql(name: str) -> str:
    return f"translate(upper(`{name}`), '- ', '__')"


def is_dod(fname) -> Column:
    """DoD flag, independent of the label (any DoD token in the normalised name)."""
    if isinstance(fname, str):
        return F.expr(_DOD_SQL.replace("__NAME__", _norm_sql(fname)))
    up = _norm_name(fname)
    out = F.lit(False)
    for tok in DOD_TOKENS:
        out = out | up.contains(tok)
    return out


def parts_from_filename(fname) -> Column:
    """array<int> of part numbers named in a file name (ranges not expanded)."""
    if isinstance(fname, str):
        c = f"`{fname}`"
        lst, single = _sql_str(PARTS_LIST_RE), _sql_str(PART_SINGLE_RE)
        return F.expr(
            f"CASE WHEN {c} RLIKE {lst} "
            f"THEN transform(regexp_extract_all(regexp_extract({c}, {lst}, 1), '(\\\\d+)', 1), "
            f"x -> try_cast(x AS INT)) "
            f"WHEN regexp_extract({c}, {single}, 1) != '' "
            f"THEN array(try_cast(regexp_extract({c}, {single}, 1) AS INT)) "
            f"ELSE CAST(array() AS ARRAY<INT>) END")
    f = _c(fname)
    lst = F.regexp_extract(f, PARTS_LIST_RE, 1)
    single = F.regexp_extract(f, PART_SINGLE_RE, 1)
    from_list = F.transform(F.regexp_extract_all(lst, F.lit(r"(\d+)"), 1),
                            lambda x: x.try_cast("int"))
    empty = F.array().cast("array<int>")
    return (F.when(f.rlike(PARTS_LIST_RE), from_list)
            .when(single != "", F.array(single.try_cast("int")))
            .otherwise(empty))


def title_from_filename(fname) -> Column:
    """``filename.replace('.pdf', '').replace('_', ' ')``."""
    return F.replace(F.replace(_c(fname), F.lit(".pdf"), F.lit("")), F.lit("_"), F.lit(" "))


def deviation_id(agency, dev_num, fname) -> Column:
    """``f"{agency}|{dev_num or filename}"``."""
    return F.concat(F.coalesce(_c(agency).cast("string"), F.lit("None")), F.lit("|"),
                    F.coalesce(first_truthy(dev_num, fname), F.lit("None")))


def is_dod_agency(agency) -> Column:
    """Model-reported agency names DoD (upper-cased), NULL-safe -> False."""
    return F.coalesce(F.upper(_c(agency)).isin(*DOD_MODEL_AGENCIES), F.lit(False))


def first_json_object(text) -> Column:
    """Greedy ``{...}`` span (DOTALL) from free text, NULL if none."""
    return blank_to_null(F.regexp_extract(_c(text), r"(?s)\{.*\}", 0))
