"""String helpers as native column expressions (no UDFs)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace.

    ``trim`` only removes spaces, so a Unicode-aware regex is used.
    """
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def without(x, chars: str) -> Column:
    """The text without these characters; a search for each, which costs little where there is none."""
    c = _c(x)
    for ch in chars:
        c = F.replace(c, F.lit(ch), F.lit(""))
    return c


def capitalize(x) -> Column:
    """Python ``str.capitalize()``: first char upper, rest lower (not initcap)."""
    c = _c(x)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def blank_to_null(x) -> Column:
    """Python truthiness for strings: '' behaves like None."""
    c = _c(x)
    return F.when(c != F.lit(""), c)


def first_truthy(*cols) -> Column:
    """``a or b or c`` on strings: first value that is neither NULL nor ''."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def truncate(x, n: int) -> Column:
    """``text[:n]`` in code points."""
    return F.substring(_c(x), 1, n)


def split_once(x, sep: str, idx: int) -> Column:
    """``s.split(sep, 1)[idx]`` (NULL when that piece does not exist)."""
    return F.get(F.split(_c(x), _quote(sep), 2), idx)


def _quote(s: str) -> str:
    import re

    return re.escape(s)
