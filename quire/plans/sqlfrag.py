"""DuckDB SQL fragments mirroring the column expressions (for oracle SQL).

RE2 has no back-references and no ``(?U)``; every pattern used here is
written so that Java and RE2 agree on the driver data.
"""
from __future__ import annotations

from ..functions import fields
from ..operators import links as L


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def nullif_blank(x: str) -> str:
    return f"nullif({x}, '')"


def rx(x: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract({x}, {q(pattern)}, {group})"


def decode_entities(x: str) -> str:
    for ent, ch in L.ENTITIES:
        x = f"replace({x}, {q(ent)}, {q(ch)})"
    return x


def tag_text(x: str) -> str:
    t = f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"
    t = decode_entities(t)
    return strip(f"regexp_replace({t}, '\\s+', ' ', 'g')")


def url_hash(x: str) -> str:
    return f"left(sha256({x}), 16)"


def basename(x: str) -> str:
    return f"regexp_extract({x}, '[^/]*$', 0)"


def safe_filename(x: str) -> str:
    return (f"{url_hash(x)} || '_' || regexp_replace({basename(x)}, "
            f"'[^A-Za-z0-9._-]', '_', 'g')")


def strip_query(x: str) -> str:
    return f"split_part({x}, '?', 1)"


def site_root(x: str) -> str:
    return f"regexp_extract({x}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"


def norm_name(x: str) -> str:
    return f"translate(upper({x}), '- ', '__')"


def agency_label(x: str) -> str:
    up = norm_name(x)
    whens = " ".join(f"WHEN contains({up}, {q(k)}) THEN {q(v)}" for k, v in fields.AGENCY_MAP)
    return f"CASE {whens} ELSE {q(fields.UNKNOWN_AGENCY)} END"


def is_dod(x: str) -> str:
    up = norm_name(x)
    return "(" + " OR ".join(f"contains({up}, {q(t)})" for t in fields.DOD_TOKENS) + ")"


def parts_from_filename(x: str) -> str:
    lst = rx(x, fields.PARTS_LIST_RE, 1)
    single = rx(x, fields.PART_SINGLE_RE, 1)
    return (f"CASE WHEN regexp_matches({x}, {q(fields.PARTS_LIST_RE)}) "
            f"THEN list_transform(regexp_extract_all({lst}, '(\\d+)', 1), lambda v: TRY_CAST(v AS INTEGER)) "
            f"WHEN {single} <> '' THEN [TRY_CAST({single} AS INTEGER)] "
            f"ELSE CAST([] AS INTEGER[]) END")


def first_match(x: str, patterns, fallback: str | None = None) -> str:
    parts = [nullif_blank(strip(rx(x, p, 1))) for p in patterns]
    if fallback is not None:
        parts.append(fallback)
    return "coalesce(" + ", ".join(parts) + ")"


def percent_1dp(part: str, total: str) -> str:
    return (f"CASE WHEN {total} = 0 THEN 0.0 ELSE "
            f"CAST(({part} * 2000 + {total}) // (2 * {total}) AS DOUBLE) / 10 END")


def visible(x: str) -> str:
    return f"regexp_replace({x}, {q(L.HIDDEN_RE)}, '', 'g')"


def anchors(x: str) -> str:
    """List of anchors with an href: marked before each start tag, cut there, ended at the end tag."""
    marked = f"regexp_replace(replace({x}, chr(1), ''), {q(L.ANCHOR_TAG_RE)}, chr(1) || '\\1', 'g')"
    pieces = f"list_slice(string_split({marked}, chr(1)), 2, 2147483647)"
    return (f"list_transform(list_filter({pieces}, lambda a: regexp_matches(a, {q(L.HREF_RE)})), "
            f"lambda a: regexp_replace(a, {q(L.AFTER_ANCHOR_RE)}, ''))")


def href_of(x: str) -> str:
    return decode_entities(" || ".join(f"regexp_extract({x}, {q(L.HREF_RE)}, {i})" for i in (1, 2, 3)))


def without_dots(x: str) -> str:
    """A path without dot segments: a stack folded by ``list_reduce``."""
    parts = f"string_split({x}, '/')"
    none = "CAST([] AS VARCHAR[])"
    stack = (f"list_reduce(list_prepend({{'s': '', 'kept': {none}}}, list_transform({parts}, lambda s: {{'s': s, 'kept': {none}}})), "
             f"lambda a, c: {{'s': '', 'kept': CASE WHEN c.s = '..' THEN list_slice(a.kept, 1, greatest(len(a.kept) - 1, 0)) "
             f"WHEN c.s = '.' THEN a.kept ELSE list_append(a.kept, c.s) END}}).kept")
    last = f"CASE WHEN {parts}[-1] IN ('.', '..') THEN list_append({stack}, '') ELSE {stack} END"
    return f"('/' || regexp_replace(array_to_string({last}, '/'), '^/', ''))"


def resolve(href: str, base: str) -> str:
    root, page = site_root(base), f"regexp_extract({base}, '^[^?#]*', 0)"
    path, tail = f"regexp_extract({href}, '^[^?#]*', 0)", f"regexp_extract({href}, '[?#].*$', 0)"
    folder = f"coalesce(nullif(regexp_extract(substr({page}, length({root}) + 1), '^.*/', 0), ''), '/')"
    return (f"CASE WHEN regexp_matches({href}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {href} "
            f"WHEN starts_with({href}, '//') THEN regexp_extract({base}, '^[A-Za-z][A-Za-z0-9+.-]*:', 0) || {href} "
            f"WHEN starts_with({href}, '/') THEN {root} || {without_dots(path)} || {tail} WHEN {href} = '' THEN {base} "
            f"WHEN starts_with({href}, '?') THEN {page} || {href} WHEN starts_with({href}, '#') THEN split_part({base}, '#', 1) || {href} "
            f"ELSE {root} || {without_dots(f"regexp_replace({folder} || {path}, '//+', '/', 'g')")} || {tail} END")
