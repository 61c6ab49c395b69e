"""DuckDB SQL for the structure of pages: folds by ``list_reduce`` over structs."""
from __future__ import annotations

from ..operators import links as L
from ..operators import markup as M
from . import sqlfrag as S


def _chars(*marks: str) -> str:
    return " || ".join(f"chr({ord(m)})" for m in marks)


def _link(x: str, to: str) -> str:
    return f"regexp_replace({x}, {S.q(M.LINK_RE)}, {S.q(to)}, 'g')"


def _words(x: str) -> str:
    bare = f"trim(regexp_replace({x}, {S.q('[ ' + M.TARGET + M.LABEL + M.END + ']+')}, ' ', 'g'))"
    return f"CASE WHEN {bare} = '' THEN 0 ELSE length({bare}) - length(replace({bare}, ' ', '')) + 1 END"


def main_text(source: str, key: str = "page_id", html: str = "html", out: str = "clean_text") -> str:
    """Query of ``key`` and the main text of every page of ``source``."""
    tag = "lower(regexp_extract(x, '^/?[A-Za-z0-9]*', 0))"
    code = (f"CASE WHEN i = 1 THEN '.' WHEN {tag} IN {M.sql_list(M.SIDE)} OR ({tag} IN {M.sql_list(M.CONTAINERS)} "
            f"AND regexp_matches(split_part(x, '>', 1), {S.q(M.COMMENTS_RE)})) THEN 'S' WHEN {tag} IN {M.sql_list(M.MAIN)} THEN 'M' "
            f"WHEN {tag} IN {M.sql_list(M.CONTAINERS)} THEN '(' WHEN {tag} IN {M.sql_list('/' + c for c in M.CONTAINERS)} THEN ')' ELSE '.' END")
    bare = S.decode_entities("regexp_replace(CASE WHEN i = 1 THEN x ELSE regexp_replace(x, '^[^>]*>', '') END, '<[^>]*>', '', 'g')")
    body = f"trim(regexp_replace({bare}, '[ \\t\\r\\n\\f\\x0B]+', ' ', 'g'))"
    d = "(CASE WHEN c.code IN ('(', 'M', 'S') THEN a.depth + 1 WHEN c.code = ')' THEN greatest(a.depth - 1, 0) ELSE a.depth END)"
    side = f"(CASE WHEN a.side > 0 AND {d} >= a.side THEN a.side WHEN c.code = 'S' THEN {d} ELSE 0 END)"
    main = f"(CASE WHEN a.main > 0 AND {d} >= a.main THEN a.main WHEN c.code = 'M' THEN {d} ELSE 0 END)"
    weight = "coalesce(CASE WHEN b{0}.zone > 0 THEN b{0}.words END, 0)"
    at = lambda i: f"coalesce(CASE WHEN blocks[{i}].zone > 0 THEN blocks[{i}].words END, 0)"
    return f"""
SELECT {key}, CASE WHEN {html} IS NULL THEN NULL ELSE coalesce(array_to_string(list_transform(
    CASE WHEN len(list_filter(prose, lambda b: b.score >= {M.SCORE})) > 0 THEN list_filter(prose, lambda b: b.score >= {M.SCORE}) ELSE prose END,
    lambda b: b.text), chr(10)), '') END AS {out}
FROM (SELECT {key}, {html}, list_filter(scored, lambda b: b.zone >= least AND b.words >= b.linked) AS prose
FROM (SELECT {key}, {html}, CASE WHEN m >= {M.MAIN_WORDS} OR m > o THEN 2 ELSE 1 END AS least,
  list_transform(blocks, lambda b, i: {{'text': translate({_link('b.body', '[' + chr(92) + '2](' + chr(92) + '1)')}, {_chars(M.TARGET, M.LABEL, M.END)}, ''),
    'words': b.words, 'linked': b.linked, 'zone': b.zone,
    'score': 2 * {weight.format('')} + CASE WHEN i > 1 THEN {at('i - 1')} ELSE 0 END + {at('i + 1')}}}) AS scored
FROM (SELECT *, coalesce(list_sum(list_transform(list_filter(blocks, lambda b: b.zone = 2), lambda b: b.words)), 0) AS m,
       coalesce(list_sum(list_transform(list_filter(blocks, lambda b: b.zone = 1), lambda b: b.words)), 0) AS o
FROM (SELECT {key}, {html}, list_filter(list_transform(segments, lambda s, i: {{'body': s.body, 'words': {_words(_link('s.body', ' '))},
    'linked': {_words(_link('s.body', ' ' + chr(92) + '2 '))} - {_words(_link('s.body', ' '))},
    'zone': CAST(substr(flags, i, 1) AS INTEGER)}}), lambda b: b.words + b.linked > 0) AS blocks
FROM (SELECT {key}, {html}, segments, list_reduce(list_prepend({{'depth': 0, 'side': 0, 'main': 0, 'flags': '', 'code': ''}},
    list_transform(segments, lambda s: {{'depth': 0, 'side': 0, 'main': 0, 'flags': '', 'code': s.code}})), lambda a, c: {{
    'depth': {d}, 'side': {side}, 'main': {main}, 'flags': a.flags || CASE WHEN {side} > 0 THEN '0' WHEN {main} > 0 THEN '2' ELSE '1' END, 'code': ''}}).flags AS flags
FROM (SELECT {key}, {html}, list_transform(string_split(regexp_replace(joined, {S.q(M.BLOCK_RE)}, chr(1) || '\\1 \\2>', 'g'), chr(1)),
    lambda x, i: {{'code': {code}, 'body': {body}}}) AS segments
FROM (SELECT {key}, {html}, regexp_replace(array_to_string(list_transform(string_split(regexp_replace(translate(
    regexp_replace({html}, {S.q(M.UNSEEN_RE)}, ' ', 'g'), {_chars(M.MARK, M.TARGET, M.LABEL, M.END)}, ''), '(?i)<a(\\s[^>]*)>', chr(1) || '\\1' || chr(1), 'g'), chr(1)),
    lambda x, i: CASE WHEN i % 2 = 1 THEN x WHEN regexp_matches('<a' || x || '>', {S.q(L.HREF_RE)})
      THEN chr({ord(M.TARGET)}) || translate({S.href_of("('<a' || x || '>')")}, '<>', '') || chr({ord(M.LABEL)}) ELSE '' END), ''), '(?i)</a\\s*>', chr({ord(M.END)}), 'g') AS joined
FROM {source}) j) s) z) t) w) y) x
"""


def ancestor_links(source: str, keep: str, html: str, href: str, wanted: str) -> str:
    """Query of ``keep``, pos, href, anchor and heading of the wanted links of ``source``.

    ``href``: SQL of a link's target from its start tag ``tag``; ``wanted``: condition on ``href``.
    """
    name = "lower(regexp_extract(x, '^/?([A-Za-z0-9]*)', 1))"
    empty = ("'stack': CAST([] AS STRUCT(name VARCHAR, \"at\" INTEGER)[]), 'spans': CAST([] AS STRUCT(\"at\" INTEGER, till INTEGER)[]), "
             "'links': CAST([] AS STRUCT(\"at\" INTEGER, head INTEGER)[])")
    blocked = f"list_position(list_transform(a.stack, lambda s: {M.barrier('t.name', 's.name')}), true)"
    popped = (f"(CASE WHEN t.closes THEN coalesce(list_position(list_transform(a.stack, lambda s: s.name), t.name), 0) ELSE coalesce(list_max(list_transform("
              f"list_slice(a.stack, 1, coalesce(nullif({blocked}, 0) - 1, len(a.stack))), "
              f"lambda s, k: CASE WHEN {M.closable('t.name', 's.name', 'k')} THEN k ELSE 0 END)), 0) END)")
    rest = f"list_slice(a.stack, {popped} + 1, len(a.stack))"
    spanning = "s.name IN ('a', 'h2', 'h3', 'h4')"
    fragment = lambda at: (f"CASE WHEN {at} IS NOT NULL THEN '<' || array_to_string(list_slice(parts, {at} + 1, "  # noqa: E731
                           f"list_filter(spans, lambda s: s.at = {at})[1].till), '<') END")
    return f"""
SELECT {keep}, pos, tokens[l.at + 1].href AS href, {fragment('l.at')} AS anchor, {fragment('l.head')} AS heading
FROM (SELECT {keep}, parts, tokens, CAST(i - 1 AS INTEGER) AS pos, f.links[i] AS l,
  list_concat(f.spans, list_transform(list_filter(f.stack, lambda s: {spanning}), lambda s: {{'at': s.at, 'till': CAST(len(tokens) AS INTEGER)}})) AS spans
FROM (SELECT *, unnest(generate_series(1, len(f.links))) AS i
FROM (SELECT {keep}, parts, tokens, list_reduce(tokens, lambda a, t: {{'at': 0, 'closes': false, 'name': '', 'href': '', 'wanted': false,
    'stack': CASE WHEN t.closes OR t.name IN {M.sql_list(M.VOID)} THEN {rest} ELSE list_prepend({{'name': t.name, 'at': t.at}}, {rest}) END,
    'spans': list_concat(a.spans, list_transform(list_filter(list_slice(a.stack, 1, {popped}), lambda s: {spanning}), lambda s: {{'at': s.at, 'till': t.at}})),
    'links': CASE WHEN t.wanted THEN list_append(a.links, {{'at': t.at, 'head': list_filter(list_slice({rest}, 1, {M.ANCESTORS}),
        lambda s: s.name IN ('h2', 'h3', 'h4'))[1].at}}) ELSE a.links END}}) AS f
FROM (SELECT {keep}, parts, list_transform(hrefs, lambda h, i: {{'at': CAST(i - 1 AS INTEGER), 'closes': starts_with(parts[i], '/') AND i > 1,
    'name': CASE WHEN i = 1 THEN '' ELSE h.name END, 'href': h.href, 'wanted': coalesce({wanted.replace('href', 'h.href')}, false), {empty}}}) AS tokens
FROM (SELECT {keep}, parts, list_transform(parts, lambda x: {{'name': {name}, 'href': CASE WHEN {name} = 'a' AND NOT starts_with(x, '/')
      AND regexp_matches('<' || split_part(x, '>', 1) || '>', {S.q(L.HREF_RE)}) THEN {href.replace('tag', "('<' || split_part(x, '>', 1) || '>')")} END}}) AS hrefs
FROM (SELECT {keep}, string_split(regexp_replace(replace(regexp_replace({html}, {S.q(M.UNSEEN_RE)}, '', 'g'), chr(1), ''),
    {S.q(M.TAG_RE)}, chr(1) || '\\1', 'g'), chr(1)) AS parts FROM {source}) p) h) t WHERE len(list_filter(tokens, lambda t: t.wanted)) > 0) f) u) v
"""
