"""Structure of HTML pages: nearest ancestors of links (I1b, H7) and main text.

A page is cut at its tags into an array of segments (a tag and the text after it) and folded
once, in the row, by native array functions: the fold keeps the open elements as a stack, or
as a depth.  Nothing is shuffled; a page is the unit of work, as it is for the browser that
made it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import _c, without

MARK, TARGET, LABEL, END = "\u0001", "\u0002", "\u0003", "\u0004"
# comments and elements whose content no reader sees
UNSEEN_RE = (r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>"
             r"|<noscript\b.*?</noscript\s*>|<template\b.*?</template\s*>|<svg\b.*?</svg\s*>")
TAG_RE = r"<(/?[A-Za-z][A-Za-z0-9]*)"

# ---- open elements (rules of the HTML standard) ----
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: A start tag of these ends an open paragraph.
ENDS_P = ("address", "article", "aside", "blockquote", "dd", "div", "dl", "dt", "fieldset", "footer", "form",
          *HEADINGS, "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section", "table", "ul")
#: A start tag ends these open elements, unless one of the barriers is open inside them.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
        "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "a": ("a",)}
BARRIERS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
            "th": ("tr", "table"), "option": ("select",), "a": ("td", "th", "table")}
ANCESTORS = 3


def sql_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def closable(new: str, is_open: str, place: str) -> str:
    """SQL condition: a start tag ``new`` ends the element ``is_open``, the ``place``-th (from 1) from the innermost."""
    rules = [f"({new} IN {sql_list(ENDS_P)} AND {is_open} = 'p')",
             f"({new} IN {sql_list(HEADINGS)} AND {is_open} IN {sql_list(HEADINGS)} AND {place} = 1)"]
    rules += [f"({new} = '{k}' AND {is_open} IN {sql_list(v)})" for k, v in ENDS.items()]
    return "(" + " OR ".join(rules) + ")"


def barrier(new: str, is_open: str) -> str:
    """SQL condition: ``is_open`` keeps a start tag ``new`` from ending what is open outside of it."""
    rules = [f"({new} = '{k}' AND {is_open} IN {sql_list(v)})" for k, v in BARRIERS.items()]
    other = ", ".join(f"'{k}'" for k in BARRIERS)
    rules.append(f"({new} NOT IN ({other}) AND {is_open} IN ('td', 'th', 'table'))")
    return "(" + " OR ".join(rules) + ")"


_STATE = ("struct<stack:array<struct<name:string,at:int>>, spans:array<struct<at:int,till:int>>, "
          "links:array<struct<at:int,head:int>>>")
_POPPED = f"""
  IF(t.closes,
     array_position(transform(acc.stack, s -> s.name), t.name),
     coalesce(array_max(transform(
       slice(acc.stack, 1, coalesce(nullif(array_position(transform(acc.stack, s -> {barrier('t.name', 's.name')}), true), 0) - 1, size(acc.stack))),
       (s, k) -> IF({closable('t.name', 's.name', 'k + 1')}, k + 1, 0))), 0))
"""
_FOLD = f"""
aggregate(slice(tokens, 2, size(tokens)), CAST(named_struct('stack', array(), 'spans', array(), 'links', array()) AS {_STATE}),
  (acc, t) -> transform(array(CAST({_POPPED} AS INT)), n -> named_struct(
    'stack', IF(t.closes OR t.name IN {sql_list(VOID)}, slice(acc.stack, n + 1, size(acc.stack)),
                concat(array(named_struct('name', t.name, 'at', t.at)), slice(acc.stack, n + 1, size(acc.stack)))),
    'spans', concat(acc.spans, transform(filter(slice(acc.stack, 1, n), s -> s.name IN ('a', 'h2', 'h3', 'h4')),
                                         s -> named_struct('at', s.at, 'till', t.at))),
    'links', IF(t.wanted, concat(acc.links, array(named_struct('at', t.at, 'head',
                get(filter(slice(acc.stack, n + 1, {ANCESTORS}), s -> s.name IN ('h2', 'h3', 'h4')), 0).at))), acc.links)))[0],
  acc -> named_struct('links', acc.links, 'spans', concat(acc.spans, transform(
    filter(acc.stack, s -> s.name IN ('a', 'h2', 'h3', 'h4')), s -> named_struct('at', s.at, 'till', size(tokens))))))
"""


def ancestor_links(pages: DataFrame, keep: list[str], html: str, href: Column, wanted: Column) -> DataFrame:
    """Wanted links with their own text and their heading's: keep..., pos, href, anchor, heading.

    ``href``: expression of a link's target from its start tag, a string column ``tag``; ``wanted``: condition on ``href``.
    ``anchor`` and ``heading`` are HTML fragments; the heading is the nearest h2, h3 or h4 among the three
    nearest ancestors, NULL without one.  End tags that authors may leave out (li, p, td ...) are
    supplied by the standard's rules, an end tag closes what is open inside its element, and what
    nothing closes ends with the page.
    """
    seen = without(F.regexp_replace(_c(html), UNSEEN_RE, ""), MARK)
    parts = pages.select(*keep, F.split(F.regexp_replace(seen, TAG_RE, MARK + "$1"), MARK).alias("parts"))
    named = parts.select(*keep, "parts", F.transform("parts", lambda x, i: F.struct(
        i.alias("at"), x.startswith("/").alias("closes"), F.lower(F.regexp_extract(x, r"^/?([A-Za-z0-9]*)", 1)).alias("name"),
        F.concat(F.lit("<"), F.substring_index(x, ">", 1), F.lit(">")).alias("tag"))).alias("named"))
    linked = named.select(*keep, "parts", F.transform("named", lambda t: F.struct(
        t["at"].alias("at"), t["closes"].alias("closes"), t["name"].alias("name"),
        F.when(~t["closes"] & (t["name"] == "a"), _of_tag(href, t["tag"])).alias("href"))).alias("linked"))
    tokens = linked.select(*keep, "parts", F.transform("linked", lambda t: F.struct(
        t["at"].alias("at"), t["closes"].alias("closes"), t["name"].alias("name"), t["href"].alias("href"),
        F.coalesce(_of_href(wanted, t["href"]), F.lit(False)).alias("wanted"))).alias("tokens"))
    # pages without a wanted link need no fold
    tokens = tokens.where(F.exists("tokens", lambda t: t["wanted"]))
    folded = tokens.select(*keep, "parts", "tokens", F.expr(_FOLD).alias("f"))
    rows = folded.select(*keep, "parts", "tokens", "f.spans", F.posexplode("f.links").alias("pos", "l"))

    def fragment(at: Column) -> Column:
        till = F.get(F.filter("spans", lambda s: s["at"] == at), F.lit(0))["till"]
        inside = F.slice("parts", at + 1, till - at)
        return F.when(at.isNotNull(), F.concat(F.lit("<"), F.array_join(inside, "<")))

    return rows.select(*keep, "pos", F.get("tokens", F.col("l.at"))["href"].alias("href"),
                       fragment(F.col("l.at")).alias("anchor"), fragment(F.col("l.head")).alias("heading"))


def _of_tag(expression, tag: Column) -> Column:
    return expression(tag) if callable(expression) else expression


def _of_href(condition, href: Column) -> Column:
    return condition(href) if callable(condition) else condition


# ---- main text ----
#: Elements that end a block of text, and those of them that nest and are always closed.
BLOCKS = ("p", "br", *HEADINGS, "li", "dt", "dd", "tr", "td", "th", "hr", "option", "figcaption", "caption", "legend", "body", "html")
CONTAINERS = ("div", "section", "article", "main", "nav", "footer", "aside", "header", "form", "fieldset", "figure",
              "blockquote", "pre", "ul", "ol", "dl", "table", "thead", "tbody", "select", "address", "details", "button")
#: Containers that hold no main text, and those that hold it where a page has them.
SIDE, MAIN = ("nav", "footer", "aside", "form", "select", "button"), ("article", "main")
COMMENTS_RE = r"""(?i)\b(?:id|class)\s*=\s*["']?[^"'>]*\b(?:comment|comments|reply|replies|respond)\b"""
BLOCK_RE = r"(?i)<(/?(?:" + "|".join(sorted({*BLOCKS, *CONTAINERS}, key=lambda x: (-len(x), x))) + r"))\b([^>]*)>"
LINK_RE = TARGET + "([^" + LABEL + "]*)" + LABEL + "([^" + TARGET + END + "]*)" + END + "?"
#: Words outside links from which on main elements are believed; smoothed score (four times the words) of a kept block.
MAIN_WORDS, SCORE = 25, 20


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _zones(codes: Column) -> Column:
    """Zone of the text after every tag, by a fold over the depth of open containers (see ``_code``).

    A side or main zone lasts until the depth falls below the one it began at.  The zones come as one
    string of digits, which the fold extends without copying arrays.
    """
    def step(acc: Column, c: Column) -> Column:
        depth = (F.when(c.isin("(", "M", "S"), acc["depth"] + 1).when(c == ")", F.greatest(acc["depth"] - 1, F.lit(0)))
                 .otherwise(acc["depth"]))

        def zone(d: Column) -> Column:
            side = F.when((acc["side"] > 0) & (d >= acc["side"]), acc["side"]).when(c == "S", d).otherwise(0)
            main = F.when((acc["main"] > 0) & (d >= acc["main"]), acc["main"]).when(c == "M", d).otherwise(0)
            return _let(F.struct(d.alias("depth"), side.alias("side"), main.alias("main")), lambda r: F.struct(
                r["depth"].alias("depth"), r["side"].alias("side"), r["main"].alias("main"),
                F.concat(acc["flags"], F.when(r["side"] > 0, "0").when(r["main"] > 0, "2").otherwise("1")).alias("flags")))

        return _let(depth, zone)

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("side"), F.lit(0).alias("main"), F.lit("").alias("flags"))
    return F.aggregate(codes, start, step, lambda acc: F.split(acc["flags"], ""))


def main_blocks(html, href, decode) -> Column:
    """Blocks of a page with their scores: array of structs text, words, linked, zone, score.

    A block is the text between two block tags.  Its ``text`` shows links as ``[label](target)``; ``words`` counts
    the words outside links, ``linked`` those inside.  ``zone`` is 0 in navigation, footers, asides, forms and
    comment threads, 2 in an article or main element and else 1.  ``score``: the words of the block twice and of
    its neighbours once; words in zone 0 and in links count nothing.  ``href`` gives the target from a start
    tag, ``decode`` replaces entities.
    """
    seen = without(F.regexp_replace(_c(html), UNSEEN_RE, " "), MARK + TARGET + LABEL + END)
    # the start tag of a link becomes its target between two marks, its end tag a third mark
    cut = F.split(F.regexp_replace(seen, r"(?i)<a(\s[^>]*)>", MARK + "$1" + MARK), MARK)
    pieces = F.transform(cut, lambda x, i: F.when(i % 2 == 0, x).otherwise(
        F.coalesce(F.concat(F.lit(TARGET), F.translate(href(F.concat(F.lit("<a"), x, F.lit(">"))), "<>", ""), F.lit(LABEL)), F.lit(""))))
    joined = F.regexp_replace(F.array_join(pieces, ""), r"(?i)</a\s*>", END)
    marked = F.split(F.regexp_replace(joined, BLOCK_RE, MARK + "$1 $2>"), MARK)

    def segment(x: Column, i: Column) -> Column:  # before the first tag there is only text
        return F.struct(F.when(i == 0, ".").otherwise(_code(F.lower(F.regexp_extract(x, r"^/?[A-Za-z0-9]*", 0)), F.substring_index(x, ">", 1))).alias("code"),
                        _clean(F.when(i == 0, x).otherwise(F.regexp_replace(x, r"^[^>]*>", "")), decode).alias("body"))

    def scored(blocks: Column) -> Column:
        weight = lambda b: F.coalesce(F.when(b["zone"] > 0, b["words"]), F.lit(0))
        return F.transform(blocks, lambda b, i: F.struct(
            without(F.regexp_replace(b["body"], LINK_RE, "[$2]($1)"), TARGET + LABEL + END).alias("text"),
            b["words"].alias("words"), b["linked"].alias("linked"), b["zone"].alias("zone"),
            (2 * weight(b) + weight(F.get(blocks, i - 1)) + weight(F.get(blocks, i + 1))).alias("score")))

    def counted(segments: Column) -> Column:
        words = F.transform(segments, lambda s: F.struct(s["body"].alias("body"), _words(F.regexp_replace(s["body"], LINK_RE, " ")).alias("words"),
                                                         _words(F.regexp_replace(s["body"], LINK_RE, " $2 ")).alias("all")))
        return _let(_zones(F.transform(segments, lambda s: s["code"])), lambda zones: F.filter(F.transform(words, lambda b, i: F.struct(
            b["body"].alias("body"), b["words"].alias("words"), (b["all"] - b["words"]).alias("linked"),
            F.get(zones, i).cast("int").alias("zone"))), lambda b: b["words"] + b["linked"] > 0))

    return _let(_let(F.transform(marked, segment), counted), scored)


def _code(tag: Column, attributes: Column) -> Column:
    """``(`` opens a container, ``S`` one without main text, ``M`` one of main text, ``)`` closes one; ``.`` is any other tag."""
    side = tag.isin(*SIDE) | (tag.isin(*CONTAINERS) & attributes.rlike(COMMENTS_RE))
    return (F.when(side, "S").when(tag.isin(*MAIN), "M").when(tag.isin(*CONTAINERS), "(")
            .when(tag.isin(*["/" + c for c in CONTAINERS]), ")").otherwise("."))


def _clean(body: Column, decode) -> Column:
    """Tags dropped, entities decoded, white space as one space and none at the ends."""
    return F.trim(F.regexp_replace(decode(F.regexp_replace(body, r"<[^>]*>", "")), r"[ \t\r\n\f\x0B]+", " "))


def _words(text: Column) -> Column:
    bare = F.trim(F.regexp_replace(text, "[ " + TARGET + LABEL + END + "]+", " "))
    return F.when(bare == "", 0).otherwise(F.length(bare) - F.length(F.replace(bare, F.lit(" "), F.lit(""))) + 1)


def main_text(html, href, decode) -> Column:
    """Main text of a page, one line a block.

    Main elements are believed, and the rest left out, if they have at least MAIN_WORDS words outside links or more than the
    rest.  Kept are blocks with a smoothed score of SCORE that are not mostly links.  A page where none is gives all
    blocks outside the side zones that are not mostly links; one without any gives the empty string.
    Links stay as ``[label](target)``.  NULL stays NULL.
    """
    def total(blocks: Column, zone: int) -> Column:
        return F.aggregate(blocks, F.lit(0), lambda a, b: a + F.when(b["zone"] == zone, b["words"]).otherwise(0))

    def chosen(blocks: Column) -> Column:
        believed = (total(blocks, 2) >= MAIN_WORDS) | (total(blocks, 2) > total(blocks, 1))
        return _let(F.when(believed, 2).otherwise(1), lambda least: _let(
            F.filter(blocks, lambda b: (b["zone"] >= least) & (b["words"] >= b["linked"])), best))

    def best(prose: Column) -> Column:
        return _let(F.filter(prose, lambda b: b["score"] >= SCORE), lambda kept: F.array_join(
            F.transform(F.when(F.size(kept) > 0, kept).otherwise(prose), lambda b: b["text"]), "\n"))

    return F.when(_c(html).isNotNull(), _let(main_blocks(html, href, decode), chosen))
