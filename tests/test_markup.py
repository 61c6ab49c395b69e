"""Main text, ancestors of links, relative links and registered domains, on own pages."""
import random
import urllib.parse

import pytest
from pyspark.sql import functions as F

from quire.functions import urls
from quire.operators import crawl as C
from quire.operators import links as L
from quire.operators import markup as M

PART = "/far-overhaul/far-part-deviation-guide/far-overhaul-part-"
LONG = "The harbour office opens at nine and closes at five on every day of the working week."


def text(spark, html):
    return spark.createDataFrame([(html,)], "html string").select(L.clean_text("html")).first()[0]


def test_main_text_of_a_page_with_menu_links_and_comments(spark):
    html = f"""<html><head><title>never</title><style>p {{}}</style></head><body>
      <header><h1>Harbour times</h1></header>
      <nav><div><p>{LONG}</p></div><ul><li><a href="/a">A</a></ul></nav>
      <div id=content><h2>Opening</h2><p>{LONG} See <a href='/map?x=1&amp;y=2'>the map</a>.</p>
      <p>{LONG}<br>{LONG}</p>
      <ul><li><a href="/one">One of many links</a><li><a href="/two">Another of the links</a></ul></div>
      <div class="post-comments list"><div class="comment"><p>{LONG} I agree.</p></div><p>{LONG}</p></div>
      <p>{LONG} After the comments.</p>
      <aside><p>{LONG}</p></aside><footer><p>{LONG}</p></footer>
      <script>document.write("<p>{LONG}</p>")</script></body></html>"""
    assert text(spark, html) == "\n".join([
        "Opening", f"{LONG} See [the map](/map?x=1&y=2).", LONG, LONG, f"{LONG} After the comments."])


def test_main_elements_are_believed(spark):
    html = f"<div><p>{LONG}</p></div><article><p>{LONG} Inside.</p><article><p>{LONG} Nested.</p></article><p>{LONG} Last.</p></article><p>{LONG}</p>"
    assert text(spark, html) == f"{LONG} Inside.\n{LONG} Nested.\n{LONG} Last."
    # too short to be the main text, but beside a long text
    assert text(spark, f"<main>Menu of the day</main><div><p>{LONG}</p><p>{LONG}</p></div>") == f"Menu of the day\n{LONG}\n{LONG}"


def test_link_shapes(spark):
    html = f'<p>{LONG} <a href="/x">one <b>two</b></a> <a name=n>plain</a> <a href=/y>open <a href="/z">next</a></p><p>{LONG} tail</a></p>'
    assert text(spark, html) == f"{LONG} [one two](/x) plain [open ](/y)[next](/z)\n{LONG} tail"


def test_short_and_odd_pages(spark):
    assert text(spark, "") == "" and text(spark, None) is None
    assert text(spark, "just words") == "just words"
    assert text(spark, "<p>one</p><nav>menu</nav>") == "one"
    assert text(spark, "<nav><p>menu</p></nav>") == ""
    assert text(spark, '<p><a href="/x">only a link here</a></p>') == ""
    assert text(spark, "</div></div><p>a &lt;b&gt; &amp;amp; c") == "a <b> &amp; c"
    assert text(spark, "a\u0001b\u0002c\u0003d\u0004e") == "abcde"
    assert text(spark, "<div>" * 300 + "deep text" + "</div>" * 300) == "deep text"


def test_long_page(spark):
    body = "".join(f"<p>{LONG} {i}</p>" for i in range(5000))
    got = text(spark, f"<nav>{'<a href=/x>x</a>' * 5000}</nav>{body}").split("\n")
    assert len(got) == 5000 and got[4999] == f"{LONG} 4999"


def plain_scores(blocks):
    """Scores of (words, zone) one by one."""
    w = [0 if z == 0 else n for n, z in blocks]
    return [2 * n + (w[i - 1] if i else 0) + (w[i + 1] if i + 1 < len(w) else 0) for i, n in enumerate(w)]


def test_scores_equal_brute_force(spark):
    rng = random.Random(4)
    zones = {0: ("<nav><p>", "</p></nav>"), 1: ("<div><p>", "</p></div>"), 2: ("<article><p>", "</p></article>")}
    blocks = [(rng.randint(1, 12), rng.choice([0, 1, 2])) for _ in range(200)]
    html = "".join(zones[z][0] + " ".join("w" * n) + zones[z][1] for n, z in blocks)
    df = spark.createDataFrame([(html,)], "html string")
    (got,) = df.select(M.main_blocks("html", L.href_of, L.decode_entities)).first()
    assert [(b.words, b.zone, b.score) for b in got] == [(n, z, s) for (n, z), s in zip(blocks, plain_scores(blocks))]


def headings(spark, html):
    rows = spark.createDataFrame([(1, "https://a.example", html)], "page_id long, base string, html string")
    return {r.part_number: (r.issued, r.title_hint) for r in L.part_headings(rows).collect()}


def link(n, inside="t"):
    return f'<a href="{PART}{n}">{inside}</a>'


DATED = "Issuance Date: May 4, 2025"


@pytest.mark.parametrize("html,issued", [
    (f"<h3>{link(1)} {DATED}</h3>", "May 4, 2025"),
    (f"<h2><span><b>{link(1)}</b></span> {DATED}</h2>", "May 4, 2025"),  # third ancestor
    (f"<h2><i><span><b>{link(1)}</b></span></i> {DATED}</h2>", None),  # fourth
    (f"<h3>{link(1)} {DATED}", "May 4, 2025"),  # unclosed
    (f"<h3>{DATED}</h3><p>{link(1)}</p>", None),
    (f"<h1>{link(1)} {DATED}</h1>", None),  # not a heading that counts
    (f"<ul><li><h4>{link(1)} {DATED}</h4><li>x</ul>", "May 4, 2025"),
    (f"<h3>{DATED}<p>x</h3>{link(1)}", None),  # the end tag closes the paragraph too
    (f"<h3>one<h2>{link(1)} {DATED}</h2></h3>", "May 4, 2025"),
    (f"<h3>{DATED}<br><img src=x>{link(1)}</h3>", "May 4, 2025"),  # empty elements are no ancestors
    (f"<h3><div><div>{link(1)}</div></div> Issuance Date: June 1, 2024 {DATED}</h3>", "June 1, 2024"),
    (f"<h3><!-- <b><b><b> -->{link(1)}<script>'</h3>'</script> {DATED}</h3>", "May 4, 2025"),
    (f"<table><tr><td><h3>{DATED} {link(1)}<td>x</table>", "May 4, 2025"),
])
def test_headings_among_three_ancestors(spark, html, issued):
    assert headings(spark, html) == {1: (issued, "t")}


def test_first_link_of_a_part_counts_and_many_tags(spark):
    html = f"<p>{link(4, 'first')}</p><h3>{link(4)} {DATED}</h3><h3>{link(5, '<i>x</i> ' * 500)} {DATED}</h3>" + "<p>x<li>y" * 3000
    assert headings(spark, html) == {4: (None, "first"), 5: ("May 4, 2025", " ".join("x" * 500))}


BASES = ("https://h.example/a/b/c.html?q=1#f", "https://h.example/a/b/", "https://h.example", "https://h.example/")
HREFS = ("x.pdf", "../x.pdf", "../../x.pdf", "../../../../x.pdf", "./x", ".", "..", "../", "/a/../b/./c", "/../x", "//o.example/a/../b", "?z=1", "#g",
         "https://o.example/a/../b", "x/../y/./z?u=../v", "a//b", "/a//b", "d/..", "d/.", "x..y/.../z", "mailto:a@b.example", "..x/y")


@pytest.mark.parametrize("base", BASES)
def test_resolve_equals_the_standard_library(spark, base):
    df = spark.createDataFrame([(h, base) for h in HREFS], "href string, base string")
    got = {r.href: r.u for r in df.select("href", urls.resolve("href", "base").alias("u")).collect()}
    for h in HREFS:
        want = urllib.parse.urljoin(base, h)
        assert got[h] == want, (base, h)


RULES = ("com", "uk", "co.uk", "*.ck", "!www.ck", "jp", "*.kawasaki.jp", "!city.kawasaki.jp", "a.b.example.com")


@pytest.mark.parametrize("host,want", [
    ("www.shop.co.uk", "shop.co.uk"), ("co.uk", None), ("uk", None), ("shop.uk", "shop.uk"), ("x.y.example.com", "example.com"),
    ("z.a.b.example.com", "z.a.b.example.com"), ("a.b.example.com", None), ("b.example.com", "example.com"),
    ("q.w.anything.ck", "w.anything.ck"), ("anything.ck", None), ("www.ck", "www.ck"), ("x.www.ck", "www.ck"), ("ck", None),
    ("m.city.kawasaki.jp", "city.kawasaki.jp"), ("m.n.kawasaki.jp", "m.n.kawasaki.jp"), ("kawasaki.jp", "kawasaki.jp"),
    ("localhost", None), ("10.0.0.1", None), ("COM", None), ("Www.Shop.CO.UK", "shop.co.uk")])
def test_registered_domains(spark, host, want):
    rules = spark.createDataFrame([(r,) for r in RULES], "rule string")
    df = spark.createDataFrame([(f"https://u@{host}:80/p", 1), (f"https://{host}", 2), ("no url", 3), (None, 4)], "url string, host_id int")
    got = {r.host_id: r.domain for r in C.registered_domains(df, rules).collect()}
    assert got == {1: want, 2: want, 3: None, 4: None}


def test_domain_filter_with_rules(spark):
    rules = spark.createDataFrame([(r,) for r in RULES], "rule string")
    df = spark.createDataFrame([(f"https://{h}/",) for h in ("a.shop.co.uk", "shop.uk", "localhost")], "url string")
    kept = {r.url for r in C.domain_filter(df, ["shop.co.uk"], rules=rules).collect()}
    assert kept == {"https://shop.uk/", "https://localhost/"}
    blocked = spark.createDataFrame([("shop.co.uk",)], "d string")
    assert {r.url for r in C.domain_filter(df.where(F.col("url") != "https://localhost/"), blocked, rules=rules).collect()} == {"https://shop.uk/"}
