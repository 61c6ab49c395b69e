from pyspark.sql import functions as F

from quire.operators import links as L

ROOT = "https://press.example.org"
PART = "/far-overhaul/far-part-deviation-guide/far-overhaul-part-"
FILES = "/sites/default/files/page_file_uploads/"
# own page: every way to write a link, nested headings, hidden and unclosed ones
PAGE = f"""<!doctype html><html><head><script>var x = '<a href="/never.pdf">';</script></head><body>
<h2><span>Seven</span> <a class="x" href='{PART}7?tab=1#top'>Part <b>seven</b></a> Issuance&nbsp;Date: March 4, 2024</h2>
<div><h4>Nineteen <a href="{PART}19">Nineteen</a> <a href="{PART}19">again</a>
  Issuance Date: April 9, 2024 <em>UPDATE: July 30 2024</em></h4></div>
<p><a href={PART}33>bare</a> <a HREF = "{PART}33x">no part</a> <a name="anchor">no href</a></p>
<!-- <a href="{FILES}HIDDEN_Part-1.pdf">hidden</a> -->
<ul><li><a title="q" href='{FILES}NASA_Memo_Part-4.PDF'>one</a><li><a href={FILES}DEPT-OF-DEFENSE_Part-9.pdf>two
<li><a href="{FILES}NASA_Memo_Part-4.PDF?dl=1">three</a> <a href="{FILES}a&amp;b_Parts-2-and-3.pdf">four</a>
<a href="https://elsewhere.example.com/page_file_uploads/x.pdf">five</a><abbr>tail</abbr>
</ul></body></html>"""


def page(spark, html=PAGE):
    return spark.createDataFrame([(3, ROOT, html)], "page_id long, base string, html string")


def test_links_of_every_shape_in_order(spark):
    rows = L.extract_links(page(spark)).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(len(rows)))
    assert [(r.href, r.anchor_text) for r in rows] == [
        (f"{PART}7?tab=1#top", "Part seven"), (f"{PART}19", "Nineteen"), (f"{PART}19", "again"), (f"{PART}33", "bare"),
        (f"{PART}33x", "no part"), (f"{FILES}NASA_Memo_Part-4.PDF", "one"), (f"{FILES}DEPT-OF-DEFENSE_Part-9.pdf", "two"),
        (f"{FILES}NASA_Memo_Part-4.PDF?dl=1", "three"), (f"{FILES}a&b_Parts-2-and-3.pdf", "four"),
        ("https://elsewhere.example.com/page_file_uploads/x.pdf", "five")]


def test_many_tags_in_one_anchor(spark):
    html = '<a href="/x.pdf">' + "<i>t</i> " * 20_000
    (r,) = L.extract_links(page(spark, html)).collect()
    assert r.href == "/x.pdf" and len(r.anchor_text) == 2 * 20_000 - 1


def test_headings_date_their_parts(spark):
    parts = {r.part_number: r for r in L.part_headings(page(spark)).collect()}
    assert sorted(parts) == [7, 19, 33]
    assert parts[7].overview_url == f"{ROOT}{PART}7" and parts[7].issued == "March 4, 2024" and parts[7].updated is None
    assert parts[7].title_hint == "Part seven"
    assert parts[19].issued == "April 9, 2024" and parts[19].updated == "July 30 2024" and parts[19].title_hint == "Nineteen"
    assert parts[33].issued is None and parts[33].title_hint == "bare"


def test_no_break_space_in_a_heading(spark):
    html = f'<h3><a href="{PART}2">x</a> Issuance Date:\u00a0June\u00a01,\u00a02024</h3>'
    assert L.part_headings(page(spark, html)).first().issued == "June\u00a01,\u00a02024"


def test_documents_once_with_their_names(spark):
    m = L.link_manifest(L.extract_links(page(spark), keep=("base",)), F.col("base"))
    by = {r.filename: r for r in m.collect()}
    assert set(by) == {"NASA_Memo_Part-4.PDF", "DEPT-OF-DEFENSE_Part-9.pdf", "a&b_Parts-2-and-3.pdf"}
    assert by["NASA_Memo_Part-4.PDF"].agency == "NASA" and by["NASA_Memo_Part-4.PDF"].pdf_url == f"{ROOT}{FILES}NASA_Memo_Part-4.PDF"
    assert by["DEPT-OF-DEFENSE_Part-9.pdf"].is_dod
    assert sorted((r.filename[0], r.part_number) for r in L.explode_parts(m).collect()) == [("D", 9), ("N", 4), ("a", 2), ("a", 3)]


def test_clean_text_drops_boilerplate(spark):
    html = ('<html><head><title>x</title><style>p{}</style></head><body><nav>menu</nav>'
            '<!-- c --><div class="ad">buy</div><article><h1>Title</h1><p>A &amp; B</p></article>'
            '<footer>foot</footer></body></html>')
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(L.clean_text("html")).first()[0] == "Title\nA & B"
