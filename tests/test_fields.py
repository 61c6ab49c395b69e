import pytest
from pyspark.sql import functions as F

from quire.functions import fields, urls

NAMES = [
    ("GSA_Class_Deviation_Parts-1-6.pdf", "GSA", False, [1, 6]),
    ("USAID_RFO_Deviation_Parts-1-6-10-11.pdf", "USAID", False, [1, 6, 10, 11]),
    ("DOD_Deviation_Part-12.pdf", "DoD", True, [12]),
    ("GSA_Deviation_Part-12.pdf", "GSA", False, [12]),
    ("mystery.pdf", "Unknown", False, []),
    ("no_part_info.pdf", "Unknown", False, []),
    ("USDA_Revised_Parts-1.pdf", "ED", False, [1]),
    ("DEFENSE_Part_3.pdf", "Unknown", True, [3]),
    ("GSA_Parts-1-6_v2.pdf", "GSA", False, []),
]


def test_agency_flag_parts(spark):
    df = spark.createDataFrame([(n,) for n, *_ in NAMES], "filename string")
    out = df.select("filename", fields.agency_label("filename").alias("agency"),
                    fields.is_dod("filename").alias("dod"),
                    fields.parts_from_filename("filename").alias("parts")).collect()
    got = {r["filename"]: (r["agency"], r["dod"], list(r["parts"])) for r in out}
    for name, agency, dod, parts in NAMES:
        assert got[name] == (agency, dod, parts), name


TEXTS = [
    ("Effective Date: October 15, 2025\n...", "October 15, 2025"),
    ("This deviation is effective on March 3, 2026.", "March 3, 2026"),
    ("effective 2025-10-15", "2025-10-15"),
    ("effective: 10/15/2025", "10/15/2025"),
    ("no dates here", None),
    ("effective 2025-10-15 later the effective date: May 1, 2026", "May 1, 2026"),
]


def test_effective_date(spark):
    df = spark.createDataFrame(TEXTS, "text string, want string")
    for r in df.select("want", fields.effective_date("text").alias("got")).collect():
        assert r["got"] == r["want"]


NUMS = [
    ("Class Deviation CD-2025-04 is issued", None, "CD-2025-04"),
    ("Class Deviation 25-01 supersedes...", None, "25-01"),
    ("nothing to match", "GSA_dev.pdf", "GSA_dev.pdf"),
    ("nothing to match", None, None),
    ("this deviation notice", None, "tice"),
]


def test_deviation_number(spark):
    df = spark.createDataFrame(NUMS, "text string, fname string, want string")
    for r in df.select("want", fields.deviation_number("text", F.col("fname")).alias("got")).collect():
        assert r["got"] == r["want"]


def test_safe_filename(spark):
    url = "https://www.example.gov/sites/default/files/page_file_uploads/GSA%20Dev (1).pdf"
    df = spark.createDataFrame([(url,), (url,)], "url string")
    a, b = [r[0] for r in df.select(urls.safe_filename("url")).collect()]
    assert a == b
    h, name = a.split("_", 1)
    assert len(h) == 16 and " " not in name and "(" not in name
    import hashlib
    assert h == hashlib.sha256(url.encode()).hexdigest()[:16]


@pytest.mark.parametrize("href,base,want", [
    ("/a/b.pdf", "https://www.example.gov", "https://www.example.gov/a/b.pdf"),
    ("https://x.org/y.pdf", "https://www.example.gov/g", "https://x.org/y.pdf"),
    ("//cdn.org/z.pdf", "https://www.example.gov/g", "https://cdn.org/z.pdf"),
    ("c.pdf", "https://h.org/dir/page", "https://h.org/dir/c.pdf"),
])
def test_resolve(spark, href, base, want):
    df = spark.createDataFrame([(href, base)], "href string, base string")
    assert df.select(urls.resolve("href", "base")).first()[0] == want


def test_json_from_text(spark):
    from quire.operators.extract import json_fields

    rows = [("reasoning... {\"title\": \"T\", \"scope\": \"S\"} done", "T", "S"),
            ("no json here", "", ""),
            ("{\"title\": \"only\"}", "only", ""),
            ("{broken", "", "")]
    df = spark.createDataFrame(rows, "t string, a string, b string")
    for r in df.select("a", "b", json_fields(F.col("t"), ["title", "scope"]).alias("f")).collect():
        assert (r["f"]["title"], r["f"]["scope"]) == (r["a"], r["b"])


def test_no_break_spaces_in_fields(spark):
    df = spark.createDataFrame([("x effective\u00a0date:\u00a0May 3, 2024 Class\u00a0Deviation\u00a025-07",)], "t string")
    assert df.select(fields.effective_date("t")).first()[0] == "May 3, 2024"
    assert df.select(fields.deviation_number("t")).first()[0] == "25-07"
    assert df.select(fields.deviation_number(F.col("t"))).first()[0] == "25-07"


def test_patterns_on_the_rest_of_a_text_equal_patterns_on_all_of_it(spark):
    """Passing over the text from the first key word on finds the same."""
    import random
    rng = random.Random(3)
    words = ["effective", "EFFECTIVE", "effectıve", "date", ":", "on", "May 4, 2025", "5/6/2025", "2025-01-02", "Class", "CLAſS", "Deviation", "deviation notice", "CD", "cd#ab-2024-1",
             "CD-DHS-2024-07A", "(Number 2024-1)", "No. A-1", " ", "\n", "2023-5", "x", "abcd-1", "classdeviation"]
    texts = [rng.choice(["", " ", "\U0001f600 "]).join(rng.choices(words, k=rng.randint(0, 9))) + " ".join(rng.choices(words, k=6)) for _ in range(2000)] + [None, ""]
    df = spark.createDataFrame([(i, t, "f.pdf") for i, t in enumerate(texts)], "id int, text string, filename string").repartition(4)
    got = df.select("id", fields.effective_date("text").alias("a"), fields.deviation_number("text", "filename").alias("b"),
                    fields.effective_date(F.col("text")).alias("c"), fields.deviation_number(F.col("text"), F.col("filename")).alias("d"),
                    fields.first_match("text", fields.EFFECTIVE_PATTERNS).alias("wa"),
                    fields.first_match("text", fields.DEVIATION_NUM_PATTERNS, "filename").alias("wb")).collect()
    assert sum(r.wa is not None for r in got) > 200 and sum(r.wb != "f.pdf" for r in got) > 200
    for r in got:
        assert (r.a, r.b, r.c, r.d) == (r.wa, r.wb, r.wa, r.wb), texts[r.id]


def test_manifest_profile_reads_whole_texts(spark, scratch):
    """An agency far behind the start of a text tells in the profile; a null text has a row and no agency."""
    from quire.plans.links import manifest_profile

    far = "plain words " * 3000
    spark.createDataFrame([(1, far + "NASA", "a", "en", 5), (2, far + "Defense", "a", "en", 5), (3, far, "a", "en", 5), (4, None, "a", "en", 5),
                           (5, far + "peace-corps", "a", None, 5)],
                          "doc_id long, text string, source string, lang string, n_chars long").write.parquet(f"{scratch}/documents.parquet")
    got = {r["lang"]: tuple(r)[1:] for r in manifest_profile(spark, scratch).collect()}
    assert got == {"en": (4, 2, "NASA, Unknown"), None: (1, 1, "Peace Corps")}
