import time

import pytest

from quire.operators import sections as SEC

# own text: two numbers, one repeated with another title, every end marker
TEXT = ("Preface without a number.\n"
        "52.301-9 Glass Jars.\nUse as told in 3.1, insert the following clause:\nGlass Jars (Feb 2019)\nKeep lids on.\n(End of Clause)\nloose end\n"
        "52.301-10 Tin Boxes and\ttrays.\ninsert the following provision in all bids (MARCH 2021)\nStack them.\n(end of provision)\n"
        "52.301-9 Glass Jars again.\nother words\n(End of solicitation provision)\n")


def clauses(spark, text, first_only=True, **windows):
    df = spark.createDataFrame([(1, text)], "doc long, text string")
    s = SEC.segment(df, keep=("doc",), first_only=first_only)
    return SEC.clause_fields(s, **windows).orderBy("pos").collect()


def test_fields_of_all_sections(spark):
    a, b, c = clauses(spark, TEXT, first_only=False)
    assert (a.number, a.title, a.kind, a.effective_date) == ("52.301-9", "Glass Jars", "Clause", "Feb 2019")
    assert (b.number, b.title, b.kind, b.effective_date) == ("52.301-10", "Tin Boxes and\ttrays", "Provision", "MARCH 2021")
    assert (c.number, c.title, c.kind, c.effective_date) == ("52.301-9", "Glass Jars again", "Provision", None)
    assert a.full_text.endswith("(End of Clause)") and b.full_text.endswith("(end of provision)")


def test_the_first_of_a_number_stays(spark):
    kept = clauses(spark, TEXT)
    assert [(r.number, r.pos) for r in kept] == [("52.301-9", 0), ("52.301-10", 1)]
    assert "lids" in kept[0].full_text


def test_windows_bound_where_phrases_count(spark):
    text = "52.1-2 Far.\n" + "x" * 700 + " insert the following clause " + "y" * 900 + " (May 2020)\n"
    (near,) = clauses(spark, text)
    assert near.kind == "Unknown" and near.effective_date is None
    (far,) = clauses(spark, text, kind_window=2000, date_window=2000)
    assert far.kind == "Clause" and far.effective_date == "May 2020"


@pytest.mark.parametrize("text,numbers", [
    ("52.7-1\n52.8-2 Moo.\n", [("52.7-1", "52")]), ("[52.7-1 Listed.\n", []), ("52.7-1 no period\n", []),
    ("a\r\n52.7-1 Carriage.\r\nb", [("52.7-1", "Carriage")]), ("", []), ("52.7-1 Only.", [("52.7-1", "Only")])])
def test_headings(spark, text, numbers):
    assert [(r.number, r.title) for r in clauses(spark, text)] == numbers


def test_control_characters_make_no_section(spark):
    assert [r.number for r in clauses(spark, "52.7-1 One.\nmid\x01dle\x0152.9-9 not a line start.\n")] == ["52.7-1"]


def test_many_sections_in_linear_time(spark):
    def seconds(first_only):
        text = "".join(f"52.{i % 3000}-{i % 7} Title {i}.\nbody\n" for i in range(4000))
        df = spark.createDataFrame([(1, text)], "doc long, text string")
        SEC.segment(df, keep=("doc",), first_only=first_only).count()
        began = time.perf_counter()
        n = SEC.segment(df, keep=("doc",), first_only=first_only).selectExpr("count(*)", "sum(length(section))").first()[0]
        return n, time.perf_counter() - began

    (n, plain), (kept, dedup) = seconds(False), seconds(True)
    assert n == 4000 and kept == len({(i % 3000, i % 7) for i in range(4000)}) and dedup < 2 * plain + 1
