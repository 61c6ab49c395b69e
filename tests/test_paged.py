"""Sections of paged documents against the split of the joined text."""
import random
import re

import pytest
from pyspark.sql import functions as F

from quire.operators import paged
from quire.operators import sections as SEC

HEADING = re.compile(SEC.SECTION_RE.replace(r"\s", r"[ \t\n\x0b\f\r]"), re.M)


def plain(text):
    marks = list(HEADING.finditer(text))
    ends = [m.start() for m in marks[1:]] + [len(text)]
    return [(i, m[1], m[2].strip(), text[m.start():e]) for i, (m, e) in enumerate(zip(marks, ends))]


def found(spark, docs):
    rows = [(d, i, t) for d, pages in docs.items() for i, t in pages]
    df = spark.createDataFrame(rows, "doc_id long, page_no long, text string").repartition(5)
    chunks = paged.segment_pages(df).collect()
    assert len({(r.doc_id, r.pos, r.page_no) for r in chunks}) == len(chunks)
    out = {d: [] for d in docs}
    for r in sorted(chunks, key=lambda r: (r.doc_id, r.pos, r.page_no)):
        own = out[r.doc_id]
        if r.number is not None:
            own.append((r.pos, r.number, r.title, r.chunk))
        else:
            own[-1] = (*own[-1][:3], own[-1][3] + r.chunk)
    return out


def want(docs):
    return {d: plain("\n".join(t for _, t in sorted(pages) if t is not None)) for d, pages in docs.items()}


LINES = ["52.1-1", "52.2-2 Foo bar. text", "plain line", "", "   ", "52.3-3 no period here", "Title of it. And more", ". starts with a period", "52.4-4  ", "  52.5-5 not at the start. x",
         "52.6-6 A. 52.7-7 B.", "x 52.8-8", "52.9-9 \t", "\u0001marks\u0002 52.1-1"]


@pytest.mark.parametrize("run", [2, 3, 1000])
def test_random_pages_equal_the_joined_text(spark, run, monkeypatch):
    monkeypatch.setattr(paged, "RUN", run)
    rng = random.Random(run)
    docs = {}
    for d in range(250):
        numbers = sorted(rng.sample(range(40), rng.randint(1, 9)))
        docs[d] = [(i, None if rng.random() < 0.05 else "\n".join(rng.choices(LINES, k=rng.choice([1, 1, 1, 2, 3])))) for i in numbers]
    clean = {d: [(i, None if t is None else t.translate({1: None, 2: None, 3: None})) for i, t in pages] for d, pages in docs.items()}
    got, expected = found(spark, docs), want(clean)
    for d in docs:
        assert got[d] == expected[d], docs[d]
    assert sum(map(len, expected.values())) > 300


@pytest.mark.parametrize("pages,heads", [
    (["52.1-1", "Title. x"], [("52.1-1", "Title")]),
    (["52.1-1", "", " \n", "Title. x"], [("52.1-1", "Title")]),
    (["52.1-1", "52.2-2", "52.3-3", "Title."], [("52.1-1", "52"), ("52.3-3", "Title")]),
    (["52.1-1", "52.2-2", "52.3-3", "52.4-4", "x"], [("52.1-1", "52"), ("52.3-3", "52")]),
    (["52.1-1\n52.2-2", "Title."], [("52.1-1", "52")]),
    (["52.1-1", "52.2-2\n52.3-3", "Title."], [("52.1-1", "52"), ("52.3-3", "Title")]),
    (["52.1-1", "no period", "Title."], []),
    (["52.1-1"], []),
    (["a 52.1-1", "Title."], []),
])
def test_headings_across_pages(spark, monkeypatch, pages, heads):
    for run in (1, 2, 1000):
        monkeypatch.setattr(paged, "RUN", run)
        docs = {1: list(enumerate(pages))}
        got = found(spark, docs)
        assert [(n, t) for _, n, t, _ in got[1]] == heads and got == want(docs)


def test_first_of_each_number_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "52.1-1 A. x\n52.2-2 B. y"), (1, 1, "52.1-1 C. z")], "doc_id long, page_no long, text string")
    s = paged.segment_pages(df)
    assert sorted(tuple(r) for r in paged.paged_headings(s, first_only=True).collect()) == [(1, 0, "52.1-1", "A"), (1, 1, "52.2-2", "B")]
    assert paged.paged_headings(s).count() == 3 and paged.segment_pages(df.where("false")).count() == 0


def test_one_document_of_many_pages(spark, monkeypatch):
    monkeypatch.setattr(paged, "RUN", 50)
    df = spark.range(20_000).select(F.lit(1).alias("doc_id"), F.col("id").alias("page_no"),
                                    F.when(F.col("id") % 100 == 99, F.concat(F.lit("end\n52.7-"), F.col("id"))).otherwise(F.lit("Line of text. More")).alias("text"))
    lengths = {r["pos"]: r["n"] for r in paged.segment_pages(df).groupBy("pos").agg(F.sum(F.length("chunk")).alias("n")).collect()}
    text = "\n".join(f"end\n52.7-{i}" if i % 100 == 99 else "Line of text. More" for i in range(20_000))
    assert lengths == {i: len(s) for i, _, _, s in plain(text)} and len(lengths) == 199
