import random
import re
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.llm import filter_audit

SF = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    """(part, order, step) to measures, one order and document after the other."""
    fails = {}
    for k, (i, part, text) in enumerate(rows):
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        if len(words) < 200:
            f.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            f.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            f.add("C")
        if re.search(r"[#$%&*|]", t):
            f.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, _, u in rows):
            f.add("E")
        fails[k] = f
    out, shapley = {}, {}
    for part in {p or "" for _, p, _ in rows}:
        own = [k for k, r in enumerate(rows) if (r[1] or "") == part]
        for order in permutations("ABCDE"):
            left = list(own)
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in fails[k]]
                left = [k for k in left if f not in fails[k]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in fails[k] for k in own) - len(gone), sum(fails[k] == {f} for k in own),
                    sum((rows[k][0], "good") in labels for k in gone), sum((rows[k][0], "toxic") in labels for k in gone)]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {k: v + [shapley[k[0], k[1][k[2] - 1]]] for k, v in out.items()}


def result(frame):
    rows = frame.collect()
    got = {(r.part, r.filter_order, r.step): [r[m] for m in filter_audit.MEASURES] for r in rows}
    assert len(got) == len(rows)
    return got


def odd_rows():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, rng.choice(["s", "t", None, ""]), " ".join(rng.choices(words[:rng.choice([40, 400])], k=rng.choice([150, 200, 260]))) + rng.choice(["", " #", " ABCDEFGHIJKLMNOPQRSTUVWXYZABC"]))
            for i in range(60)]
    rows += [(100 + i, "s", rows[i % 7][2]) for i in range(20)]
    rows += [(200, "t", None), (201, "u", ""), (202, "u", None), (None, "t", rows[0][2]), (None, "t", rows[0][2]), (5, "t", rows[5][2]), (103, "s", rows[3][2])]
    return rows


def test_equals_brute_force(spark):
    rows = odd_rows()
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, 1), (3, None, 1), (4, 0, 0), (200, 1, None), (None, 1, 1), (999, 1, 1), (103, 0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    docs = docs.withColumn("mask", F.lit("x")).withColumn("digest", F.lit(1)).withColumn("part", F.lit(2)).withColumn("n", F.lit(3))
    flags = {(i, "good") for i, q, _ in labels if q == 1 and i is not None} | {(i, "toxic") for i, _, t in labels if t == 1 and i is not None}
    frame = filter_audit.audit(docs, spark.createDataFrame(labels, LABELS).withColumn("n", F.lit(1)))
    assert frame.columns == ["part", "filter_order", "step", *filter_audit.MEASURES]
    assert result(frame) == brute(rows, flags)


def test_query_equals_brute_force(spark):
    from quire.llm.catalog import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text").collect()]
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    flags = {(r.doc_id, "good") for r in labels if r.quality == 1} | {(r.doc_id, "toxic") for r in labels if r.toxic == 1}
    got = result(QUERIES["op13_filter_audit"](spark, SF))
    assert got == brute(rows, flags) and len(got) == 600 * len({r[1] for r in rows})


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(docs, none).count() == 0
    one = spark.createDataFrame([(1, "s", "x")], docs.schema)
    assert filter_audit.audit(one, none).count() == 600


def test_very_long_text_and_many_copies(spark):
    long = "a b " * 500_000
    rows = [(i, "s", "same text") for i in range(3000)] + [(5000, "s", long), (5001, "s", long + "c")]
    frame = filter_audit.audit(spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(8), spark.createDataFrame([], LABELS))
    got = result(frame)
    assert got["s", "EABCD", 1][:2] == [3, 2999] and got["s", "EABCD", 2][:3] == [2, 1, 2999] and got["s", "EABCD", 3][:2] == [0, 2]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aB \t\n\x0b\x0c\x1c\x85\xa0é#|"), max_size=30))
def test_words_and_marks(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    want = 1 | (100 * len(set(words)) < 50 * len(words)) << 1 | (100 * text.count("B") > 2 * len(text)) << 2 | bool(set(text) & set("#|")) << 3
    assert filter_audit.failed(text) == want


def test_min_plus_product():
    orders = ["ABCDE", "EDCBA"]
    masks = np.array([[1, 0, 0, 1, 0], [0, 0, 0, 0, 0], [0, 0, 0, 0, 1]], bool)
    assert filter_audit.removal_steps(masks, filter_audit.places(orders)).tolist() == [[0, 1], [5, 5], [4, 0]]


@pytest.mark.parametrize("hot", [True, False])
def test_lookup(spark, hot, monkeypatch):
    from quire.llm import common

    monkeypatch.setattr(common, "HOT_KEYS", 3 if hot else 1)
    rows = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1), ("c", 2), (None, 3)], "k string, x long")
    values = spark.createDataFrame([("a", 50, "A"), ("b", 1, "B"), ("z", 1, "Z")], "k string, n long, v string")
    for how in ("inner", "left"):
        got = sorted(map(str, common.lookup(rows, values, "k", "n", how).collect()))
        assert got == sorted(map(str, rows.join(values.drop("n"), "k", how).collect()))
