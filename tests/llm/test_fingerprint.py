import hashlib
import re

from pyspark.sql import functions as F

from quire.llm import fingerprint
from quire.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def plain_fingerprint(text):
    tree = [[[md5(x) for x in re.findall(r"[^.!?]{1,120}[.!?]* ?|[.!?]+ ?", p)] for p in s.split("\n")] for s in (text or "").split("\n\n")]
    root = md5("".join(md5("".join(md5("".join(p)) for p in s)) for s in tree))
    return root + ":" + ";".join(",".join(".".join(h[:8] for h in p) for p in s) for s in tree)


def plain_likeness(a, b):
    x, y = (set(re.findall("[0-9a-f]+", f.split(":")[1])) for f in (a, b))
    return 1.0 if a.split(":")[0] == b.split(":")[0] else 2 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


def check(rows, got):
    """rows: (doc_id, text) with distinct pairs in the order of the operator."""
    by_key = {(r.doc_id, r.fingerprint): r for r in got}
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        r = by_key[i, plain_fingerprint(text)]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.edited_fingerprint == plain_fingerprint(edited)
        assert r.near_edited == plain_likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == plain_likeness(r.fingerprint, plain_fingerprint(after))


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op1_merkle_fingerprints"](spark, SF).collect()
    assert len(got) == len(rows)
    check(sorted(rows, reverse=True), got)
    near = sum(r.near_edited > r.near_next for r in got)
    assert near > 0.9 * len(got)


def test_odd_rows(spark):
    rows = [(9, "a. b. c.\n\nd? e!\nf", "x"), (9, "a. b. c.\n\nd? e!\nf", "x"), (-3, None, None), (7, "", "x"), (5, "é" * 7 + "😀" * 5, "x"),
            (4, "\n\n\n", "x"), (2**63 - 1, "x" * 1000, ""), (-2**63, "...", "y"), (1, "w " * 200_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string").withColumn("fingerprint", F.lit(1)).repartition(4)
    got = fingerprint.compare_edited(docs).collect()
    assert len(got) == len(rows) and sum(r.doc_id == 9 for r in got) == 2
    check(sorted({(i, t) for i, t, _ in rows}, key=lambda r: -r[0]), got)
    assert fingerprint.compare_edited(docs.filter("false")).count() == 0


def test_null_ids_ties_and_a_single_document(spark):
    rows = [(None, "first text. x"), (3, "second text. y"), (3, "third text. z"), (2, "fourth")]
    got = fingerprint.compare_edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    tied = sorted(rows[1:3], key=lambda r: "3 " + md5(r[1]))
    check([*tied, rows[3], rows[0]], got)
    one = fingerprint.compare_edited(spark.createDataFrame([(1, "only one. here")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.n_chars == 14


def test_order_is_right_over_many_partitions(spark):
    rows = [((i * 7919) % 5003, f"text {i}. " * 3) for i in range(3000)]
    got = fingerprint.compare_edited(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    check(sorted(rows, key=lambda r: (-r[0], f"{r[0]} {md5(r[1])}")), got)


def test_branches_locate_an_edit(spark):
    a = "One. Two. Three.\n\nFour. Five.\nSix."
    b = "One. Two. Three.\n\nFour. Other.\nSix."
    r = spark.createDataFrame([(a, b)], "a string, b string").select(
        fingerprint.fingerprint(F.col("a")).alias("x"), fingerprint.fingerprint(F.col("b")).alias("y")).select(
        "x", "y", fingerprint.first_difference(F.col("x"), F.col("y")).alias("at"),
        fingerprint.likeness(F.col("x"), F.col("y")).alias("near")).first()
    assert r.at == 4 and r.near == 2 * 5 / 12
    s, t = (v.split(":")[1].split(";") for v in (r.x, r.y))
    assert s[0] == t[0] and s[1].split(",")[1] == t[1].split(",")[1] and s[1].split(",")[0] != t[1].split(",")[0]


def test_only_native_operators(spark):
    plan = QUERIES["op1_merkle_fingerprints"](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
