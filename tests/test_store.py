import pytest
from pyspark.sql import functions as F

from quire.operators import extract as X
from quire.operators import store


def test_upsert_last_wins_and_new_columns(spark):
    cur = spark.createDataFrame([("a", 1, "old"), ("b", 1, "keep")], "k string, seq int, v string")
    new = spark.createDataFrame([("a", 2, "new", 9), ("c", 2, "add", 7)], "k string, seq int, v string, w int")
    out = {r["k"]: r for r in store.upsert(cur, new, ["k"], ["seq"]).collect()}
    assert out["a"]["v"] == "new" and out["a"]["w"] == 9
    assert out["b"]["v"] == "keep" and out["b"]["w"] is None
    assert out["c"]["v"] == "add"


def test_upsert_idempotent(spark):
    cur = spark.createDataFrame([("a", 1, "x")], "k string, seq int, v string")
    new = spark.createDataFrame([("a", 2, "y"), ("b", 2, "z")], "k string, seq int, v string")
    once = store.upsert(cur, new, ["k"], ["seq"])
    twice = store.upsert(once, new, ["k"], ["seq"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_insert_if_absent_first_wins(spark):
    cur = spark.createDataFrame([("u1", "done")], "url string, status string")
    new = spark.createDataFrame([("u1", "pending"), ("u2", "pending")], "url string, status string")
    out = dict(store.insert_if_absent(cur, new, ["url"]).collect())
    assert out == {"u1": "done", "u2": "pending"}


def test_keyed_update(spark):
    cur = spark.createDataFrame([("u1", "pending", 0), ("u2", "pending", 0)], "url string, status string, depth int")
    upd = spark.createDataFrame([("u1", "done")], "url string, status string")
    out = {r["url"]: (r["status"], r["depth"]) for r in store.keyed_update(cur, upd, ["url"], ["status"]).collect()}
    assert out == {"u1": ("done", 0), "u2": ("pending", 0)}


def test_cache_resolve(spark):
    from quire.functions.urls import url_hash

    fresh = spark.createDataFrame([("https://example.com/cached-page", None, "status 500")],
                                  "url string, html string, error string")
    cache = spark.createDataFrame([("https://example.com/cached-page", "<html>cached body</html>")],
                                  "url string, html string").select(url_hash("url").alias("url_hash"), "html")
    hit = X.cache_resolve(fresh, cache, use_cache=True).first()
    assert hit["html"] == "<html>cached body</html>" and hit["error"] is None
    miss = X.cache_resolve(fresh, cache, use_cache=False).first()
    assert miss["html"] is None and miss["error"]


def test_merge_fields_model_and_fallback(spark):
    text = "x" * 200 + " Class Deviation 25-01 supersedes"
    docs = spark.createDataFrame([
        ("u1", "GSA", "GSA_a.pdf", text), ("u2", "GSA", "GSA_b.pdf", text + " effective 2025-10-15"),
        ("u3", "GSA", "GSA_c.pdf", text), ("u4", "GSA", "GSA_d.pdf", "short")],
        "pdf_url string, agency string, filename string, text string")
    model = spark.createDataFrame([
        ("u1", '{"deviations": [{"agency": "GSA", "deviation_number": "n", "title": "T1", "scope": "S1", "effective_date": "March 3, 2026"}]}'),
        ("u3", '{"deviations": [{"agency": "DoD", "deviation_number": "n", "title": "x"}]}')], "pdf_url string, response string")
    out = {r["link"]: r for r in X.merge_fields(docs, model).collect()}
    assert set(out) == {"u1", "u2"}  # u3 names DoD, u4 too short
    assert out["u1"]["title"] == "T1" and out["u1"]["effective_date"] == "March 3, 2026"
    assert out["u2"]["title"] == "GSA b" and out["u2"]["effective_date"] == "2025-10-15"
    assert out["u1"]["id"] == "GSA|25-01"
    incremental = {r["link"]: r for r in X.merge_fields(docs, model, take_model_date=False, drop_dod=False).collect()}
    assert set(incremental) == {"u1", "u2", "u3"} and incremental["u1"]["effective_date"] is None


@pytest.mark.parametrize("answer,title", [
    ('{"deviations": [{"agency": "A", "deviation_number": "1", "title": "t"}]}', "t"),
    ('{"deviations": [{"agency": "A", "deviation_number": "1", "title": "t", "scope": null}]}', "t"),
    ('{"deviations": [{"agency": "A", "title": "no number"}]}', None),
    ('{"deviations": [{"agency": "A", "deviation_number": null, "title": "t"}]}', None),
    ('{"deviations": [{"agency": "A", "deviation_number": 7, "title": "t"}]}', None),
    ('{"deviations": [{"agency": "A", "deviation_number": "1", "title": "t", "scope": 5}]}', None),
    ('{"deviations": [{"agency": "A", "deviation_number": "1", "title": "t"}, {"agency": "B"}]}', None),
    ('{"deviations": ["x"]}', None), ('{"deviations": []}', None), ('{"deviations": 3}', None), ("{}", None), ("no", None), (None, None)])
def test_model_answers_with_all_required_fields_count(spark, answer, title):
    df = spark.createDataFrame([(answer,)], "r string").select(X.parse_model_deviation("r").alias("m"))
    assert df.select("m.title").first()[0] == title


def test_global_rank_partitioned_path(spark):
    from pyspark.sql import functions as F
    from quire.operators.report import global_rank

    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.col("id").alias("v"))
    ranked = global_rank(df.repartition(7), [F.col("k").desc()], ["k"])
    assert ranked.columns == ["k", "v", "rank"]
    a = sorted((r["k"], r["rank"]) for r in ranked.collect())
    assert [r for _, r in sorted(a, key=lambda x: -x[0])] == list(range(1, 5001))


def test_glob_match_join_exact(spark):
    import fnmatch

    from quire.operators.join import glob_match_join

    ids = ["GSA|25-01", "DOD|CD-2025-04", "ED|7", "A|", "|X", "GS|25", "GSA", "NO_PIPE_AT_ALL", "A_VERY_LONG_AGENCY_NAME|1"]
    names = ["h_GSA_Class_Deviation_25-01.pdf", "h_DOD_CD-2025-04_memo.pdf", "x_MED_7.pdf",
             "abc_A_b.pdf", "noscore.pdf", "h_GS_25.pdf", "h_X_GSA_25.pdf", "_X.pdf",
             "q_A_VERY_LONG_AGENCY_NAME_1.pdf", "q_A_VERY_LONG_AGENCY_NOME_1.pdf"]
    rows = spark.createDataFrame([(i,) for i in ids], "id string")
    files = spark.createDataFrame([(n,) for n in names], "filename string")
    got = sorted((r["id"], r["filename"]) for r in glob_match_join(rows, files).collect())
    want = sorted((i, n) for i in ids for n in names if "|" in i  # an id without a pipe matches nothing
                  and fnmatch.fnmatchcase(n, "*_" + i.split("|", 1)[0] + "*" + i.split("|", 1)[1] + "*"))
    assert got == want and any(i.startswith("A_VERY") for i, _ in got)


def test_conform_and_stamp(spark):
    import datetime as dt

    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()),
                           T.StructField("iso", T.DateType())])
    df = spark.createDataFrame([("a", "5")], "id string, n string")
    out = store.conform(df, schema)
    assert out.schema == schema and out.first() == ("a", 5, None)
    ts = dt.datetime(2026, 4, 27, 6, 30)
    assert store.stamp(df, "scraped_at", ts).first()["scraped_at"] == ts


def test_glob_match_join_random_vs_brute_force(spark):
    import fnmatch
    import random

    from quire.operators.join import glob_match_join

    rnd = random.Random(7)
    alpha = "AB_1-"

    def word(lo, hi):
        return "".join(rnd.choice(alpha) for _ in range(rnd.randint(lo, hi)))

    ids = sorted({word(0, 3) + "|" + word(0, 5) for _ in range(60)})
    names = sorted({word(1, 12) for _ in range(120)})
    rows = spark.createDataFrame([(i,) for i in ids], "id string")
    files = spark.createDataFrame([(n,) for n in names], "filename string")
    got = sorted((r["id"], r["filename"]) for r in glob_match_join(rows, files).collect())
    want = sorted((i, n) for i in ids for n in names
                  if fnmatch.fnmatchcase(n, "*_" + i.split("|", 1)[0] + "*" + i.split("|", 1)[1] + "*"))
    assert got == want


def test_validate_counts_observed(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([(1, '{"k": 1}'), (2, "nope"), (3, '{"j": 2}')], "id int, r string")
    obs = Observation("v")
    out = X.validate(df, "r", {"k": "int"}, observation=obs)
    assert [r["id"] for r in out.collect()] == [1]
    assert obs.get == {"accepted": 1, "rejected": 2}


def test_append_and_refresh_a_table(spark, scratch):
    path = scratch + "/t"
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "x"), (3, "c"), (None, "n")], "k int, v string")
    current = store.append_table(old, path)
    fresh = store.absent_rows(current, new, ["k"])
    rows = sorted(map(str, fresh.collect()))
    assert sorted(r.v for r in store.append_table(spark.createDataFrame(fresh.collect(), fresh.schema), path).collect()) == ["a", "b", "c", "n"]
    assert len(rows) == 2 and sorted(r.v for r in store.refresh_table(new, path).collect()) == ["c", "n", "x"]
    assert store.refresh_table(new.limit(0), path).count() == 0
