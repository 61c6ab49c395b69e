"""Batch equals incremental: the stream over k landed files ends in the same
keyed table as one batch run, and a rerun with no new files changes nothing."""
import pytest
from pyspark.sql import functions as F

from quire.operators.store import last_per_key
from quire.plans import incremental as P
from quire.plans.extract import document_names, model_answers
from quire.session import table
from quire.streaming import incremental as INC

from conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def land(df, path, files):
    """Write ``df`` as so many files, the arrival units of a stream."""
    df.repartition(files, "doc_id").write.parquet(path)


def folders(spark, *names):
    return [INC.scratch(spark, n) for n in names]


def test_stream_equals_batch_and_rerun_is_noop(spark):
    docs = table(spark, SF_SMALL, "documents", "doc_id", "text", "lang", "source")
    batch = last_per_key(P.extract_batch(docs), ["id"], ["doc_id"])
    src, root, ckpt = folders(spark, "t-docs", "t-state", "t-ckpt")
    land(docs, src, 3)
    assert INC.run_available(spark, src, docs.schema, P.extract_batch, root, ckpt, files_per_batch=1) >= 2
    assert rows(INC.read_state(spark, root, ["id"], ["doc_id"]).select(*batch.columns)) == rows(batch)
    assert INC.run_available(spark, src, docs.schema, P.extract_batch, root, ckpt) == 0
    assert rows(INC.read_state(spark, root, ["id"], ["doc_id"]).select(*batch.columns)) == rows(batch)


def test_new_files_add_their_rows(spark):
    docs = table(spark, SF_SMALL, "documents", "doc_id", "text", "lang", "source")
    src, root, ckpt = folders(spark, "t2-docs", "t2-state", "t2-ckpt")
    docs.where("doc_id < 100").repartition(1).write.parquet(src)
    assert INC.run_available(spark, src, docs.schema, P.extract_batch, root, ckpt) == 1
    before = INC.read_state(spark, root, ["id"], ["doc_id"]).count()
    docs.where("doc_id >= 100").repartition(1).write.mode("append").parquet(src)
    assert INC.run_available(spark, src, docs.schema, P.extract_batch, root, ckpt) == 1
    whole = last_per_key(P.extract_batch(docs), ["id"], ["doc_id"])
    state = INC.read_state(spark, root, ["id"], ["doc_id"]).select(*whole.columns)
    assert 0 < before < state.count() and rows(state) == rows(whole)
    target = INC.scratch(spark, "t2-compact")
    INC.compact(spark, root, target, ["id"], ["doc_id"])
    assert rows(INC.read_state(spark, target, ["id"], ["doc_id"]).select(*whole.columns)) == rows(whole)


def test_a_write_that_fails_loses_nothing(spark):
    """A batch that dies while it writes: all earlier rows are there, and its replay adds its own."""
    (root,) = folders(spark, "t4-state")
    one = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "id string, seq int, v string")
    two = spark.createDataFrame([("b", 2, "new"), ("c", 2, "z")], "id string, seq int, v string")
    INC.write_batch(one, root, 0)
    dying = two.withColumn("v", F.when(F.col("id") == "c", F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        INC.write_batch(dying, root, 1)
    state = spark.read.parquet(f"{root}/batch=0")
    assert rows(state) == [("a", 1, "x"), ("b", 1, "y")]
    for _ in range(2):  # written again, the same
        INC.write_batch(two, root, 1)
        assert rows(INC.read_state(spark, root, ["id"], ["seq"])) == [("a", 1, "x"), ("b", 2, "new"), ("c", 2, "z")]


def test_stream_with_model_answers(spark):
    """Model answers are an optional left-joined table: titles come from the
    model where it answered (blank titles fall back to the file name)."""
    docs = table(spark, SF_SMALL, "documents", "doc_id", "text", "lang", "source")
    model = model_answers(spark, SF_SMALL, document_names(spark, SF_SMALL))
    src, root, ckpt = folders(spark, "t3-docs", "t3-state", "t3-ckpt")
    land(docs, src, 2)
    INC.run_available(spark, src, docs.schema, P.extract_batch_with(model), root, ckpt)
    state = INC.read_state(spark, root, ["id"], ["doc_id"])
    assert "scope" in state.columns
    titles = [r["title"] for r in state.collect()]
    assert any(t.startswith("Deviation ") for t in titles)      # model titles
    assert any(t.startswith("src") for t in titles)             # file-name fallback
    assert all(t for t in titles)


VERSIONED = "id string, seq int, v string"


def arrive(spark, path, rows):
    spark.createDataFrame(rows, VERSIONED).coalesce(1).write.mode("append").parquet(path)


def test_keyed_state_over_restarts(spark):
    """Versions in any order; a batch writes only the keys that its files touch, and a restart goes on from the store."""
    src, root, ckpt = folders(spark, "k-src", "k-root", "k-ckpt")
    schema = spark.createDataFrame([], VERSIONED).schema
    go = lambda: INC.run_keyed(spark, src, schema, lambda df: df, ["id"], ["seq"], root, ckpt, 1, {"n": F.count("id")})
    arrive(spark, src, [("a", 1, "a1"), ("b", 5, "b5"), ("a", 3, "a3")])
    assert dict(go()) == {"batches": 1, "n": 2}
    arrive(spark, src, [("b", 2, "old"), ("c", 1, "c1")])  # an older version arrives late
    arrive(spark, src, [("a", 4, "a4"), (None, 1, "none")])
    counts = go()
    assert counts["batches"] == 2 and counts["n"] == 3
    assert rows(spark.read.parquet(root).where("batch > 0").select("id").where("id = 'b'")) == [("b",)]
    last = spark.read.parquet(root)
    assert {r["id"] for r in last.where(F.col("batch") == last.agg(F.max("batch")).first()[0]).collect()} == {"a", None}
    want = {("a", 4, "a4"), ("b", 5, "b5"), ("c", 1, "c1"), (None, 1, "none")}
    assert {tuple(r) for r in INC.read_keyed(spark, root, ["id"]).select("id", "seq", "v").collect()} == want
    assert dict(go()) == {"batches": 0, "n": 0}


def test_distinct_keys_over_restarts(spark):
    src, root, ckpt = folders(spark, "d-src", "d-root", "d-ckpt")
    schema = spark.createDataFrame([], VERSIONED).schema
    go = lambda: INC.run_distinct(spark, src, schema, lambda df: df.select("id", "v"), ["id"],
                                  lambda df: df.withColumn("size", F.length("v")), root, ckpt, 1, {"n": F.count("id")})
    arrive(spark, src, [("a", 1, "xx"), ("a", 2, "xx"), ("b", 1, "y")])
    assert go()["n"] == 2
    arrive(spark, src, [("a", 9, "xx"), ("c", 1, "zzz")])
    assert go()["n"] == 1
    assert rows(spark.read.parquet(root).select("id", "v", "size")) == [("a", "xx", 2), ("b", "y", 1), ("c", "zzz", 3)]


def test_nothing_downloaded_starts_nothing(spark, monkeypatch):
    """All files have landed: the extraction step is never called."""
    names = ("landing", "manifest", "manifest_progress", "deviations", "deviations_progress")
    where = dict(zip(names, folders(spark, *names)))
    P.land_versions(spark, SF_SMALL, where["landing"])
    monkeypatch.setattr(P, "_download_results", lambda urls_: urls_.select(
        "pdf_url", F.lit(404).alias("status"), F.lit(0).alias("size"), F.lit(None).cast("string").alias("exception")))
    monkeypatch.setattr(P, "run_extraction", lambda *a: pytest.fail("started"))
    assert P.pull_run(spark, SF_SMALL, where) == [("pull", True, 0), ("extract", False, 0), ("normalize", True, 0)]
    monkeypatch.undo()
    assert INC.gated({"n": 0}, "n", lambda: pytest.fail("started")) is None and INC.gated({"n": 1}, "n", lambda: 5) == 5


def test_versions_arrive_in_three_batches(spark):
    landing, root, ckpt = folders(spark, "v-landing", "v-root", "v-ckpt")
    P.land_versions(spark, SF_SMALL, landing)
    counts = P.run_extraction(spark, landing, root, ckpt)
    state = INC.read_keyed(spark, root, ["id"])
    assert counts["batches"] >= 3 and counts["written"] >= state.count()
    whole = last_per_key(P.extract_versions(spark.read.parquet(landing)), ["id"], ["version", "doc_id"])
    assert rows(state.select(*whole.columns)) == rows(whole) and state.where("version = 2").count() > 0
