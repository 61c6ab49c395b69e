import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quire.operators import crawl as C
from quire.operators import extract as X
from quire.operators import report as R
from quire.sources import files as FS


def test_run_summary_counts_and_failure_flag(spark):
    t0 = dt.datetime(2026, 4, 27, 6, 30, 0)
    rows = [("r1", t0, "p/a.pdf", None), ("r1", t0 + dt.timedelta(seconds=12.34), None, "status 404"),
            ("r1", t0 + dt.timedelta(seconds=1), None, "skipped: DoD"),
            ("r2", t0, None, "ConnectError: boom"), ("r2", t0, "p/b.pdf", None)]
    df = spark.createDataFrame(rows, "run string, ts timestamp, saved_path string, error string")
    out = {r["run"]: r for r in R.run_summary(df, ["run"]).collect()}
    a, b = out["r1"], out["r2"]
    assert (a["new_pdfs_count"], a["downloaded_count"], a["failed_count"]) == (3, 1, 2)
    assert a["has_real_failure"] is False and b["has_real_failure"] is True
    assert a["duration_sec"] == 12.3 and a["started_utc"] == "20260427T063000Z"


def test_run_manifest_write_read_round_trip(spark, scratch):
    summary = spark.createDataFrame([("r1", "2026-04-27T06:30:00", 1)],
                                    "run_id string, started_utc string, new_pdfs_count int")
    recs = spark.createDataFrame(
        [("r1", "u1", "a.pdf", "GSA", False, [1, 6], "/p/a.pdf", None),
         ("r1", "u2", "b.pdf", "DoD", True, [], None, "skipped: DoD")],
        "run_id string, pdf_url string, filename string, agency string, is_dod boolean, "
        "part_numbers array<int>, saved_path string, error string")
    FS.write_run_manifest(summary, recs, scratch + "/runs")
    back = spark.read.schema(FS.RUN_MANIFEST_SCHEMA).json(scratch + "/runs")
    got = sorted((r["filename"], list(r["part_numbers"])) for r in FS.run_records(back).collect())
    assert got == [("a.pdf", [1, 6]), ("b.pdf", [])]


def test_assemble_text_order_cap_and_bad_pages(spark):
    pages = spark.createDataFrame([("d", 3, "c"), ("d", 1, "a"), ("d", 2, None), ("d", 4, "d"), ("e", 1, "x")],
                                  "doc string, page_no int, page_text string")
    capped = {r["doc"]: r["page_text"] for r in X.assemble_text(pages, "doc", "page_no", "page_text",
                                                                 max_pages=2).collect()}
    assert capped == {"d": "a\nc", "e": "x"}
    whole = {r["doc"]: r["page_text"] for r in X.assemble_text(pages, "doc", "page_no", "page_text",
                                                                max_pages=None, sep="").collect()}
    assert whole == {"d": "acd", "e": "x"}


def test_frontier_union_and_domain_filter(spark):
    hits = spark.createDataFrame([("https://a.com/1", 1, 2), ("https://a.com/1", 2, 1),
                                  ("https://www.facebook.com/x", 1, 1), ("https://b.org/2", 2, 3)],
                                 "url string, engine_rank int, hit_rank int")
    u = {r["url"]: (r["engine_rank"], r["hit_rank"]) for r in C.frontier_union(hits).collect()}
    assert u["https://a.com/1"] == (1, 2)
    kept = {r["url"] for r in C.domain_filter(C.frontier_union(hits), list(C.SKIP_DOMAINS)).collect()}
    assert kept == {"https://a.com/1", "https://b.org/2"}
    blocked = spark.createDataFrame([("b.org",)], "domain string")
    kept2 = {r["url"] for r in C.domain_filter(C.frontier_union(hits), blocked).collect()}
    assert "https://b.org/2" not in kept2 and "https://www.facebook.com/x" in kept2


def test_should_continue():
    assert C.should_continue(5, 50, 0.1)
    assert not C.should_continue(50, 50, 0.9)
    assert not C.should_continue(21, 50, 0.3)
    assert C.should_continue(20, 50, 0.3)


def test_frontier_rounds_depths_and_stop(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 5), (1, 3)], "src long, dst long")
    seeds = spark.createDataFrame([(1,)], "node long")
    got = dict((r["node"], r["depth"]) for r in C.frontier_rounds(spark, edges, seeds, 3).collect())
    assert got == {1: 0, 2: 1, 3: 1, 4: 2, 5: 3}
    scored = spark.createDataFrame([(n, True, 0.9) for n in range(1, 6)], "node long, keep boolean, score double")
    stopped = C.frontier_rounds(spark, edges, seeds, 3, scored=scored, target=3)
    assert max(r["depth"] for r in stopped.collect()) == 1


def test_kind_distribution_and_widths(spark):
    df = spark.createDataFrame([("iso",), ("iso",), ("long",)], "k string")
    d = {r["kind"]: (r["n"], r["pct"], r["rank"]) for r in R.kind_distribution(df, "k").collect()}
    assert d == {"iso": (2, 66.7, 1), "long": (1, 33.3, 2)}
    w = spark.createDataFrame([("x" * 70, 1), (None, 123456789012)], "Title string, n long")
    widths = {r["column"]: r["width"] for r in R.column_widths(w, {"Title": 60, "n": 16}).collect()}
    assert widths == {"Title": 62, "n": 14}


def test_download_and_fetch_outcomes(spark):
    rows = [(False, 200, 5000, None), (True, None, None, None), (False, 404, 5000, None), (False, 200, 10, None),
            (False, None, None, "ConnectError: x"), (False, 200, 1024, None)]
    df = spark.createDataFrame(rows, "dod boolean, status int, size int, exc string")
    got = [r[0] for r in df.select(R.download_outcome(*map(F.col, ("dod", "status", "size", "exc")))).collect()]
    assert got == [None, "skipped: DoD", "status 404", "too small (10 bytes)", "ConnectError: x", None]
    pages = spark.createDataFrame([(200, "text/html; x", None), (500, "text/html", None), (200, "application/pdf", None),
                                   (None, None, "Timeout: y")], "status int, kind string, exc string")
    got = [r[0] for r in pages.select(R.fetch_outcome(*map(F.col, ("status", "kind", "exc")))).collect()]
    assert got == [None, "HTTP 500", "not html: application/pdf", "Timeout: y"]


def test_rounds_to_exhaustion_and_gate(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 12)] + [(12, 1)], "src long, dst long")
    seeds = spark.createDataFrame([(1,)], "node long")
    got = dict((r["node"], r["depth"]) for r in C.frontier_rounds(spark, edges, seeds).collect())
    assert got == {i: i - 1 for i in range(1, 13)}
    scored = spark.createDataFrame([(1, True, 0.5), (2, True, 0.4), (3, False, 0.9)], "node long, keep boolean, score double")
    got = sorted(r["node"] for r in C.frontier_rounds(spark, edges, seeds, scored=scored).collect())
    assert got == [1, 2, 3]  # 3 is reached but not expanded


def plain_queue(seeds, links, scores, target, batch, threshold, max_depth):
    """The crawl one batch after the other; (slot, node, batch, depth, status) and why it stopped."""
    waiting, seen, out, got, total, slot, number = list(dict.fromkeys(seeds)), set(), [], 0, 0.0, 0, 0
    depth = {n: 0 for n in waiting}
    while True:
        if not waiting:
            return out, "empty"
        taken, waiting, new = waiting[:batch], waiting[batch:], []
        fresh = [n for n in taken if n not in seen]
        for n in taken:
            if n not in fresh:
                status = "seen"
            elif n not in scores:
                status = "failed"
            else:
                keep, score = scores[n]
                status = "done" if keep and score >= threshold else "low_relevance"
            if status == "done":
                got, total = got + 1, total + scores[n][1]
                if max_depth is None or depth[n] < max_depth:
                    new += [(x, depth[n] + 1) for x in links.get(n, [])[:5]]
            out.append((slot, n, number, depth[n], status))
            slot += 1
        seen |= set(fresh)
        for x, d in new:
            if x not in waiting:
                waiting.append(x)
                depth[x] = d
        number += 1
        if got >= target:
            return out, "target"
        if got > 20 and total / got < 0.35:
            return out, "low relevance"


@pytest.mark.parametrize("nodes,batch,target,threshold,max_depth,stop", [
    (60, 4, 10_000, 0.4, None, "empty"), (200, 7, 40, 0.4, None, "target"), (200, 5, 500, 0.0, None, "low relevance"),
    (120, 20, 500, 0.4, 2, "empty"), (30, 1, 500, 0.4, None, "empty")])
def test_crawl_queue_equals_batch_after_batch(spark, nodes, batch, target, threshold, max_depth, stop):
    rng = random.Random(nodes + batch)
    links = {n: [rng.randrange(nodes) for _ in range(rng.choice([0, 2, 9]))] for n in range(nodes)}
    top = 0.4 if stop == "low relevance" else 1.0
    scores = {n: (rng.random() < 0.9, round(rng.random() * top, 2)) for n in range(nodes) if rng.random() < 0.95}
    seeds = [rng.randrange(nodes) for _ in range(6 if batch == 4 else nodes // 6)]
    seeds += seeds[:2]
    want, reason = plain_queue(seeds, links, scores, target, batch, threshold, max_depth)
    assert reason == stop
    frame = C.crawl_queue(
        spark.createDataFrame(list(zip(seeds, range(len(seeds)))), "node long, ord long"),
        spark.createDataFrame([(a, i, b) for a, bs in links.items() for i, b in enumerate(bs)], "src long, pos long, dst long"),
        spark.createDataFrame([(n, k, s) for n, (k, s) in scores.items()], "node long, keep boolean, score double"),
        target, batch=batch, threshold=threshold, max_depth=max_depth)
    rows = frame.collect()
    assert {r.stop_reason for r in rows} == {reason}
    assert sorted((r.slot, r.node, r.batch, r.depth, r.status) for r in rows) == want
    if nodes == 120:
        assert any(r.status == "seen" for r in rows)


def test_crawl_queue_without_seeds(spark):
    none = spark.createDataFrame([], "node long, ord long")
    links = spark.createDataFrame([], "src long, pos long, dst long")
    scored = spark.createDataFrame([], "node long, keep boolean, score double")
    assert C.crawl_queue(none, links, scored, 5).count() == 0
