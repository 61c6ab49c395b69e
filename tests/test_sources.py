import csv
import glob
import json
import os

import pytest

from quire.operators import manifest as M
from quire.sources import files as FS


def test_listing_reads_metadata_only(spark, scratch):
    for name, size in (("a.pdf", 10), ("b.pdf", 2000), ("c.txt", 5)):
        with open(os.path.join(scratch, name), "wb") as f:
            f.write(b"x" * size)
    df = FS.list_files(spark, scratch)
    assert sorted((r["name"], r["length"]) for r in df.collect()) == [("a.pdf", 10), ("b.pdf", 2000)]
    assert "content" not in df.columns


ROWS = [("f2.pdf", "h2", 'a "quoted", name.pdf', "", "1;6", "0", "u2", "10"), ("f3.pdf", "", "two\nlines", " x ", "", "", "", "0"),
        ("f1.pdf", "h1", "back\\slash", "GSA", "", "1", "u1", "20")]


def test_manifest_csv_round_trip(spark, scratch):
    df = spark.createDataFrame(ROWS, FS.MANIFEST_SCHEMA)
    FS.write_manifest_csv(df, scratch + "/m")
    back = FS.read_manifest_csv(spark, scratch + "/m")
    assert back.columns == list(M.CSV_HEADER)
    assert sorted(map(tuple, back.collect())) == sorted(ROWS)


def test_manifest_csv_as_other_programs_write_it(spark, scratch):
    with open(scratch + "/theirs.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(M.CSV_HEADER)
        w.writerows(ROWS)
    assert sorted(map(tuple, FS.read_manifest_csv(spark, scratch + "/theirs.csv").collect())) == sorted(ROWS)
    FS.write_manifest_csv(spark.createDataFrame(ROWS, FS.MANIFEST_SCHEMA), scratch + "/ours")
    (ours,) = glob.glob(scratch + "/ours/part-*.csv")
    with open(ours, newline="") as f:
        assert sorted(map(tuple, list(csv.reader(f))[1:])) == sorted(ROWS)


def test_rebuild_has_one_row_for_a_name(spark):
    listing = spark.createDataFrame([("h_a.pdf", 5), ("h_a.pdf", 5), ("h_b.pdf", 7)], "name string, length long")
    old = [("h_a.pdf", "h", "first.pdf", "", "", "", "", "1", 0), ("h_a.pdf", "h", "last.pdf", "", "", "", "", "1", 1)]
    existing = spark.createDataFrame(old, ", ".join(f"{c} string" for c in M.CSV_HEADER) + ", line int")
    none = spark.createDataFrame([], "on_disk_filename string, url_hash string, original_filename string, agency string, "
                                     "part_numbers string, is_dod string, source_url string")
    got = {r.on_disk_filename: r.original_filename for r in M.rebuild(listing, existing, none).collect()}
    assert got == {"h_a.pdf": "last.pdf", "h_b.pdf": "b.pdf"}
    kept = M.kept_rows(existing, listing).collect()
    assert [(r.on_disk_filename, r.original_filename) for r in kept] == [("h_a.pdf", "last.pdf")]


def test_latest_run(spark):
    runs = spark.createDataFrame([("2026-01-01", 2), ("2026-01-03", 0), ("2026-01-02", 1)], "started_utc string, new_pdfs_count int")
    assert [r.started_utc for r in FS.latest_run(runs).collect()] == ["2026-01-02"]


def test_run_manifest_read(spark, scratch):
    doc = {"started_utc": "2026-04-27T06:30:00+00:00", "finished_utc": "x", "duration_sec": 1.5,
           "guide_url": "g", "total_pdfs_on_guide": 3, "new_pdfs_count": 2, "downloaded_count": 1,
           "failed_count": 1,
           "new_pdfs": [{"pdf_url": "u1", "filename": "a.pdf", "agency": "GSA", "is_dod": False,
                         "part_numbers": [1], "saved_path": "/p/a.pdf", "error": None},
                        {"pdf_url": "u2", "filename": "b.pdf", "agency": "DoD", "is_dod": True,
                         "part_numbers": [], "saved_path": None, "error": "skipped: DoD"}]}
    with open(os.path.join(scratch, "new_pdfs_1.json"), "w") as f:
        json.dump(doc, f, indent=2)
    recs = FS.run_records(FS.read_run_manifests(spark, scratch))
    got = sorted((r["filename"], r["saved_path"], r["error"]) for r in recs.collect())
    assert got == [("a.pdf", "/p/a.pdf", None), ("b.pdf", None, "skipped: DoD")]


def test_rebuild_precedence(spark):
    listing = spark.createDataFrame([("0123456789abcdef_X.pdf", 2048), ("nohash.pdf", 10)],
                                    "name string, length long")
    existing = spark.createDataFrame([("0123456789abcdef_X.pdf", "", "", "GSA", "", "", "", "1")],
                                     FS.MANIFEST_SCHEMA)
    db = spark.createDataFrame([("0123456789abcdef_X.pdf", "0123456789abcdef", "X.pdf", "OPM", "1;6", "1", "u")],
                               "on_disk_filename string, url_hash string, original_filename string, "
                               "agency string, part_numbers string, is_dod string, source_url string")
    out = {r["on_disk_filename"]: r for r in M.rebuild(listing, existing, db).collect()}
    a = out["0123456789abcdef_X.pdf"]
    assert (a["url_hash"], a["original_filename"], a["agency"], a["part_number"], a["is_dod"]) == (
        "0123456789abcdef", "X.pdf", "GSA", "1;6", "1")
    assert a["pdf_size_bytes"] == "2048"
    b = out["nohash.pdf"]
    assert (b["url_hash"], b["original_filename"], b["agency"], b["is_dod"]) == ("nohash.pdf", "nohash.pdf", "", "0")


def test_sync_report(spark):
    man = spark.createDataFrame([("a",), ("b",)], "on_disk_filename string")
    disk = spark.createDataFrame([("b",), ("c",)], "name string")
    got = dict(M.sync_report(man, disk).collect())
    assert got == {"a": "removed", "b": "kept", "c": "missing"}


def test_rebuild_blank_derived_values_stay_blank(spark):
    listing = spark.createDataFrame([("_lead.pdf", 5), ("tail_", 5)], "name string, length long")
    empty = spark.createDataFrame([], FS.MANIFEST_SCHEMA)
    db = spark.createDataFrame([], "on_disk_filename string, url_hash string, original_filename string, "
                                   "agency string, part_numbers string, is_dod string, source_url string")
    out = {r["on_disk_filename"]: r for r in M.rebuild(listing, empty, db).collect()}
    assert out["_lead.pdf"]["url_hash"] == "" and out["_lead.pdf"]["original_filename"] == "lead.pdf"
    assert out["tail_"]["url_hash"] == "tail" and out["tail_"]["original_filename"] == ""


def test_attach_outcomes(spark):
    work = spark.createDataFrame([("u1", "a"), ("u2", "b"), ("u3", "c")], "pdf_url string, filename string")
    outc = spark.createDataFrame([("u1", "/p/a", None), ("u2", None, "status 404")],
                                 "pdf_url string, saved_path string, error string")
    got = {r["pdf_url"]: r["failed"] for r in M.attach_outcomes(work, outc).collect()}
    assert got == {"u1": False, "u2": True, "u3": True}


def test_landed_pages_and_page_text(spark, scratch):
    from quire.operators import extract as X

    pages = spark.createDataFrame([("u1", "<html>x</html>", None), ("u2", None, "status 404")],
                                  FS.LANDED_PAGE_SCHEMA)
    pages.write.parquet(scratch + "/landed")
    got = {r["url"]: (r["html"], r["error"]) for r in FS.read_landed_pages(spark, scratch + "/landed").collect()}
    assert got == {"u1": ("<html>x</html>", None), "u2": (None, "status 404")}
    text = spark.createDataFrame([("d", 2, "two"), ("d", 1, "one")], FS.PAGE_TEXT_SCHEMA)
    text.write.parquet(scratch + "/text")
    t = FS.read_page_text(spark, scratch + "/text")
    assert X.assemble_text(t, "doc", "page_no", "page_text").first()["page_text"] == "one\ntwo"


def test_objects_of_partitioned_folders_are_listed(spark, scratch):
    rows = spark.createDataFrame([(1, "a b%_x.pdf"), (2, "a b%_x.pdf"), (3, "c.pdf")], "id int, name string").repartition(2)
    for f in ("one", "two"):
        (rows if f == "one" else rows.where("id = 3")).write.partitionBy("name").parquet(f"{scratch}/{f}")
    listed = FS.list_files(spark, [f"{scratch}/one", f"{scratch}/two"], "*.parquet", by_folder=True).collect()
    assert sorted((r.name, r.path.split("/")[-2]) for r in listed) == [("a b%_x.pdf", "one"), ("c.pdf", "one"), ("c.pdf", "two")]
    assert all(r.length > 0 for r in listed)


def test_runs_of_any_size(spark, scratch):
    records = spark.createDataFrame([("r1", "u1", "f", "a", False, [1, 2], "p/1", None), ("r1", "u2", "f", "a", True, [], None, "skipped: DoD"),
                                     ("r2", "u3", 'q"\n', "a", False, None, None, "status 404")],
                                    "run_id string, pdf_url string, filename string, agency string, is_dod boolean, part_numbers array<int>, saved_path string, error string")
    summary = spark.createDataFrame([("r1", "20250101T000000Z", "g", 2), ("r2", "20250102T000000Z", "g", 1), ("r3", "20250103T000000Z", "g", 0)],
                                    "run_id string, started_utc string, guide_url string, new_pdfs_count int")
    FS.write_runs(summary, records, scratch + "/runs")
    runs, back = FS.read_runs(spark, scratch + "/runs"), FS.read_records(spark, scratch + "/runs")
    text = spark.read.text(scratch + "/runs/runs").where("run_id = 'r1'").collect()
    assert len(text) > 3  # a document of several lines
    assert sorted((r.run_id, r.started_utc, r.new_pdfs_count) for r in runs.collect()) == sorted((r.run_id, r.started_utc, r.new_pdfs_count) for r in summary.collect())
    assert sorted(map(str, back.select(*records.columns).collect())) == sorted(map(str, records.collect()))
    assert FS.latest_run(runs).first().run_id == "r2"  # r3 found nothing


def test_nested_runs_have_a_bound(spark, scratch, monkeypatch):
    monkeypatch.setattr(FS, "NESTED_RECORDS", 1)
    records = spark.createDataFrame([("r", "u", "f", "a", False, [1], None, None)] * 2,
                                    "run_id string, pdf_url string, filename string, agency string, is_dod boolean, part_numbers array<int>, saved_path string, error string")
    with pytest.raises(ValueError, match="write_runs"):
        FS.write_run_manifest(records.select("run_id").distinct(), records, scratch + "/nested")
