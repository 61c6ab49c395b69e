import datetime as dt

import pytest

from quire.functions.dates import with_normalized_date

# (raw, iso, kind) goldens
CASES = [
    ("2025-10-15", dt.date(2025, 10, 15), "iso"),
    ("2025.10.15", dt.date(2025, 10, 15), "iso"),
    ("10/15/2025", dt.date(2025, 10, 15), "iso"),
    ("1/5/2026", dt.date(2026, 1, 5), "iso"),
    ("October 15, 2025", dt.date(2025, 10, 15), "long"),
    ("October 15, 2025 (Effective immediately)", dt.date(2025, 10, 15), "long"),
    ("Immediately", None, "immediate"),
    ("Effective upon issuance", None, "immediate"),
    ("Date of issuance of the FY26 model language", None, "issuance"),
    ("14 days from signature", None, "delta"),
    (None, None, "empty"),
    ("   ", None, "empty"),
    ("TBD", None, "unparsed"),
    ("October 15 2025", None, "unparsed"),
    ("10/15/25", None, "unparsed"),
    ("February 30, 2025", None, "unparsed"),
    ("2025-13-40", None, "unparsed"),
    ("October 15,2025", dt.date(2025, 10, 15), "long"),
    (" October 15, 2025 ", dt.date(2025, 10, 15), "long"),
    ("october 5, 2025", dt.date(2025, 10, 5), "long"),
    ("May 5, 0000", None, "unparsed"),
]


@pytest.fixture(scope="module")
def normalized(spark):
    df = spark.createDataFrame([(str(i), r) for i, (r, _, _) in enumerate(CASES)],
                               "id string, effective_date string")
    rows = with_normalized_date(df).collect()
    return {int(r["id"]): r for r in rows}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_normalize(normalized, i):
    raw, iso, kind = CASES[i]
    r = normalized[i]
    assert r["effective_date_kind"] == kind, raw
    assert r["effective_date_iso"] == iso, raw


def test_no_break_spaces(spark):
    df = spark.createDataFrame([("October\u00a015,\u00a02025",), ("\u00a02025-01-02\u00a0",)], "effective_date string")
    got = [(str(r.effective_date_iso), r.effective_date_kind) for r in with_normalized_date(df).collect()]
    assert got == [("2025-10-15", "long"), ("2025-01-02", "iso")]
