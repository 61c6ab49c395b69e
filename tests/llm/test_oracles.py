"""The queries that SQL can express, against DuckDB on the smallest tables; all return documents' rows."""
import os

import duckdb
import pytest

import __spark_entry__ as entry
from quire.llm.catalog import ORACLES
from quire.session import TABLES
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    frame = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in frame.collect()]
    found = con.execute(ORACLES[name])
    columns, want = [d[0] for d in found.description], found.fetchall()
    assert sorted(frame.columns) == sorted(columns) and len(rows) == len(want) > 0
    assert digest(frame.columns, rows)[0] == digest(columns, want)[0]
