"""Registered queries against their checking SQL on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tellurion.plans import all_checks

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(all_checks()))
def test_query_matches_its_sql(spark, name):
    frame = entry.queries()[name](spark, DATA)
    columns = sorted(frame.columns)
    got = sorted(str([r[c] for c in columns]) for r in frame.collect())
    db = duckdb.connect()
    db.execute("SET timezone = 'UTC'")
    for file in os.listdir(DATA):
        db.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    result = db.execute(entry.oracle_sql()[name])
    order = [d[0] for d in result.description]
    want = sorted(str([r[order.index(c)] for c in columns]) for r in result.fetchall())
    assert got == want


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.FLAGSHIP in entry.queries()
