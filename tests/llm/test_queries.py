"""Registered queries of the operators against their SQL on the smallest data."""

import os

import duckdb
import pytest

from tellurion import llm

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(llm.checks()))
def test_query_matches_its_sql(spark, name):
    frame = llm.queries()[name](spark, DATA)
    columns = sorted(frame.columns)
    got = sorted(str([r[c] for c in columns]) for r in frame.collect())
    db = duckdb.connect()
    for file in os.listdir(DATA):
        db.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    result = db.execute(llm.checks()[name])
    order = [d[0] for d in result.description]
    want = sorted(str([r[order.index(c)] for c in columns]) for r in result.fetchall())
    assert got == want


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
def test_models_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    languages = llm.queries()["op3_language"](spark, DATA).where("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in languages) >= 0.97 * len(languages)
    scores = llm.queries()["op5_quality"](spark, DATA).where("held_out").join(labels, "doc_id").collect()
    assert sum(r.quality == r.predicted for r in scores) >= 0.9 * len(scores)
