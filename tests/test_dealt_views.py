"""Rows of one row group are parsed by all tasks, and contracts meet records without a shuffle."""

import datetime

import pytest
from pyspark.sql import functions as F

from tellurion.operators import conformance
from tellurion.plans import evidence, ingest, views
from tellurion.sources import declared, registry

N = 2000


@pytest.fixture
def tables(spark, tmp_path):
    day = datetime.datetime(2024, 1, 1)
    kinds = ["click", "view", "signup", "purchase", "error"]
    events = [(i, i % 7, kinds[i % 5], day + datetime.timedelta(hours=i), 1.5) for i in range(N)]
    # Null and repeated keys are rows as any other.
    events += [(None, 1, "click", day, 1.0), *events[:3]]
    schema = "event_id long, user_id long, event_type string, ts timestamp_ntz, value double"
    spark.createDataFrame(events, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    orders = [(i, i % 9, day) for i in range(N)] + [(None, 1, day), (4, 4, day)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").coalesce(1).write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    return str(tmp_path)


@pytest.mark.parametrize(("of", "key", "extra"), [(views.messages, "event_id", 4), (views.evidence_texts, "record_id", 2)])
def test_one_row_group_is_dealt_evenly(spark, tables, of, key, extra):
    made = views.view(spark, tables, of).cache()
    sizes = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * min(sizes) and sum(sizes) == N + extra
    assert made.select(key).distinct().count() == N + 1
    made.unpersist()


@pytest.mark.parametrize("query", [ingest.outgoing_records, ingest.dlq_rate, evidence.schema_violations])
def test_rows_are_dealt_before_they_are_parsed(spark, tables, query):
    plan = query(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 4, true" in plan
    below = plan[plan.index("Repartition 4, true") :]
    assert "parse_json" not in below.split("LogicalRDD")[0]


def test_records_meet_contracts_by_broadcast(spark, tables):
    contracts = declared.declared_contracts()
    found = conformance.violations(
        views.view(spark, tables, views.evidence_texts),
        registry.contract_table(spark, contracts), registry.topic_table(spark, contracts),
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
