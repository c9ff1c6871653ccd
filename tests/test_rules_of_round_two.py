"""Ranges at evaluation times, alerts over gaps, registry payloads, listings, wildcards."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tellurion.functions import topics
from tellurion.operators import conformance, latest, metrics
from tellurion.plans.panels import Panels
from tellurion.sources import listings, registry

SECOND = metrics.SECOND


def series(spark, points, metric="up", **labels):
    rows = [(metric, labels or {"job": "j"}, t * SECOND, float(v)) for t, v in points]
    frame = spark.createDataFrame(rows, "metric string, labels map<string,string>, us long, value double")
    return frame.select("metric", "labels", F.timestamp_micros("us").alias("ts"), "value")


def test_a_rate_needs_two_samples_in_its_range(spark):
    counter = series(spark, [(0, 10), (240, 250)])
    got = metrics.rates_at_steps(counter, 60 * SECOND, 300 * SECOND).collect()
    assert {(r.us // SECOND, round(r.value, 6)) for r in got} == {(240, 1.0)}
    panels = Panels(counter, lambda s: metrics.at_steps(s, 60 * SECOND), rate_span=300 * SECOND, extrapolate=False)
    assert [r.us // SECOND for r in panels.rate("up").collect()] == [240]


def test_a_rate_spans_a_reset_and_is_extended_to_both_edges(spark):
    counter = series(spark, [(30, 60), (60, 90), (90, 10), (120, 40)])
    plain = metrics.rates_at_steps(counter, 150 * SECOND, 150 * SECOND).collect()
    assert [(r.us // SECOND, round(r.value, 6)) for r in plain] == [(150, round(70 / 90, 6))]
    wide = metrics.rates_at_steps(counter, 150 * SECOND, 150 * SECOND, True).collect()
    assert round(wide[0].value, 6) == round(70 / 90 * (90 + 30 + 30) / 150, 6)


def test_changes_are_counted_within_the_range(spark):
    flips = series(spark, [(0, 1), (60, 0), (120, 1), (180, 1), (240, 0)])
    got = metrics.changes_at_steps(flips, 120 * SECOND, 150 * SECOND).collect()
    assert {(r.us // SECOND, r.value) for r in got} == {(0, 0.0), (120, 2.0), (240, 1.0), (360, 0.0)}
    once = metrics.changes_at_steps(flips, SECOND, 100 * SECOND, at=200 * SECOND).collect()
    assert [(r.us // SECOND, r.value) for r in once] == [(200, 0.0)]


@pytest.mark.parametrize("block", [60 * SECOND, None])
def test_an_alert_starts_anew_after_a_gap(spark, block):
    down = series(spark, [(0, 0), (15, 0), (30, 0), (86_400, 0), (86_415, 0)])
    states = metrics.alert_states(down, F.col("value") == 0, 20 * SECOND, "A", block).collect()
    assert {(r.us // SECOND, r.held_since_us // SECOND, r.alertstate) for r in states} == {
        (0, 0, "pending"), (15, 0, "pending"), (30, 0, "firing"),
        (86_400, 86_400, "pending"), (86_415, 86_400, "pending"),
    }


def payload(schema):
    return json.dumps({"artifactId": "t", "firstVersion": {"version": "1", "content": {"content": json.dumps(schema)}}})


def test_registry_payloads(spark):
    schema = {
        "type": "object", "additionalProperties": False, "required": ["names"],
        "properties": {"names": {"type": "array", "items": {"type": "string"}, "minItems": 1}, "n": {"type": "integer"}},
    }
    contract = registry.from_json_schema("t", payload(schema))
    assert contract == registry.from_json_schema("t", json.dumps(schema))
    assert contract.closed and [f.field for f in contract.fields] == ["names", "n"]
    with pytest.raises(ValueError):
        registry.from_json_schema("t", json.dumps({"artifactId": "t"}))
    records = spark.createDataFrame(
        [("t", i, v) for i, v in enumerate(['{"names":["a","b"]}', '{"names":[null]}', '{"names":["a",null]}', '{"names":[]}',
                                            '{"names":["a",1]}', '{"names":"a"}', '{"names":["a"],"x":1}'])],
        "topic string, record_id int, value string",
    )
    got = conformance.violations(records, registry.contract_table(spark, [contract]), registry.topic_table(spark, [contract]))
    assert {(r.record_id, r.field, r.rule) for r in got.collect()} == {
        (1, "names", "type"), (2, "names", "type"), (3, "names", "minItems"), (4, "names", "type"),
        (5, "names", "type"), (6, "x", "additionalProperties"),
    }


def test_keys_below_a_folder_named_like_the_root(spark, tmp_path):
    for name in (f"backup{tmp_path}/a.jpg", "backup/b.jpg", "other/c.jpg"):
        file = tmp_path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"x")
    window = datetime(2000, 1, 1, tzinfo=UTC), datetime(2100, 1, 1, tzinfo=UTC)
    found = listings.listed_objects(spark, str(tmp_path), "b", *window).collect()
    assert {r.object_key for r in found} == {f"backup{tmp_path}/a.jpg", "backup/b.jpg", "other/c.jpg"}
    within = listings.listed_objects(spark, str(tmp_path), "b", *window, prefix="backup/b").collect()
    assert {r.object_key for r in within} == {"backup/b.jpg"}


def test_wildcards_leave_system_topics_out(spark):
    rows = spark.createDataFrame([("$SYS/load",), ("a/load",), ("a",)], "topic string")
    for subscription, wanted in (("#", {"a/load", "a"}), ("+/load", {"a/load"}), ("$SYS/#", {"$SYS/load"})):
        assert {r.topic for r in rows.where(topics.subscribed(rows.topic, [subscription])).collect()} == wanted


def test_a_null_order_value_ranks_lowest(spark):
    rows = spark.createDataFrame([("e", 1, None), ("e", 2, "b"), ("e", 3, None), ("e", 4, "b")], "entity_id string, arrival_seq long, event_ts string")
    for block in (1, 1 << 23):
        judged = latest.with_acceptance(rows, block_rows=block).orderBy("arrival_seq").collect()
        assert [r.accepted for r in judged] == [True, True, False, True]
