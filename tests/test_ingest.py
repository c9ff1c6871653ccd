"""Messages, contracts and routing on literal cases."""

import json

from pyspark.sql import functions as F

from tellurion.functions import jsonx, topics
from tellurion.operators import contracts, ingest

SCHEMA = "topic STRING, payload BINARY, qos INT, retain BOOLEAN, ingested_at STRING"
NOW = "2026-02-02T00:00:00+00:00"


def ingested(spark, *messages):
    rows = [(t, p if isinstance(p, bytes) else p.encode(), 1, False, NOW) for t, p in messages]
    frame = ingest.ingested(spark.createDataFrame(rows, SCHEMA))
    found = frame.select(
        "topic", "intended_topic", "key", "topic_out", "errors", F.to_json("event").alias("event"),
        F.to_json("dead_letter").alias("letter"),
    ).collect()
    by_topic = {r["topic"]: r for r in found}
    return [(by_topic[t], json.loads(by_topic[t]["event"])) for t, _ in messages]


def test_messages_become_routed_events(spark):
    cases = ingested(
        spark,
        ("sea/devices/buoy-7/salinity", '{"timestamp":"2031-05-06T07:08:09+00:00","psu":34.5}'),
        ("sea/devices/drifter-2/gnss/position", '{"lat":-54.25,"lon":3.5,"speed":0.75}'),
        ("wildfi/tags/SEAL-9/gps", '{"utcTimestamp":1900000000,"lat":-54.5,"lon":3.25}'),
        ("wildfi/tags/SEAL-9/environment", '{"utc_timestamp":1900000000000,"depth":210}'),
        ("sea/devices/rov-1/video2d", '{"exposure":0.01}'),
        ("wildfi/tags/SEAL-4/decoded", b"\xfe\x01\x80"),
        ("wildfi/tags/SEAL-5/gps", '{"utcTimestamp":1900000000,"lat":"south","lon":[]}'),
        ("devices/e/sensor", '"calm"'),
        ("devices/f/sensor", '{"time": false}'),
        ("devices/g/sensor", '{"timestamp": -1e40}'),
        ("devices/h/sensor", '{"timestamp": 1900000000.5}'),
    )
    (r, e) = cases[0]
    assert (r["topic_out"], r["key"], e["payload"]["psu"]) == ("raw.sensor", "buoy-7", 34.5)
    (r, e) = cases[1]
    assert (r["topic_out"], e["latitude"], e["longitude"], e["speed_m_s"]) == ("raw.gps", -54.25, 3.5, 0.75)
    (r, e) = cases[2]
    assert (r["key"], e["timestamp"], e["source"]) == ("SEAL-9", "2030-03-17T17:46:40+00:00", "wildfi-mqtt")
    (r, e) = cases[3]
    assert (r["topic_out"], e["timestamp"]) == ("raw.sensor", "2030-03-17T17:46:40+00:00")
    (r, e) = cases[4]
    assert (r["intended_topic"], r["topic_out"], e["exposure"]) == ("raw.video2d.meta", "dlq.events", 0.01)
    assert "missing required field: bucket" in r["errors"]
    assert "field not allowed by raw.video2d.meta: exposure" in r["errors"]
    assert json.loads(r["letter"])["source"] == "mqtt-bridge"
    (r, e) = cases[5]
    assert (r["topic_out"], e["payload"]) == ("raw.sensor", {"payload_b64": "/gGA"})
    (r, e) = cases[6]
    assert r["topic_out"] == "dlq.events" and len(r["errors"]) == 2
    assert cases[7][1]["payload"] == {"value": "calm"}
    assert cases[8][1]["timestamp"] == "false"
    assert cases[9][1]["timestamp"] == NOW
    assert cases[10][1]["timestamp"] == "2030-03-17T17:46:40.500000+00:00"


def test_strict_parse_takes_whole_documents_only(spark):
    good = ['{"a":1}', " 3 ", '"x"', "[1]", "null", '{"a":{"b":[]}}']
    bad = ["", '{"a":1} x', '{"a":1}] x', '{"a":1}} x', '{"a":1},2', '{"a":1},"b":2', "{'a':1}", "NaN", "1 2"]
    frame = spark.createDataFrame([(t,) for t in good + bad], "t STRING")
    parsed = jsonx.with_document(frame, "d", "t").filter("d IS NOT NULL").select("t")
    assert {r["t"] for r in parsed.collect()} == set(good)


def test_topic_rules(spark):
    cases = {
        "devices/a1/gnss/fix": ("raw.gps", "a1", "a1"),
        "wildfi/tags/WF-001/rawgps": ("raw.gps", "WF-001", "WF-001"),
        "wildfi/tags/WF-001/imu": ("raw.sensor", "WF-001", "WF-001"),
        "devices/a1/lidar/frame": ("raw.image3d.meta", "a1", "a1"),
        "devices/a1/unknown": ("fallback", "a1", "a1"),
        "/tenant/devices/cam-07/video": ("fallback", "cam-07", "cam-07"),
        "wildfi/WF-002/environment": ("raw.sensor", "WF-002", "WF-002"),
        "wildfi/imu/WF-9/x": ("raw.sensor", "WF-9", "WF-9"),
        "orphan-topic": ("fallback", "orphan-topic", "orphan-topic"),
        "/": ("fallback", "unknown", "unknown"),
        "devices/d1/tags/t1": ("fallback", "t1", "d1"),
    }
    topic = F.col("t")
    rows = spark.createDataFrame([(t,) for t in cases], "t STRING").select(
        "t", topics.raw_topic(topic, "fallback"), topics.device_id(topic), topics.entity_id(topic)
    )
    assert {r[0]: tuple(r)[1:] for r in rows.collect()} == cases


def test_custom_prefixes_and_subscriptions(spark):
    topic = F.col("t")
    frame = spark.createDataFrame([("Birds/B-1/acc",), ("devices",), ("devices/x/y",), ("devicesx",)], "t STRING")
    rows = frame.select(
        "t", topics.device_id(topic, ["BIRDS"]), topics.event_source(topic, ["BIRDS"]),
        topics.subscribed(topic), topics.subscribed(topic, ["+/+/y", "Birds/#"]),
    )
    assert {r[0]: tuple(r)[1:] for r in rows.collect()} == {
        "Birds/B-1/acc": ("B-1", "wildfi-mqtt", False, True),
        "devices": ("devices", "mqtt-bridge", True, False),
        "devices/x/y": ("x", "mqtt-bridge", True, True),
        "devicesx": ("devicesx", "mqtt-bridge", False, False),
    }


def errors_of(spark, topic, event):
    frame = spark.createDataFrame([(topic, json.dumps(event))], "intended_topic STRING, j STRING")
    checked = contracts.with_errors(frame.withColumn("event", F.parse_json("j")))
    return checked.collect()[0]["errors"]


def test_contracts(spark):
    media = {
        "device_id": "cam-1", "timestamp": "t", "bucket": "b", "object_key": "k", "object_uri": "u",
        "format": "jpg", "size_bytes": 10,
    }
    assert errors_of(spark, "raw.image2d.meta", media) == []
    assert errors_of(spark, "raw.image2d.meta", {**media, "size_bytes": -1, "frame": 12}) == [
        "field not allowed by raw.image2d.meta: frame", "size_bytes must be non-negative",
    ]
    assert errors_of(spark, "unknown.topic", {"payload": "opaque"}) == []
    position = {
        "device_id": ["seal"], "timestamp": {}, "ingested_at": False, "latitude": -90.5, "longitude": 180.25,
        "heading_deg": -0.5, "speed_m_s": "slow", "payload": 7, "tags": "wet", "retain": 1,
    }
    assert errors_of(spark, "raw.gps", position) == [
        "field must be a string: device_id", "field must be a string: ingested_at",
        "field must be a string: timestamp", "field must be numeric: speed_m_s",
        "field must be an object: payload", "field must be an object: tags",
        "field must be a boolean: retain", "latitude out of range: -90..90",
        "longitude out of range: -180..180", "heading_deg out of range: 0..360",
    ]
    whole = {"device_id": "d", "timestamp": "t", "payload": {}, "width": 1.0, "height": True, "views": 2**70}
    assert errors_of(spark, "raw.sensor", whole) == [
        "field must be an integer: height", "field must be an integer: views",
        "field must be an integer: width",
    ]
    nulls = {"device_id": "", "timestamp": None, "payload": None, "retain": None, "width": None}
    assert errors_of(spark, "raw.sensor", nulls) == [
        "missing required field: device_id", "missing required field: payload",
        "missing required field: timestamp", "field must be an object: payload",
        "field must be a boolean: retain",
    ]
