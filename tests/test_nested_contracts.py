"""Rules for the items of arrays and for records inside records."""

import json
from collections import Counter

from tellurion.operators import conformance
from tellurion.sources import registry

SCHEMA = {
    "additionalProperties": False,
    "required": ["id", "stops"],
    "properties": {
        "id": {"type": "string"},
        "modes": {"type": "array", "items": {"type": "string", "enum": ["rail", "road"]}},
        "owner": {"type": "object", "additionalProperties": False, "required": ["name"],
                  "properties": {"name": {"type": "string"}, "since": {"type": "string", "format": "date"}}},
        "stops": {"type": "array", "minItems": 1, "items": {
            "type": "object", "required": ["place"], "properties": {
                "place": {"type": "object", "required": ["lat"], "properties": {"lat": {"type": "number", "minimum": -90, "maximum": 90}}},
                "wait": {"type": "number", "exclusiveMinimum": 0}}}},
    },
}
ENVELOPE = {"artifactId": "trips", "firstVersion": {"content": {"content": json.dumps(SCHEMA)}}}
GOOD = {"id": "a", "modes": ["rail"], "owner": {"name": "n"}, "stops": [{"place": {"lat": 1}, "more": 1}]}


def broken(spark, tmp_path, records, topic="trips"):
    (tmp_path / "trips.json").write_text(json.dumps(ENVELOPE))
    contracts = registry.registered_contracts(spark, str(tmp_path))
    texts = [(topic, i, r if isinstance(r, str) or r is None else json.dumps(r), "extra") for i, r in enumerate(records)]
    rows = spark.createDataFrame(texts, "topic string, record_id int, value string, field string")
    found = conformance.violations(rows, registry.contract_table(spark, contracts), registry.topic_table(spark, contracts))
    assert found.columns == ["topic", "record_id", "field", "rule"]
    return Counter((r.record_id, r.field, r.rule) for r in found.collect())


def test_every_level_of_a_registered_contract(spark, tmp_path):
    records = [
        GOOD,
        {**GOOD, "modes": ["rail", "sea"]},
        {**GOOD, "modes": ["rail", None]},
        {**GOOD, "owner": {"since": "2024-13-01", "x": 1}},
        {**GOOD, "owner": "me"},
        {**GOOD, "stops": []},
        {**GOOD, "stops": [{"place": {"lat": 91}}, {"wait": 0}, {"place": {}}, None, 5, {"place": [1]}]},
        {**GOOD, "stops": {"place": {"lat": 91}}},
    ]
    assert broken(spark, tmp_path, records) == Counter([
        (1, "modes", "enum"),
        (2, "modes", "type"),
        (3, "owner.name", "required"), (3, "owner.since", "format"), (3, "owner.x", "additionalProperties"),
        (4, "owner", "type"),
        (5, "stops", "minItems"),
        (6, "stops[0].place.lat", "maximum"),
        (6, "stops[1].place", "required"), (6, "stops[1].wait", "exclusiveMinimum"),
        (6, "stops[2].place.lat", "required"), (6, "stops[3]", "object"), (6, "stops[4]", "object"),
        (6, "stops[5].place", "type"),
        (7, "stops", "type"),
    ])


def test_records_that_are_no_objects_and_repeated_rows(spark, tmp_path):
    assert broken(spark, tmp_path, [None, "", "[1]", "{", GOOD]) == Counter({(i, "", "object"): 1 for i in range(4)})
    twice = {**GOOD, "stops": [{"place": {"lat": -91}}] * 2}
    found = broken(spark, tmp_path, [twice])
    assert found == Counter({(0, "stops[0].place.lat", "minimum"): 1, (0, "stops[1].place.lat", "minimum"): 1})
    assert not broken(spark, tmp_path, [twice], topic="other")
    assert not broken(spark, tmp_path, [])
