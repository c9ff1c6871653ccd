"""Contracts from schema documents, export gates, permissions."""

import json
import random

from pyspark.sql import functions as F

from tellurion.functions import exports as rights
from tellurion.operators import conformance, exports, governance
from tellurion.sources import declared, registry

SCHEMA = {
    "type": "object", "additionalProperties": False, "required": ["id", "level", "at"],
    "properties": {
        "id": {"type": "string"}, "level": {"type": "string", "enum": ["low", "high"]},
        "at": {"type": "string", "format": "date-time"}, "n": {"type": "integer", "minimum": 0},
        "rate": {"type": "number", "exclusiveMinimum": 0},
        "tags": {"type": "array", "items": {"type": "string"}, "minItems": 1},
    },
}


def test_registry_documents_become_contracts(spark, tmp_path):
    (tmp_path / "site.records.json").write_text(json.dumps({"schema": json.dumps(SCHEMA)}))
    contracts = registry.registered_contracts(spark, str(tmp_path))
    assert [c.topic for c in contracts] == ["site.records"]
    rows = [
        ("1", '{"id":"a","level":"low","at":"2024-01-01T00:00:00Z","n":1.0,"rate":0.5,"tags":["x"]}'),
        ("2", '{"id":1,"level":"mid","at":"2024-01-01","n":-1,"rate":0,"tags":[]}'),
        ("3", '{"level":"low","at":"2024-01-01T00:00:00Z","more":1,"n":1.5}'),
        ("4", "nothing"),
    ]
    records = spark.createDataFrame([("site.records", i, v) for i, v in rows], "topic STRING, record_id STRING, value STRING")
    broken = conformance.violations(
        records, registry.contract_table(spark, contracts), registry.topic_table(spark, contracts)
    )
    assert sorted((r["record_id"], r["field"], r["rule"]) for r in broken.collect()) == [
        ("2", "at", "format"), ("2", "id", "type"), ("2", "level", "enum"), ("2", "n", "minimum"),
        ("2", "rate", "exclusiveMinimum"), ("2", "tags", "minItems"), ("3", "id", "required"),
        ("3", "more", "additionalProperties"), ("3", "n", "type"), ("4", "", "object"),
    ]


def test_declared_contracts():
    by_topic = {c.topic: c for c in declared.declared_contracts()}
    assert not by_topic["raw.gps"].closed and by_topic["raw.video2d.meta"].closed
    fields = {f.field: f for f in by_topic["raw.video2d.meta"].fields}
    assert (fields["frame_rate"].above, fields["width"].minimum, fields["tags"].type) == (0, 1, "object")


DATASETS = "dataset_id STRING, title STRING, dataset_type STRING, classification STRING, access_mode STRING, dmp_id STRING, data_products ARRAY<STRING>, source_topics ARRAY<STRING>"


def resolved(spark, classification, mode, **request):
    datasets = spark.createDataFrame([("d s", "T", "derived", classification, mode, "p", [], [])], DATASETS)
    plans = spark.createDataFrame([("p", "active")], "dmp_id STRING, status STRING")
    schema = "request_id INT, dataset_id STRING" + "".join(
        f", {n} {exports.REQUEST_FIELDS[n]}" for n in request
    )
    requests = spark.createDataFrame([(1, "d s", *request.values())], schema)
    return exports.resolved(requests, datasets, plans)


def deposit(spark, classification, mode, **request):
    as_of = F.lit("2024-06-01").cast("timestamp")
    return exports.deposits(resolved(spark, classification, mode, **request), as_of).collect()[0]


def discovery(spark, classification, mode, **request):
    as_of = F.lit("2024-06-01").cast("timestamp")
    return exports.discoveries(resolved(spark, classification, mode, **request), as_of).collect()[0]


def test_export_gates(spark):
    row = deposit(spark, "mixed", "mediated")
    assert row["access_right"] == "restricted" and row["metadata"]["access_conditions"]
    assert deposit(spark, "mixed", "mediated", access_right="open")["error_code"] == "open_release_blocked"
    row = deposit(spark, "public", "open")
    assert (row["access_right"], row["metadata"]["license"]) == ("open", "cc-by-4.0")
    assert deposit(spark, "mixed", "embargoed")["access_right"] == "embargoed"
    assert deposit(spark, "mixed", "mediated", publish=True)["error_code"] == "legal_review_required"
    row = discovery(spark, "mixed", "embargoed", doi="https://doi.org/10.5281/zenodo.123")
    assert (row["metadata"]["identifier"], row["metadata"]["identifier_type"]) == ("10.5281/zenodo.123", "DOI")
    assert row["access_right"] == "restricted"
    blocked = discovery(spark, "mixed", "mediated", access_right="open")
    assert blocked["error_code"] == "open_metadata_release_blocked"
    page = discovery(spark, "mixed", "mediated", landing_page_url="http://x.example/1")
    assert page["error_code"] == "invalid_landing_page_url"


def test_export_package(spark):
    as_of = F.lit("2024-06-01").cast("timestamp")
    rows = exports.discoveries(resolved(spark, "public", "open", title='A <b> & "c"'), as_of, rights.Publisher(name="P"))
    files = {r["file_name"]: r["content"] for r in exports.package_files(rows, as_of, F.lit("now"), rights.Publisher(name="P")).collect()}
    xml = files["d-s.openaire-datacite.xml"]
    assert "A &lt;b> &amp;" in xml or "A &lt;b&gt; &amp;" in xml
    assert 'identifierType="Other"' in xml and "<date dateType=\"Issued\">2024-06-01</date>" in xml
    assert json.loads(files["d-s.openaire-manifest.json"])["dataset"]["dataset_id"] == "d s"


def test_permission_at_request_time(spark):
    dice = random.Random(11)
    keys = lambda: ("hot" if dice.random() < 0.4 else f"s{dice.randrange(5)}", "p")
    kinds = ("granted", "withdrawn", "expired", "updated")
    permissions = [(i, *keys(), dice.choice(kinds), dice.randrange(500)) for i in range(120)]
    requests = [(i, *keys(), dice.randrange(500)) for i in range(150)]
    p = spark.createDataFrame(permissions, "permission_id INT, subject STRING, product STRING, event_type STRING, s INT")
    r = spark.createDataFrame(requests, "request_id INT, subject STRING, product STRING, s INT")
    for cut in ({}, {"block": 20_000_000}, {"block_rows": 16}):
        got = governance.permitted_at_request(
            r.withColumn("requested_at", F.timestamp_seconds("s")),
            p.withColumn("occurred_at", F.timestamp_seconds("s")), ["subject", "product"], **cut,
        )
        for row in got.collect():
            _, subject, product, at = requests[row["request_id"]]
            before = [x for x in permissions if x[1:3] == (subject, product) and x[4] <= at]
            last = max(before, key=lambda x: (x[4], x[0])) if before else None
            assert row["permission_id"] == (last[0] if last else None)
            assert row["permitted"] == bool(last and last[3] in ("granted", "updated"))


def test_views(spark):
    topics = ["security.patch.events", "governance.research.outputs", "dlq.events", "raw.gps"]
    rows = governance.evidence_views(spark.createDataFrame([(t,) for t in topics], "topic STRING"))
    got = {}
    for r in rows.collect():
        got.setdefault(r["topic"], set()).add(r["view"])
    assert got == {
        "security.patch.events": {"security_resilience", "nis2", "dora", "cra"},
        "governance.research.outputs": {"dga", "research"}, "dlq.events": {"dga"},
    }
