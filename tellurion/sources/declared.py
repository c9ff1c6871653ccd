"""Contracts declared in the library: the raw families and the evidence used here.

Each field is stated with its type and rules. A full registry is read from its own documents with :mod:`tellurion.sources.registry`.
"""

from __future__ import annotations

from tellurion.functions import topics
from tellurion.operators import contracts as raw
from tellurion.sources.registry import Contract, Field

# Lists of allowed values.
LEVELS = ("low", "medium", "high", "critical")
CHANNELS = ("api", "file_export", "stream", "controlled_workspace")
REGULATIONS = (
    "DGA", "Data Act", "NIS2", "DORA", "CRA", "GDPR", "ePrivacy", "AI Act",
    "Trade Secrets Directive", "Radio Equipment Directive", "General Product Safety Regulation",
    "Product Liability Directive", "Cybersecurity Act", "Open Data Directive", "EHDS",
)


def _contract(topic: str, *fields: tuple[str, str, dict]) -> Contract:
    return Contract(topic, tuple(Field(topic, name, kind, **more) for name, kind, more in fields))


# The fields of the evidence contracts in their order.
EVIDENCE: tuple[Contract, ...] = (
    _contract(
        topics.DEAD_LETTER,
        ("timestamp", "timestamp", dict(required=True)),
        ("source", "string", dict(required=True)),
        ("intended_topic", "string", dict(required=True)),
        ("errors", "array<string>", dict(required=True, min_items=1)),
        ("raw_event", "object", dict(required=True)),
        ("source_topic", "string", {}),
        ("device_id", "string", {}),
    ),
    _contract(
        "media.object.events",
        ("Records", "array", dict(required=True, min_items=1)),
    ),
    _contract(
        "compliance.control.assessments",
        ("assessment_id", "string", dict(required=True)),
        ("regulation", "string", dict(required=True, enum=REGULATIONS)),
        ("control_id", "string", dict(required=True)),
        ("status", "string", dict(required=True, enum=("implemented", "partial", "todo", "blocked", "not_applicable", "conditional"))),
        ("owner", "string", dict(required=True)),
        ("assessed_at", "timestamp", dict(required=True)),
        ("evidence_topics", "array<string>", {}),
        ("evidence_uri", "string", {}),
        ("gaps", "array<string>", {}),
        ("next_action", "string", {}),
        ("due_at", "timestamp", {}),
    ),
    _contract(
        "dataact.user.access.requests",
        ("request_id", "string", dict(required=True)),
        ("user_id", "string", dict(required=True)),
        ("connected_product_id", "string", dict(required=True)),
        ("requested_scope", "array<string>", dict(required=True, min_items=1)),
        ("requested_format", "string", dict(required=True)),
        ("requested_at", "timestamp", dict(required=True)),
        ("status", "string", dict(required=True, enum=("submitted", "approved", "fulfilled", "rejected", "expired", "cancelled"))),
        ("related_service_id", "string", {}),
        ("delivery_channel", "string", dict(enum=CHANNELS)),
        ("fulfilled_at", "timestamp", {}),
        ("decision_reason", "string", {}),
    ),
    _contract(
        "dataact.user.exports",
        ("export_id", "string", dict(required=True)),
        ("request_id", "string", dict(required=True)),
        ("user_id", "string", dict(required=True)),
        ("data_product_id", "string", dict(required=True)),
        ("format", "string", dict(required=True)),
        ("delivery_channel", "string", dict(required=True, enum=CHANNELS)),
        ("created_at", "timestamp", dict(required=True)),
        ("status", "string", dict(required=True, enum=("created", "delivered", "expired", "revoked", "failed"))),
        ("third_party_id", "string", {}),
        ("schema_uri", "string", {}),
        ("export_uri", "string", {}),
        ("record_count", "integer", dict(minimum=0)),
        ("size_bytes", "integer", dict(minimum=0)),
        ("expires_at", "timestamp", {}),
    ),
    _contract(
        "governance.access.requests",
        ("request_id", "string", dict(required=True)),
        ("product_id", "string", dict(required=True)),
        ("requester_id", "string", dict(required=True)),
        ("requester_type", "string", dict(required=True, enum=("data_user", "data_holder", "data_subject", "public_sector_body", "researcher"))),
        ("declared_purpose", "string", dict(required=True)),
        ("requested_at", "timestamp", dict(required=True)),
        ("status", "string", dict(required=True, enum=("submitted", "under_review", "approved", "rejected", "withdrawn", "expired"))),
        ("requested_fields", "array<string>", {}),
        ("requested_format", "string", {}),
        ("third_country_jurisdiction", "string", {}),
        ("decision_reason", "string", {}),
    ),
    _contract(
        "governance.permission.events",
        ("permission_id", "string", dict(required=True)),
        ("subject_id", "string", dict(required=True)),
        ("subject_type", "string", dict(required=True, enum=("data_holder", "data_subject"))),
        ("product_id", "string", dict(required=True)),
        ("event_type", "string", dict(required=True, enum=("granted", "withdrawn", "expired", "updated"))),
        ("purposes", "array<string>", dict(required=True, min_items=1)),
        ("occurred_at", "timestamp", dict(required=True)),
        ("data_user_id", "string", {}),
        ("third_country_jurisdiction", "string", {}),
        ("evidence_uri", "string", {}),
    ),
    _contract(
        "resilience.backup.tests",
        ("test_id", "string", dict(required=True)),
        ("system", "string", dict(required=True)),
        ("tested_at", "timestamp", dict(required=True)),
        ("result", "string", dict(required=True, enum=("passed", "failed", "partial"))),
        ("rpo_minutes", "integer", dict(required=True, minimum=0)),
        ("rto_minutes", "integer", dict(required=True, minimum=0)),
        ("restore_scope", "string", {}),
        ("evidence_uri", "string", {}),
        ("findings", "array<string>", {}),
        ("next_test_due_at", "timestamp", {}),
    ),
    _contract(
        "security.vulnerability.findings",
        ("finding_id", "string", dict(required=True)),
        ("asset_id", "string", dict(required=True)),
        ("source", "string", dict(required=True)),
        ("severity", "string", dict(required=True, enum=LEVELS)),
        ("status", "string", dict(required=True, enum=("open", "accepted_risk", "patched", "mitigated", "false_positive"))),
        ("detected_at", "timestamp", dict(required=True)),
        ("cve", "string", {}),
        ("package_name", "string", {}),
        ("installed_version", "string", {}),
        ("fixed_version", "string", {}),
        ("due_at", "timestamp", {}),
        ("remediation", "string", {}),
    ),
)


def _raw_type(name: str, sensor: bool) -> str:
    if name in raw.INTEGERS:
        return "integer"
    if name in raw.NUMBERS:
        return "number"
    if name in raw.OBJECTS:
        return "object"
    if name in raw.BOOLEANS:
        return "boolean"
    is_time = name in ("timestamp", "ingested_at") and not sensor
    return "timestamp" if is_time else "string"


def _raw(topic: str) -> Contract:
    open_fields = {
        topics.RAW_SENSOR: (),
        topics.RAW_GPS: (
            "altitude_m", "speed_m_s", "heading_deg", "source", "mqtt_topic", "payload",
        ),
    }
    names = dict.fromkeys((*raw.REQUIRED[topic], *raw.ALLOWED.get(topic, open_fields.get(topic, ()))))
    fields = []
    for name in names:
        low, high = raw.RANGES.get(name, (None, None))
        if name in (*raw.NON_NEGATIVE, "qos"):
            low = 0
        if name in ("height", "views", "width"):
            low = 1
        fields.append(
            Field(
                topic, name, _raw_type(name, topic == topics.RAW_SENSOR),
                name in raw.REQUIRED[topic], minimum=low, maximum=high,
                above=0 if name == "frame_rate" else None,
            )
        )
    return Contract(topic, tuple(fields), closed=topic in raw.ALLOWED)


def declared_contracts() -> list[Contract]:
    return [_raw(t) for t in topics.RAW_TOPICS] + list(EVIDENCE)
