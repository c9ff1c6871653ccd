"""Contract checks of the six raw event families, as one array of messages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellurion.functions import jsonx
from tellurion.functions.once import with_once
from tellurion.functions.topics import (
    MEDIA_TOPICS, RAW_GPS, RAW_IMAGE2D, RAW_IMAGE3D, RAW_SENSOR, RAW_VIDEO2D, RAW_VIDEO3D,
)

# Fields of the raw events, their types and bounds.
_MEDIA_REQUIRED = ("bucket", "device_id", "format", "object_key", "object_uri", "timestamp")
REQUIRED = {
    RAW_SENSOR: ("device_id", "payload", "timestamp"),
    RAW_GPS: ("device_id", "latitude", "longitude", "timestamp"),
    **{topic: _MEDIA_REQUIRED for topic in MEDIA_TOPICS},
}
_MEDIA_COMMON = (
    "bucket", "checksum", "content_type", "device_id", "format", "ingested_at", "mqtt_topic",
    "object_key", "object_uri", "qos", "retain", "size_bytes", "source", "tags", "timestamp",
)
_FRAMES = ("codec", "duration_ms", "frame_count", "frame_rate", "height", "width")
ALLOWED = {
    RAW_IMAGE2D: (*_MEDIA_COMMON, "camera_id", "height", "width"),
    RAW_IMAGE3D: (
        *_MEDIA_COMMON, "capture_type", "coordinate_frame", "point_count", "sensor_id",
    ),
    RAW_VIDEO2D: (*_MEDIA_COMMON, *_FRAMES, "camera_id"),
    RAW_VIDEO3D: (*_MEDIA_COMMON, *_FRAMES, "representation", "rig_id", "views"),
}
STRINGS = (
    "bucket", "camera_id", "capture_type", "checksum", "codec", "content_type",
    "coordinate_frame", "device_id", "format", "ingested_at", "mqtt_topic", "object_key",
    "object_uri", "representation", "rig_id", "sensor_id", "source", "timestamp",
)
INTEGERS = (
    "duration_ms", "frame_count", "height", "point_count", "qos", "size_bytes", "views", "width",
)
NUMBERS = ("altitude_m", "frame_rate", "heading_deg", "latitude", "longitude", "speed_m_s")
OBJECTS = ("payload", "tags")
BOOLEANS = ("retain",)
RANGES = {"latitude": (-90, 90), "longitude": (-180, 180), "heading_deg": (0, 360)}
NON_NEGATIVE = ("duration_ms", "frame_count", "point_count", "size_bytes", "speed_m_s")
POSITIVE = ("frame_rate", "height", "views", "width")


FIELDS = tuple(dict.fromkeys((*STRINGS, *INTEGERS, *NUMBERS, *OBJECTS, *BOOLEANS)))

# The checks below are SQL text over columns that are computed once per
# event: ``_f`` holds its known fields, ``_k_<field>`` the type name of each. The
# text of all checks is parsed in one call instead of one call per operation.


def _texts(names: Iterable[str]) -> str:
    return ", ".join(f"'{name}'" for name in names)


def _message(failed: str, text: str) -> str:
    return f"CASE WHEN {failed} THEN '{text}' ELSE '' END"


def _is_number(name: str) -> str:
    return f"(_k_{name} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith(_k_{name}, 'DECIMAL'))"


def _number(name: str) -> str:
    return f"(CASE WHEN {_is_number(name)} THEN try_variant_get(_f.{name}, '$', 'double') END)"


def _required_messages() -> list[str]:
    def missing(name: str) -> str:
        empty = f"_k_{name} = 'STRING' AND try_variant_get(_f.{name}, '$', 'string') = ''"
        return f"(_k_{name} IS NULL OR _k_{name} = 'VOID' OR {empty})"

    names = sorted({name for fields in REQUIRED.values() for name in fields})
    return [
        _message(
            f"_topic IN ({_texts(t for t, fields in REQUIRED.items() if name in fields)}) AND {missing(name)}",
            f"missing required field: {name}",
        )
        for name in names
    ]


def _closed_messages() -> str:
    cases = " ".join(f"WHEN '{t}' THEN array({_texts(fields)})" for t, fields in ALLOWED.items())
    extra = f"array_sort(array_except(_keys, CASE _topic {cases} END))"
    named = f"transform({extra}, f -> 'field not allowed by ' || _topic || ': ' || f)"
    return f"CASE WHEN _topic IN ({_texts(ALLOWED)}) THEN {named} ELSE CAST(array() AS ARRAY<STRING>) END"


def _typed_messages() -> list[str]:
    def wrong(name: str, wanted: str) -> str:
        return f"_k_{name} <> 'VOID' AND NOT {wanted}"

    strings = [
        _message(wrong(n, f"_k_{n} = 'STRING'"), f"field must be a string: {n}") for n in STRINGS
    ]
    integers = [
        _message(wrong(n, f"_k_{n} = 'BIGINT'"), f"field must be an integer: {n}")
        for n in INTEGERS
    ]
    numbers = [
        _message(wrong(n, _is_number(n)), f"field must be numeric: {n}") for n in NUMBERS
    ]
    # For these two groups an explicit null is an error as well.
    objects = [_message(f"_k_{n} <> 'OBJECT'", f"field must be an object: {n}") for n in OBJECTS]
    booleans = [_message(f"_k_{n} <> 'BOOLEAN'", f"field must be a boolean: {n}") for n in BOOLEANS]
    return strings + integers + numbers + objects + booleans


def _ranged_messages() -> list[str]:
    ranges = [
        _message(f"{_number(n)} NOT BETWEEN {low} AND {high}", f"{n} out of range: {low}..{high}")
        for n, (low, high) in RANGES.items()
    ]
    floors = [_message(f"{_number(n)} < 0", f"{n} must be non-negative") for n in NON_NEGATIVE]
    above = [_message(f"{_number(n)} <= 0", f"{n} must be positive") for n in POSITIVE]
    return ranges + floors + above


def _kind(name: str) -> str:
    if name in OBJECTS:
        # The type name of an object spells out all of it; its header is enough here.
        return (
            f"CASE WHEN try_variant_get(_f.{name}, '$', 'struct<a:variant>') IS NOT NULL "
            f"THEN 'OBJECT' WHEN is_variant_null(_f.{name}) THEN 'VOID' "
            f"WHEN _f.{name} IS NOT NULL THEN 'OTHER' END"
        )
    return f"schema_of_variant(_f.{name})"


def with_errors(
    events: DataFrame, topic: str = "intended_topic", event: str = "event"
) -> DataFrame:
    """Add the ``errors`` array: a message for every rule an event breaks, in a fixed order.

    Topics without a contract give an empty array.
    """
    members = ", ".join(f"{name}: variant" for name in FIELDS)
    kinds = {f"_k_{name}": F.expr(_kind(name)) for name in FIELDS}
    checks = f"""CASE WHEN _topic IN ({_texts(REQUIRED)}) THEN concat(
      array_remove(array({", ".join(_required_messages())}), ''),
      {_closed_messages()},
      array_remove(array({", ".join(_typed_messages() + _ranged_messages())}), ''))
      ELSE CAST(array() AS ARRAY<STRING>) END"""
    closed = f"CASE WHEN _topic IN ({_texts(ALLOWED)}) THEN map_keys(try_variant_get({event}, '$', 'map<string,variant>')) END"
    opened = events.withColumns(
        {"_topic": F.col(topic), "_f": F.expr(f"try_variant_get({event}, '$', 'struct<{members}>')")}
    )
    checked = opened.withColumns({**kinds, "_keys": F.expr(closed)})
    return with_once(checked, "errors", F.expr(checks)).select(*events.columns, "errors")


def with_null_island(events: DataFrame, event: str = "event") -> DataFrame:
    """Flag positions that were filled with the default of zero for both axes."""
    def zero(name: str) -> str:
        kind = f"schema_of_variant(try_variant_get({event}, '$.{name}', 'variant'))"
        number = f"{kind} RLIKE '{jsonx.NUMBER_KINDS}'"
        return f"({number} AND try_variant_get({event}, '$.{name}', 'double') = 0)"

    return events.withColumn(
        "null_island", F.expr(f"coalesce({zero('latitude')} AND {zero('longitude')}, false)")
    )
