"""Columns derived from message topics: segments, identities, routing."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Topic names, markers and substring rules that results depend on.
RAW_SENSOR = "raw.sensor"
RAW_GPS = "raw.gps"
RAW_IMAGE2D = "raw.image2d.meta"
RAW_IMAGE3D = "raw.image3d.meta"
RAW_VIDEO2D = "raw.video2d.meta"
RAW_VIDEO3D = "raw.video3d.meta"
RAW_TOPICS = (RAW_SENSOR, RAW_GPS, RAW_IMAGE2D, RAW_IMAGE3D, RAW_VIDEO2D, RAW_VIDEO3D)
MEDIA_TOPICS = (RAW_IMAGE2D, RAW_IMAGE3D, RAW_VIDEO2D, RAW_VIDEO3D)
DEAD_LETTER = "dlq.events"
DEFAULT_SUBSCRIPTIONS = ("$share/ingestors/devices/#", "$share/ingestors/wildfi/#")
INGEST_TAG_MARKERS = ("tags", "tag", "devices")
NORMALISE_TAG_MARKERS = ("devices", "tag", "tags")
TRACKER_MARKERS = ("wildfi", "wild-fi")
SENSOR_WORDS = (
    "acc", "accelerometer", "bme", "decoded", "environment", "gateway", "imu",
    "mag", "metadata", "move", "movement", "prox", "proximity", "sensor", "telemetry",
)
ROUTING_RULES = (
    (RAW_GPS, ("gps", "/gnss/", "rawgps")),
    (RAW_VIDEO3D, ("video3d", "/stereo-video/", "/volumetric-video/")),
    (RAW_VIDEO2D, ("video2d", "/video/", "/camera-stream/")),
    (RAW_IMAGE2D, ("image2d", "/camera/", "/image/")),
    (RAW_IMAGE3D, ("image3d", "/lidar/", "/pointcloud/")),
)
KIND_OF_RAW_TOPIC = {
    RAW_SENSOR: "sensor",
    RAW_GPS: "gps",
    RAW_IMAGE2D: "image2d",
    RAW_IMAGE3D: "image3d",
    RAW_VIDEO2D: "video2d",
    RAW_VIDEO3D: "video3d",
}
KIND_RULES = (
    ("gps", ("gps", "/gnss/")),
    ("video3d", ("video3d", "/stereo-video/", "/volumetric-video/")),
    ("video2d", ("video2d", "/video/", "/camera-stream/")),
    ("image3d", ("image3d", "/lidar/", "/pointcloud/")),
    ("image2d", ("image2d", "/camera/", "/image/")),
)
TRACKER_SOURCE = "wildfi-mqtt"
BRIDGE_SOURCE = "mqtt-bridge"
UNKNOWN = "unknown"


def segments(topic: Column) -> Column:
    """Non-empty parts of a topic."""
    return F.array_remove(F.split(topic, "/"), "")


def lower_segments(topic: Column) -> Column:
    return segments(F.lower(topic))


def segment_after(topic: Column, marker: str) -> Column:
    """The segment that follows the first occurrence of a marker."""
    at = F.array_position(lower_segments(topic), marker).cast("int")
    return F.when(at > 0, F.try_element_at(segments(topic), at + 1))


def segment_after_any(topic: Column, markers: Sequence[str]) -> Column:
    """First marker, in the given order, that has a following segment."""
    return F.coalesce(*[segment_after(topic, marker) for marker in markers])


def tracker_segment(topic: Column, markers: Sequence[str]) -> Column:
    """The segment after a tracker marker, stepping over one sensor word."""
    parts, lowered = segments(topic), lower_segments(topic)
    found = []
    for marker in markers:
        at = F.array_position(lowered, marker).cast("int")
        follower = F.try_element_at(lowered, at + 1)
        found.append(
            F.when(
                (at > 0) & follower.isNotNull() & ~follower.isin(*SENSOR_WORDS),
                F.try_element_at(parts, at + 1),
            ).when(at > 0, F.try_element_at(parts, at + 2))
        )
    return F.coalesce(*found)


def _markers(prefixes: Iterable[str]) -> list[str]:
    return list(dict.fromkeys([*TRACKER_MARKERS, *(p.lower() for p in prefixes)]))


def _identity(topic: Column, tag_markers: Sequence[str], prefixes: Iterable[str]) -> Column:
    return F.coalesce(
        segment_after_any(topic, tag_markers),
        tracker_segment(topic, _markers(prefixes)),
        F.try_element_at(segments(topic), F.lit(-1)),
        F.lit(UNKNOWN),
    )


def entity_id(topic: Column) -> Column:
    """Entity named by a topic, as the normaliser reads it."""
    return _identity(topic, NORMALISE_TAG_MARKERS, ())


def device_id(topic: Column, prefixes: Iterable[str] = ()) -> Column:
    """Device named by a topic, as the ingest path reads it."""
    return _identity(topic, INGEST_TAG_MARKERS, prefixes)


def message_key(topic: Column, prefixes: Iterable[str] = ()) -> Column:
    return device_id(topic, prefixes).cast("binary")


def is_tracker_topic(topic: Column, prefixes: Iterable[str] = ()) -> Column:
    """True when a whole segment is one of the tracker markers."""
    markers = F.array(*[F.lit(m) for m in _markers(prefixes)])
    return F.arrays_overlap(lower_segments(topic), markers)


def event_source(topic: Column, prefixes: Iterable[str] = ()) -> Column:
    return F.when(is_tracker_topic(topic, prefixes), TRACKER_SOURCE).otherwise(BRIDGE_SOURCE)


def contains_any(text: Column, needles: Iterable[str]) -> Column:
    hit = F.lit(False)
    for needle in needles:
        hit = hit | text.contains(needle)
    return hit


def first_rule(text: Column, rules: Iterable[tuple[str, Sequence[str]]]) -> Column:
    """Name of the first rule one of whose substrings occurs; NULL when none does."""
    return F.coalesce(*[F.when(contains_any(text, needles), F.lit(n)) for n, needles in rules])


def raw_topic(topic: Column, default: str = RAW_SENSOR, prefixes: Iterable[str] = ()) -> Column:
    """Raw topic a message belongs on."""
    lowered = F.lower(topic)
    sensor = lowered.contains("sensor") | (
        is_tracker_topic(topic, prefixes) & contains_any(lowered, SENSOR_WORDS)
    )
    return F.coalesce(
        first_rule(lowered, ROUTING_RULES), F.when(sensor, F.lit(RAW_SENSOR)), F.lit(default)
    )


def event_kind(source_topic: Column, mqtt_topic: Column) -> Column:
    """Kind of an event: by its raw topic, else by substrings of the message topic."""
    by_source = F.coalesce(
        *[F.when(F.lower(source_topic) == t, F.lit(k)) for t, k in KIND_OF_RAW_TOPIC.items()]
    )
    return F.coalesce(by_source, first_rule(F.lower(mqtt_topic), KIND_RULES), F.lit(UNKNOWN))


def subscribed(topic: Column, subscriptions: Iterable[str] = DEFAULT_SUBSCRIPTIONS) -> Column:
    """True when a topic matches one of the subscription filters.

    A filter that is a literal path ending in ``/#`` becomes an equality and a
    prefix test, which reach the file scan; others become a pattern. A wildcard
    in the first level does not match topics that start with ``$``.
    """
    hit = F.lit(False)
    for subscription in subscriptions:
        pattern = re.sub(r"^\$share/[^/]+/", "", subscription.strip())
        base = pattern.removesuffix("/#")
        if "+" not in base and "#" not in base and base != pattern:
            hit = hit | (topic == base) | topic.startswith(base + "/")
            continue
        levels = [
            "[^/]*" if level == "+" else r"\Q" + level + r"\E" for level in base.split("/")
        ]
        if pattern == "#":
            expression = ".*"
        else:
            expression = "/".join(levels) + ("(/.*)?" if base != pattern else "")
        wild = pattern[:1] in ("#", "+")
        hit = hit | topic.rlike("^" + ("(?!\\$)" if wild else "") + expression + "$")
    return hit
