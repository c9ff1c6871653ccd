"""Messages to typed events, and events to their topic or the dead letters.

Input columns: ``topic, payload BINARY, qos INT, retain BOOLEAN, ingested_at
STRING``. All of it is column expressions, so the same functions serve tables
and streams and no step shuffles.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellurion.functions import clock, jsonx, topics
from tellurion.functions.once import with_once
from tellurion.operators import contracts

# Keys under which a position may arrive, first present wins.
POSITION_KEYS = {
    "latitude": ("latitude", "latitude_deg", "lat"),
    "longitude": ("longitude", "longitude_deg", "lon"),
    "altitude_m": ("altitude_m", "altitude"),
    "speed_m_s": ("speed_m_s", "speed"),
    "heading_deg": ("heading_deg", "heading"),
}
BODY_KEYS = tuple(
    dict.fromkeys(
        (*clock.TIMESTAMP_KEYS, *(k for keys in POSITION_KEYS.values() for k in keys), "device_id")
    )
)


def aliased(names: Iterable[str], default: str) -> Column:
    """Value of the first key present in the body, else a JSON default."""
    found = ", ".join(f"_b.{name}" for name in names)
    return F.expr(f"coalesce({found}, parse_json('{default}'))")


def decoded(
    messages: DataFrame, default_topic: str = topics.RAW_SENSOR, prefixes: Iterable[str] = ()
) -> DataFrame:
    """Add the decoded body and everything the topic alone decides."""
    topic = F.col("topic")
    prefixes = tuple(prefixes)
    named = messages.withColumns(
        {
            "intended_topic": topics.raw_topic(topic, default_topic, prefixes),
            "device_id": topics.device_id(topic, prefixes),
            "source": topics.event_source(topic, prefixes),
        }
    )
    return jsonx.with_decoded(named, "body")


def _envelope() -> dict[str, Column]:
    return {
        "ingested_at": F.col("ingested_at"),
        "mqtt_topic": F.col("topic"),
        "qos": F.col("qos"),
        "retain": F.col("retain"),
        "source": F.col("source"),
    }


def sensor_event() -> Column:
    body = F.col("body")
    payload = F.when(F.col("_b").isNotNull(), body).otherwise(jsonx.document(value=body))
    return jsonx.document(
        device_id=F.col("device_id"), timestamp=F.col("stamp"), payload=payload, **_envelope()
    )


def position_event() -> Column:
    payload = F.when(F.col("_b").isNotNull(), F.col("body")).otherwise(F.parse_json(F.lit("{}")))
    position = {
        name: aliased(keys, "0.0" if name in ("latitude", "longitude") else "null")
        for name, keys in POSITION_KEYS.items()
    }
    return jsonx.document(
        device_id=F.col("device_id"), timestamp=F.col("stamp"), payload=payload, **position,
        **_envelope(),
    )


def media_event() -> Column:
    """The payload's own keys under the envelope, which wins except for two keys."""
    body = F.col("body")
    given = F.coalesce(jsonx.fields_of(body), F.create_map().cast("map<string,variant>"))
    envelope = {
        "device_id": F.coalesce(F.col("_b.device_id"), F.col("device_id").cast("variant")),
        "timestamp": F.coalesce(F.col("_b.timestamp"), F.col("stamp").cast("variant")),
        **{name: value.cast("variant") for name, value in _envelope().items()},
    }
    own = F.map_filter(given, lambda key, _: ~key.isin(*envelope))
    added = F.create_map(*[c for n, v in envelope.items() for c in (F.lit(n), v)])
    return F.to_variant_object(F.map_concat(own, added))


def stamped(decoded_messages: DataFrame) -> DataFrame:
    """Add the members of the body as ``_b`` and the event timestamp as ``stamp``."""
    opened = decoded_messages.withColumn("_b", jsonx.members("body", BODY_KEYS))
    picked = opened.withColumn("_picked", clock.first_present("_b"))
    typed = picked.withColumn("_kind", F.expr("schema_of_variant(_picked)"))
    counted = typed.withColumn("_micros", clock.epoch_micros("_picked", "_kind"))
    stamp = clock.normalised("_picked", "_kind", "_micros", "ingested_at")
    return counted.withColumn("stamp", stamp).drop("_picked", "_kind", "_micros")


def built(
    messages: DataFrame, default_topic: str = topics.RAW_SENSOR, prefixes: Iterable[str] = ()
) -> DataFrame:
    """One event per message: ``intended_topic``, ``key`` and ``event`` are added."""
    event = (
        F.when(F.col("intended_topic") == topics.RAW_SENSOR, sensor_event())
        .when(F.col("intended_topic") == topics.RAW_GPS, position_event())
        .otherwise(media_event())
    )
    with_event = with_once(stamped(decoded(messages, default_topic, prefixes)), "event", event)
    return with_event.withColumn("key", F.col("device_id")).drop("body", "_b", "stamp")


def dead_letter(
    source: Column, intended_topic: Column, errors: Column, event: str, at: Column
) -> Column:
    """Dead-letter record of the event in a named column.

    The first origin that is not empty becomes its source topic.
    """
    def member(name: str) -> str:
        return f"try_variant_get({event}, '$.{name}', 'variant')"

    origins = [member(n) for n in ("source_topic", "mqtt_topic", "object_uri")]
    origin = F.coalesce(
        *[F.when(jsonx.truthy(o), jsonx.text(o)) for o in origins], F.lit("")
    )
    device = F.coalesce(jsonx.text(member("device_id")), F.lit(topics.UNKNOWN))
    return F.struct(
        at.alias("timestamp"),
        source.alias("source"),
        intended_topic.alias("intended_topic"),
        origin.alias("source_topic"),
        device.alias("device_id"),
        errors.alias("errors"),
        F.col(event).alias("raw_event"),
    )


def routed(events: DataFrame, source: str = topics.BRIDGE_SOURCE) -> DataFrame:
    """Add ``errors``, the ``topic_out`` of each event and its dead-letter record."""
    checked = contracts.with_errors(events)
    bad = F.size("errors") > 0
    record = dead_letter(
        F.lit(source),
        F.col("intended_topic"),
        F.col("errors"),
        "event",
        F.col("ingested_at"),
    )
    return checked.withColumns(
        {
            "topic_out": F.when(bad, F.lit(topics.DEAD_LETTER)).otherwise(F.col("intended_topic")),
            "dead_letter": F.when(bad, record),
        }
    )


def ingested(
    messages: DataFrame, default_topic: str = topics.RAW_SENSOR, prefixes: Iterable[str] = ()
) -> DataFrame:
    """Decode, build, validate and route a table or a stream of messages."""
    return routed(built(messages, default_topic, prefixes))


def dead_letters(events: DataFrame) -> DataFrame:
    """The dead-letter records of routed events."""
    return events.filter(F.col("dead_letter").isNotNull()).select("key", "dead_letter.*")


def outgoing(events: DataFrame) -> DataFrame:
    """Log records ``(topic, key, value)`` of routed events."""
    value = F.coalesce(F.to_json("dead_letter"), F.to_json("event"))
    return events.select(F.col("topic_out").alias("topic"), "key", value.alias("value"))
