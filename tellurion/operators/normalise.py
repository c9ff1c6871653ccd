"""Raw event texts to the fixed nine-column row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellurion.functions import clock, jsonx, topics
from tellurion.functions.once import with_once

# Columns of a normalised event, in order.
COLUMNS = (
    "entity_id", "event_ts", "source_topic", "mqtt_topic", "event_kind", "payload_b64",
    "qos", "retain", "raw_json",
)


# Keys of a raw event that a normalised event draws on.
KEYS = ("device_id", "timestamp", "ingested_at", "mqtt_topic", "payload_b64", "qos", "retain")


def _integer(value: str, kind: str) -> Column:
    """A value as an integer: numbers are cut, texts are read, the rest is zero."""
    return F.expr(
        f"""coalesce(CASE WHEN {kind} = 'STRING'
          THEN try_cast(trim(try_variant_get({value}, '$', 'string')) AS INT)
          ELSE try_cast(try_variant_get({value}, '$', 'double') AS INT) END, 0)"""
    )


def normalised(
    records: DataFrame, topic: str = "source_topic", raw: str = "raw_json"
) -> DataFrame:
    """One row per record whose text is a JSON object; other columns are kept.

    The input text is passed on as it came. Records that do not parse, or that
    are not objects, give no row.
    """
    kept = [c for c in records.columns if c not in (topic, raw)]
    named = records.select(
        *kept, F.col(topic).alias("source_topic"), F.col(raw).alias("raw_json")
    )
    documents = jsonx.with_document(named, "_document", "raw_json")
    opened = with_once(documents, "_m", jsonx.members("_document", KEYS))
    objects = opened.filter(F.col("_m").isNotNull())
    typed = objects.withColumns({f"_k_{k}": F.expr(f"schema_of_variant(_m.{k})") for k in KEYS})

    def of(name: str) -> tuple[str, str]:
        return f"_m.{name}", f"_k_{name}"

    sent = typed.withColumn(
        "mqtt_topic", F.coalesce(jsonx.text(*of("mqtt_topic")), F.lit(""))
    )
    entity = F.when(jsonx.truthy(*of("device_id")), jsonx.text(*of("device_id"))).otherwise(
        topics.entity_id(F.col("mqtt_topic"))
    )
    # Joins and windows on the entity would otherwise repeat how it is found.
    return with_once(sent, "entity_id", entity).select(
        *kept,
        "entity_id",
        clock.event_time(*of("timestamp"), *of("ingested_at")).alias("event_ts"),
        "source_topic",
        "mqtt_topic",
        topics.event_kind(F.col("source_topic"), F.col("mqtt_topic")).alias("event_kind"),
        F.coalesce(jsonx.text(*of("payload_b64")), F.lit("")).alias("payload_b64"),
        _integer(*of("qos")).alias("qos"),
        jsonx.truthy(*of("retain")).alias("retain"),
        "raw_json",
    )


def as_text(events: DataFrame) -> Column:
    """Compact JSON of a normalised event with its nine names in order."""
    return jsonx.to_text(F.struct(*[events[name] for name in COLUMNS]))


def with_event_time(events: DataFrame) -> DataFrame:
    """Add the typed instant of ``event_ts``, NULL when the text is no timestamp."""
    return events.withColumn("event_time", F.try_to_timestamp(F.col("event_ts")))
