"""Queries over device messages: routing, decoding, events, contracts, dead letters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tellurion.functions import jsonx, topics
from tellurion.operators import contracts, deadletters, ingest
from tellurion.plans import views
from tellurion.plans.registry import query
from tellurion.sources import landing

MESSAGES = views.duck(views.messages)

# The outcome of every message, case by case, as the SQL side states it.
ROUTE = """CASE event_type WHEN 'click' THEN 'raw.gps' WHEN 'purchase' THEN 'raw.video2d.meta'
  ELSE 'raw.sensor' END"""
DEVICE = """CASE event_type WHEN 'click' THEN 'dev-' || user_id WHEN 'view' THEN 'WF-' || user_id
  WHEN 'signup' THEN 'WF-' || user_id WHEN 'purchase' THEN 'cam-' || user_id
  ELSE 'orphan-' || user_id END"""
SOURCE = "CASE WHEN event_type IN ('view', 'signup') THEN 'wildfi-mqtt' ELSE 'mqtt-bridge' END"
SECONDS = "strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') || '+00:00'"
MILLIS = """CASE WHEN epoch_us(ts) // 1000 % 1000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
  ELSE strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00'"""
STAMP = f"""CASE
  WHEN event_type = 'click' THEN CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0 THEN ingested_at
    WHEN event_id % 5 = 0 THEN {MILLIS} ELSE {SECONDS} END
  WHEN event_type = 'view' THEN CASE WHEN event_id % 9 = 0 THEN ingested_at ELSE {MILLIS} END
  WHEN event_type = 'signup' THEN CASE WHEN event_id % 10 = 0 THEN ingested_at ELSE {SECONDS} END
  WHEN event_type = 'purchase' AND event_id % 2 = 1 AND event_id % 5 = 0 THEN '1970-01-01T00:02:03+00:00'
  ELSE ingested_at END"""
MISSING = (
    "missing required field: bucket; missing required field: format; "
    "missing required field: object_key; missing required field: object_uri; "
    "field not allowed by raw.video2d.meta: frame"
)
ERRORS = f"""CASE
  WHEN event_type = 'click' AND event_id % 11 = 0 THEN ''
  WHEN event_type = 'click' AND event_id % 7 = 0 THEN
    'latitude out of range: -90..90; longitude out of range: -180..180; speed_m_s must be non-negative'
  WHEN event_type = 'click' AND event_id % 5 = 0 THEN
    'missing required field: latitude; heading_deg out of range: 0..360'
  WHEN event_type = 'click' AND event_id % 3 = 0 THEN 'field must be numeric: longitude'
  WHEN event_type = 'purchase' AND event_id % 6 = 0 THEN
    'field must be an integer: width; size_bytes must be non-negative; frame_rate must be positive'
  WHEN event_type = 'purchase' AND event_id % 2 = 1 THEN '{MISSING}'
    || CASE WHEN event_id % 5 = 0 THEN '; field must be a string: timestamp' ELSE '' END
  ELSE '' END"""
OUTCOME = f"SELECT *, {ROUTE} AS route, {ERRORS} AS errs FROM {MESSAGES} m"


def _messages(spark, sf_dir):
    return views.view(spark, sf_dir, views.messages)


def _ingested(spark, sf_dir):
    return ingest.ingested(_messages(spark, sf_dir))


@query(f"SELECT event_id, {ROUTE} AS raw_topic FROM {MESSAGES} m")
def route_topics(spark, sf_dir):
    """Raw topic of every message."""
    return _messages(spark, sf_dir).select(
        "event_id", topics.raw_topic(F.col("topic")).alias("raw_topic")
    )


@query(f"""SELECT event_id, {DEVICE} AS device_id, {DEVICE} AS entity_id FROM {MESSAGES} m""")
def device_ids(spark, sf_dir):
    """Device and entity named by every topic."""
    return _messages(spark, sf_dir).select(
        "event_id",
        topics.message_key(F.col("topic")).cast("string").alias("device_id"),
        topics.entity_id(F.col("topic")).alias("entity_id"),
    )


@query(f"""SELECT event_id, {SOURCE} AS source,
  event_type IN ('view', 'signup') AS is_tracker FROM {MESSAGES} m""")
def event_sources(spark, sf_dir):
    """Source name by topic."""
    topic = F.col("topic")
    return _messages(spark, sf_dir).select(
        "event_id", topics.event_source(topic).alias("source"),
        topics.is_tracker_topic(topic).alias("is_tracker"),
    )


@query(f"""SELECT event_id, topic FROM {MESSAGES} m
  WHERE event_type IN ('click', 'view', 'purchase') OR (event_type = 'signup' AND event_id % 2 = 0)""")
def subscription_filter(spark, sf_dir):
    """Messages that the default subscriptions deliver."""
    return landing.subscribed_messages(_messages(spark, sf_dir)).select("event_id", "topic")


@query(f"""SELECT event_id, topic FROM {MESSAGES} m
  WHERE event_type = 'click' OR event_type = 'error'""")
def subscription_levels(spark, sf_dir):
    """Messages under filters with single-level wildcards."""
    filters = ["devices/+/gnss/#", "+"]
    return landing.subscribed_messages(_messages(spark, sf_dir), filters).select("event_id", "topic")


@query(f"""SELECT event_id,
  CASE WHEN event_type = 'error' AND (event_id % 3 = 0 OR event_id % 3 = 2) THEN 'OBJECT'
    WHEN event_type = 'error' THEN 'ARRAY' WHEN event_type = 'view' AND event_id % 9 = 0 THEN 'BIGINT'
    ELSE 'OBJECT' END AS shape,
  CASE WHEN event_type = 'error' AND event_id % 3 <> 1 THEN to_base64(payload) ELSE NULL END AS payload_b64
  FROM {MESSAGES} m""")
def payload_decode(spark, sf_dir):
    """Shape of the decoded payload, and the base64 text of what is no JSON."""
    return jsonx.with_decoded(_messages(spark, sf_dir), "body").select(
        "event_id",
        F.regexp_extract(jsonx.kind(F.col("body")), "^[A-Z]+", 0).alias("shape"),
        jsonx.as_string(jsonx.field(F.col("body"), "payload_b64")).alias("payload_b64"),
    )


@query(f"SELECT event_id, {STAMP} AS stamp FROM {MESSAGES} m")
def timestamps_normalised(spark, sf_dir):
    """Timestamp text picked from every payload."""
    return ingest.stamped(ingest.decoded(_messages(spark, sf_dir))).select("event_id", "stamp")


@query(f"""SELECT event_id, {DEVICE} AS device_id, {STAMP} AS stamp, ingested_at, topic AS mqtt_topic,
  CAST(qos AS BIGINT) AS qos, retain, {SOURCE} AS source,
  CASE WHEN event_type IN ('view', 'signup') AND NOT (event_type = 'view' AND event_id % 9 = 0)
    THEN cents END AS cents,
  CASE WHEN event_type = 'view' AND event_id % 9 = 0 THEN cents END AS bare_value
  FROM {MESSAGES} m WHERE {ROUTE} = 'raw.sensor'""")
def sensor_events(spark, sf_dir):
    """Sensor events with their envelope; bare values are wrapped."""
    event = F.col("event")

    def text(name):
        return jsonx.as_string(jsonx.field(event, name))

    rows = ingest.built(_messages(spark, sf_dir)).filter(F.col("intended_topic") == topics.RAW_SENSOR)
    return rows.select(
        "event_id", text("device_id").alias("device_id"), text("timestamp").alias("stamp"),
        text("ingested_at").alias("ingested_at"), text("mqtt_topic").alias("mqtt_topic"),
        F.try_variant_get(event, "$.qos", "bigint").alias("qos"),
        F.try_variant_get(event, "$.retain", "boolean").alias("retain"),
        text("source").alias("source"),
        F.try_variant_get(event, "$.payload.cents", "bigint").alias("cents"),
        F.try_variant_get(event, "$.payload.value", "bigint").alias("bare_value"),
    )


LAT = "CAST(CAST(event_id % 179 - 89 AS STRING) || '.25' AS DOUBLE)"
LON = "CAST(CAST(event_id % 359 - 179 AS STRING) || '.5' AS DOUBLE)"


@query(f"""SELECT event_id, {DEVICE} AS device_id, {STAMP} AS stamp,
  CASE WHEN event_id % 11 = 0 THEN 0.0 WHEN event_id % 7 = 0 THEN 91.5 WHEN event_id % 5 = 0 THEN NULL
    ELSE {LAT} END AS latitude,
  CASE WHEN event_id % 11 = 0 THEN 0.0 WHEN event_id % 7 = 0 THEN -200.25 WHEN event_id % 5 = 0 THEN {LON}
    WHEN event_id % 3 = 0 THEN NULL ELSE {LON} END AS longitude,
  CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0 OR event_id % 5 = 0 THEN NULL
    WHEN event_id % 3 = 0 THEN CAST(12.25 AS DOUBLE) END AS altitude_m,
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN -3.5 WHEN event_id % 5 = 0 THEN NULL
    WHEN event_id % 3 = 0 THEN NULL ELSE CAST(1.5 AS DOUBLE) END AS speed_m_s,
  CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 361.0
    WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 360 AS DOUBLE) END AS heading_deg
  FROM {MESSAGES} m WHERE event_type = 'click'""")
def gps_events(spark, sf_dir):
    """Position events with their aliases resolved."""
    event = F.col("event")
    rows = ingest.built(_messages(spark, sf_dir)).filter(F.col("intended_topic") == topics.RAW_GPS)
    return rows.select(
        "event_id",
        jsonx.as_string(jsonx.field(event, "device_id")).alias("device_id"),
        jsonx.as_string(jsonx.field(event, "timestamp")).alias("stamp"),
        *[jsonx.as_double(jsonx.field(event, n)).alias(n) for n in ingest.POSITION_KEYS],
    )


@query(f"""SELECT event_id,
  CASE WHEN event_id % 2 = 1 AND event_id % 5 = 0 THEN 'own-' || user_id ELSE 'cam-' || user_id END AS device_id,
  CASE WHEN event_id % 2 = 1 AND event_id % 5 = 0 THEN '123' ELSE ingested_at END AS stamp,
  CASE WHEN event_id % 2 = 1 THEN cents END AS frame,
  CASE WHEN event_id % 2 = 0 THEN 'k/' || event_id || '.mp4' END AS object_key,
  CASE WHEN event_id % 6 = 0 THEN -cents WHEN event_id % 2 = 0 THEN cents END AS size_bytes,
  CAST(qos AS BIGINT) AS qos, retain
  FROM {MESSAGES} m WHERE event_type = 'purchase'""")
def media_events(spark, sf_dir):
    """Media events: the payload under its envelope."""
    event = F.col("event")
    rows = ingest.built(_messages(spark, sf_dir)).filter(
        F.col("intended_topic").isin(*topics.MEDIA_TOPICS)
    )
    return rows.select(
        "event_id",
        jsonx.as_string(jsonx.field(event, "device_id")).alias("device_id"),
        jsonx.text("try_variant_get(event, '$.timestamp', 'variant')").alias("stamp"),
        F.try_variant_get(event, "$.frame", "bigint").alias("frame"),
        F.try_variant_get(event, "$.object_key", "string").alias("object_key"),
        F.try_variant_get(event, "$.size_bytes", "bigint").alias("size_bytes"),
        F.try_variant_get(event, "$.qos", "bigint").alias("qos"),
        F.try_variant_get(event, "$.retain", "boolean").alias("retain"),
    )


@query(f"SELECT event_id, route AS intended_topic, errs AS errors FROM ({OUTCOME}) o")
def contract_errors(spark, sf_dir):
    """Contract errors of every message, in order."""
    return _ingested(spark, sf_dir).select(
        "event_id", "intended_topic", F.array_join("errors", "; ").alias("errors")
    )


@query(f"""SELECT error, count(*) AS n FROM
  (SELECT unnest(string_split(errs, '; ')) AS error FROM ({OUTCOME}) o WHERE errs <> '') x GROUP BY error""")
def contract_error_counts(spark, sf_dir):
    """Messages per contract error."""
    return (
        _ingested(spark, sf_dir)
        .select(F.explode("errors").alias("error"))
        .groupBy("error")
        .agg(F.count("*").alias("n"))
    )


@query(f"""SELECT event_id, ingested_at AS stamp, 'mqtt-bridge' AS source, route AS intended_topic,
  topic AS source_topic,
  CASE WHEN event_type = 'purchase' AND event_id % 2 = 1 AND event_id % 5 = 0 THEN 'own-' || user_id
    ELSE {DEVICE} END AS device_id, errs AS errors
  FROM ({OUTCOME}) o WHERE errs <> ''""")
def dlq_events(spark, sf_dir):
    """Dead-letter records."""
    letters = _ingested(spark, sf_dir).filter(F.col("dead_letter").isNotNull())
    return letters.select(
        "event_id",
        F.col("dead_letter.timestamp").alias("stamp"),
        "dead_letter.source", "dead_letter.intended_topic", "dead_letter.source_topic",
        "dead_letter.device_id", F.array_join("dead_letter.errors", "; ").alias("errors"),
    )


@query(f"""SELECT CASE WHEN errs = '' THEN route ELSE 'dlq.events' END AS topic, route AS intended_topic,
  count(*) AS n, count(DISTINCT {DEVICE}) AS n_keys FROM ({OUTCOME}) o GROUP BY 1, 2""")
def routed_counts(spark, sf_dir):
    """Messages and keys per outgoing topic."""
    # Counting per key first keeps one row per key and task in the shuffle.
    per_key = (
        _ingested(spark, sf_dir)
        .groupBy(F.col("topic_out").alias("topic"), "intended_topic", "key")
        .agg(F.count("*").alias("n"))
    )
    return per_key.groupBy("topic", "intended_topic").agg(
        F.sum("n").alias("n"), F.count("*").alias("n_keys")
    )


@query(f"""SELECT event_id, CASE WHEN errs = '' THEN route ELSE 'dlq.events' END AS topic, {DEVICE} AS key,
  CASE WHEN errs = '' THEN 'device_id' ELSE 'intended_topic' END AS marker
  FROM ({OUTCOME}) o""")
def outgoing_records(spark, sf_dir):
    """Log records ready for a sink, identified by a field of their value."""
    rows = _ingested(spark, sf_dir)
    value = F.coalesce(F.to_json("dead_letter"), F.to_json("event"))
    parsed = rows.select("event_id", F.col("topic_out").alias("topic"), "key", value.alias("value"))
    is_letter = F.get_json_object("value", "$.intended_topic").isNotNull()
    is_event = F.get_json_object("value", "$.device_id").isNotNull()
    return parsed.select(
        "event_id", "topic", "key",
        F.when(is_letter, "intended_topic").when(is_event, "device_id").alias("marker"),
    )


@query(f"""SELECT event_id FROM {MESSAGES} m WHERE event_type = 'click' AND event_id % 11 = 0""")
def null_island(spark, sf_dir):
    """Position events without coordinates, which pass as zero."""
    flagged = contracts.with_null_island(ingest.built(_messages(spark, sf_dir)))
    return flagged.filter("null_island").select("event_id")


ERROR_ROWS = f"""SELECT date_trunc('day', ts) AS day, string_split(e, ':')[1] AS category FROM
  (SELECT ts, unnest(string_split(errs, '; ')) AS e FROM ({OUTCOME}) o WHERE errs <> '') x"""
CATEGORY_COUNTS = f"""SELECT strftime(day, '%Y-%m-%d') AS day, category, count(*) AS n
  FROM ({ERROR_ROWS}) r GROUP BY 1, 2"""


@query(CATEGORY_COUNTS)
def dlq_category_counts(spark, sf_dir):
    """Errors per day and category."""
    letters = _ingested(spark, sf_dir).filter(F.size("errors") > 0)
    counts = deadletters.category_counts(letters, "arrived_at", "1 day")
    return counts.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "category", "n")


@query(f"""SELECT day, category, n, place FROM (SELECT *, row_number() OVER
  (PARTITION BY day ORDER BY n DESC, category) AS place FROM ({CATEGORY_COUNTS}) c) p WHERE place <= 3""")
def dlq_top_categories(spark, sf_dir):
    """Three most frequent error categories of each day."""
    letters = _ingested(spark, sf_dir).filter(F.size("errors") > 0)
    counts = deadletters.category_counts(letters, "arrived_at", "1 day")
    return deadletters.top_categories(counts, 3).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "category", "n",
        F.col("place").cast("bigint").alias("place"),
    )


@query(f"""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n_messages,
  count(*) FILTER (errs <> '') AS n_dead,
  round(count(*) FILTER (errs <> '') / count(*), 6) AS dead_ratio FROM ({OUTCOME}) o GROUP BY 1""")
def dlq_rate(spark, sf_dir):
    """Share of dead letters per day."""
    rates = deadletters.letter_rate(_ingested(spark, sf_dir), "arrived_at", "1 day")
    return rates.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "n_messages", "n_dead",
        F.round("dead_ratio", 6).alias("dead_ratio"),
    )
