"""Queries over object listings: backfill records, their routing, summaries."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from tellurion.functions import clock, jsonx, objects
from tellurion.operators import backfill, conformance
from tellurion.plans import views
from tellurion.plans.registry import query
from tellurion.sources import listings, registry

LISTING = views.duck(views.listing)
AT = "2024-02-01T00:00:00+00:00"
SUFFIX = """CASE doc_id % 6 WHEN 0 THEN 'jpg' WHEN 1 THEN 'las' WHEN 2 THEN 'mp4' WHEN 5 THEN 'gz'
  ELSE 'bin' END"""
CONTENT = """CASE doc_id % 6 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'application/vnd.las'
  WHEN 2 THEN 'video/mp4' WHEN 5 THEN 'application/x-tar' ELSE 'application/octet-stream' END"""
TOPIC = "'raw.' || kind || '.meta'"
# Objects without a bucket also have no address.
MEDIA_ERRORS = """CASE WHEN bucket IS NULL THEN 'missing required field: bucket; missing required field: object_uri'
  || CASE WHEN size_bytes < 0 THEN '; size_bytes must be non-negative' ELSE '' END
  WHEN size_bytes < 0 THEN 'size_bytes must be non-negative' ELSE '' END"""
INTERVAL_START = "time_bucket(INTERVAL 30 MINUTE, last_modified)"


def _listing(spark, sf_dir):
    return listings.as_listing(views.view(spark, sf_dir, views.listing))


def _backfilled(spark, sf_dir):
    return backfill.backfilled(_listing(spark, sf_dir), F.lit(AT), F.col("kind"))


@query(f"""SELECT doc_id, {SUFFIX} AS format, {CONTENT} AS content_type FROM {LISTING} l""")
def object_formats(spark, sf_dir):
    """Format and content type by file name."""
    key = F.col("object_key")
    return _listing(spark, sf_dir).select(
        "doc_id", objects.object_format(key).alias("format"),
        objects.content_type(key).alias("content_type"),
    )


@query(f"""SELECT doc_id, kind, 'backfill' AS device_id, {TOPIC} AS topic,
  strftime(last_modified, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS stamp,
  's3://' || bucket || '/' || object_key AS object_uri, {SUFFIX} AS format, {CONTENT} AS content_type,
  size_bytes, CASE WHEN kind IN ('image2d', 'video2d') THEN 'unknown' END AS camera_id,
  CASE WHEN kind = 'image3d' THEN 'unknown' END AS capture_type,
  CASE WHEN kind = 'video3d' THEN 'unknown' END AS rig_id, kind AS tagged_kind FROM {LISTING} l""")
def backfill_records(spark, sf_dir):
    """Metadata record of every listed object."""
    event = F.col("event")
    rows = backfill.records(_listing(spark, sf_dir), F.lit(AT), F.col("kind"))

    def text(name):
        return jsonx.as_string(jsonx.field(event, name)).alias(name)

    return rows.select(
        "doc_id", "kind", text("device_id"), F.col("intended_topic").alias("topic"),
        text("timestamp").alias("stamp"), text("object_uri"), text("format"), text("content_type"),
        F.try_variant_get(event, "$.size_bytes", "bigint").alias("size_bytes"),
        text("camera_id"), text("capture_type"), text("rig_id"),
        F.try_variant_get(event, "$.tags.media_kind", "string").alias("tagged_kind"),
    )


@query(f"""SELECT doc_id, object_key AS key, CASE WHEN errs = '' THEN topic ELSE 'dlq.events' END AS topic,
  errs AS errors, CASE WHEN errs = '' THEN NULL ELSE coalesce('s3://' || bucket || '/' || object_key, '') END AS origin,
  CASE WHEN errs = '' THEN NULL ELSE 'airflow-backfill' END AS source
  FROM (SELECT *, {TOPIC} AS topic, {MEDIA_ERRORS} AS errs FROM {LISTING} l) x""")
def backfill_routed(spark, sf_dir):
    """Where every backfill record goes, and the origin of those that fail."""
    return _backfilled(spark, sf_dir).select(
        "doc_id", "key", F.col("topic_out").alias("topic"),
        F.array_join("errors", "; ").alias("errors"),
        F.col("dead_letter.source_topic").alias("origin"),
        F.col("dead_letter.source").alias("source"),
    )


@query(f"""SELECT bucket, kind AS media_kind, strftime({INTERVAL_START}, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS window_start,
  strftime({INTERVAL_START} + INTERVAL 30 MINUTE, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS window_end,
  {TOPIC} AS topic, count(*) FILTER ({MEDIA_ERRORS} = '') AS records_sent,
  count(*) FILTER ({MEDIA_ERRORS} <> '') AS records_invalid FROM {LISTING} l GROUP BY ALL""")
def backfill_summary(spark, sf_dir):
    """Records sent and rejected per bucket and half-hour interval."""
    return backfill.summary(_backfilled(spark, sf_dir))


@query(f"""SELECT doc_id, object_key FROM {LISTING} l WHERE last_modified >= TIMESTAMP '2024-01-01 02:00:00'
  AND last_modified < TIMESTAMP '2024-01-01 09:30:00'""")
def backfill_window(spark, sf_dir):
    """Objects of one half-open window."""
    start, end = clock.window_bounds("2024-01-01T02:00:00Z", "2024-01-01T10:30:00+01:00")
    rows = _listing(spark, sf_dir).filter(clock.in_window(F.col("last_modified"), start, end))
    return rows.select("doc_id", "object_key")


NOTES = views.duck(views.notifications)


@query(f"""SELECT doc_id, 'ObjectCreated:Put' AS event_name, source AS bucket, 'a/' || doc_id || '.png' AS object_key,
  n_chars AS size_bytes, 's3://' || source || '/a/' || doc_id || '.png' AS object_uri FROM {NOTES} n
  UNION ALL SELECT doc_id, 'ObjectRemoved:Delete', source, 'b/' || doc_id || '.png', n_chars,
  's3://' || source || '/b/' || doc_id || '.png' FROM {NOTES} n WHERE doc_id % 3 = 0""")
def object_notifications(spark, sf_dir):
    """Listing rows from nested store notifications."""
    notes = views.view(spark, sf_dir, views.notifications).select("doc_id", "value")
    return listings.notified_objects(notes).select(
        "doc_id", "event_name", "bucket", "object_key", "size_bytes", "object_uri"
    )


@query(f"""SELECT doc_id, regexp_replace(regexp_replace(object_key, '[^A-Za-z0-9_.-]+', '-', 'g'), '^-+|-+$', '', 'g')
  || '.zenodo-manifest.json' AS file_name FROM {LISTING} l""")
def file_names(spark, sf_dir):
    """Object keys as safe file names."""
    name = objects.file_safe(F.col("object_key"), ".zenodo-manifest.json")
    return _listing(spark, sf_dir).select("doc_id", name.alias("file_name"))


BEFORE = f"""SELECT bucket, CASE WHEN size_bytes % 5 = 0 THEN object_key || '.old' ELSE object_key END AS object_key,
  CASE WHEN size_bytes % 7 = 0 THEN size_bytes + 1 ELSE size_bytes END AS size_bytes, last_modified FROM {{listing}} l"""
NOW = "SELECT bucket, object_key, size_bytes, last_modified FROM {listing} l"


@query(f"""WITH o AS ({BEFORE.format(listing=LISTING)}), n AS ({NOW.format(listing=LISTING)})
  SELECT f.*, CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.bucket IS NOT DISTINCT FROM f.bucket AND o.object_key = f.object_key)
    THEN 'changed' ELSE 'added' END AS change FROM (SELECT * FROM n EXCEPT SELECT * FROM o) f
  UNION ALL SELECT DISTINCT o.*, 'removed' FROM o WHERE NOT EXISTS
    (SELECT 1 FROM n WHERE n.bucket IS NOT DISTINCT FROM o.bucket AND n.object_key = o.object_key)""")
def inventory_changes(spark, sf_dir):
    """Objects added, changed and removed since an earlier inventory, here with other names and sizes."""
    now = views.view(spark, sf_dir, views.listing)
    size = F.col("size_bytes")
    before = now.withColumns(
        {
            "object_key": F.when(size % 5 == 0, F.concat("object_key", F.lit(".old"))).otherwise(F.col("object_key")),
            "size_bytes": F.when(size % 7 == 0, size + 1).otherwise(size),
        }
    )
    return listings.changed_objects(before, now)


#: What a subscriber that takes small new objects expects of a notification.
SMALL_OBJECTS = """{"additionalProperties": false, "required": ["Records"], "properties": {"Records": {
  "type": "array", "minItems": 1, "items": {"required": ["eventName", "s3"], "properties": {
    "eventName": {"type": "string", "enum": ["ObjectCreated:Put"]},
    "s3": {"type": "object", "required": ["bucket", "object"], "properties": {
      "object": {"type": "object", "required": ["key", "eTag"], "properties": {
        "key": {"type": "string"}, "eTag": {"type": "string"},
        "size": {"type": "integer", "maximum": 300}}}}}}}}}}"""
_PLACES = "(SELECT n.*, unnest(CASE WHEN doc_id % 3 = 0 THEN [0, 1] ELSE [0] END) AS place FROM {rows} n) p"


@query(f"""SELECT doc_id, 'Records[' || place || '].s3.object.' || leaf AS field, rule FROM
    (SELECT doc_id, place, unnest(['eTag', 'size']) AS leaf, unnest(['required', 'maximum']) AS rule, n_chars
     FROM {_PLACES.format(rows=views.duck(views.notifications))}) x WHERE leaf = 'eTag' OR n_chars > 300
  UNION ALL SELECT doc_id, 'Records[1].eventName', 'enum' FROM {views.duck(views.notifications)} n WHERE doc_id % 3 = 0""")
def notification_violations(spark, sf_dir):
    """Rules of nested records that store notifications break, by path."""
    contract = registry.from_json_schema("small", SMALL_OBJECTS)
    notes = views.view(spark, sf_dir, views.notifications).withColumn("topic", F.lit("small"))
    found = conformance.violations(
        notes, registry.contract_table(spark, [contract]), registry.topic_table(spark, [contract]), record_id="doc_id"
    )
    return found.select(F.col("record_id").alias("doc_id"), "field", "rule")
