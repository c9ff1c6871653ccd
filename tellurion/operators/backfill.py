"""Media metadata records from object listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellurion.functions import clock, jsonx, objects, topics
from tellurion.functions.once import with_once
from tellurion.operators import contracts
from tellurion.operators.ingest import dead_letter

# Topics and default fields by media kind, names written into records.
TOPIC_OF_KIND = {k: t for t, k in topics.KIND_OF_RAW_TOPIC.items() if t in topics.MEDIA_TOPICS}
KIND_DEFAULTS = {
    "image2d": ("camera_id",),
    "image3d": ("sensor_id", "capture_type"),
    "video2d": ("camera_id",),
    "video3d": ("rig_id", "representation"),
}
KIND_OF_BUCKET = {
    "media-raw-2d-images": "image2d",
    "media-raw-3d-images": "image3d",
    "media-raw-2d-videos": "video2d",
    "media-raw-3d-videos": "video3d",
}
BACKFILL_SOURCE = "airflow-backfill"
BACKFILL_DEVICE = "backfill"
INTERVAL = "30 minutes"


def media_kind(bucket: Column) -> Column:
    return F.coalesce(*[F.when(bucket == b, F.lit(k)) for b, k in KIND_OF_BUCKET.items()])


def topic_of(kind: Column) -> Column:
    return F.coalesce(*[F.when(kind == k, F.lit(t)) for k, t in TOPIC_OF_KIND.items()])


def record(kind: Column, ingested_at: Column) -> Column:
    """Metadata record of one object: ``bucket, object_key, object_uri, size_bytes, timestamp``."""
    key = F.col("object_key")
    base = {
        "device_id": F.lit(BACKFILL_DEVICE),
        "timestamp": F.col("timestamp"),
        "ingested_at": ingested_at,
        "bucket": F.col("bucket"),
        "object_key": key,
        "object_uri": F.col("object_uri"),
        "format": objects.object_format(key),
        "content_type": objects.content_type(key),
        "size_bytes": F.col("size_bytes"),
    }
    pairs = [c for n, v in base.items() for c in (F.lit(n), v.cast("variant"))]
    tags = jsonx.document(source=F.lit(BACKFILL_SOURCE), media_kind=kind)
    unknown = F.lit(topics.UNKNOWN).cast("variant")
    defaults = F.coalesce(
        *[
            F.when(kind == k, F.create_map(*[c for n in names for c in (F.lit(n), unknown)]))
            for k, names in KIND_DEFAULTS.items()
        ],
        F.create_map().cast("map<string,variant>"),
    )
    return F.to_variant_object(
        F.map_concat(F.create_map(*pairs, F.lit("tags"), tags), defaults)
    )


def records(listing: DataFrame, ingested_at: Column, kind: Column | None = None) -> DataFrame:
    """Add ``media_kind``, ``intended_topic`` and ``event`` to a listing."""
    of_kind = media_kind(F.col("bucket")) if kind is None else kind
    with_kind = listing.withColumn("media_kind", of_kind)
    with_topic = with_kind.withColumn("intended_topic", topic_of(F.col("media_kind")))
    return with_once(with_topic, "event", record(F.col("media_kind"), ingested_at))


def routed(rows: DataFrame, at: Column) -> DataFrame:
    """Validate backfill records and send the invalid ones to the dead letters."""
    checked = contracts.with_errors(rows)
    bad = F.size("errors") > 0
    address = F.concat(F.lit("s3://"), F.col("bucket"), F.lit("/"), F.col("object_key"))
    origin = F.create_map(F.lit("source_topic"), address.cast("variant"))
    raw = F.to_variant_object(F.map_concat(jsonx.fields_of(F.col("event")), origin))
    with_raw = with_once(checked, "_raw", F.when(bad, raw))
    letter = dead_letter(F.lit(BACKFILL_SOURCE), F.col("intended_topic"), F.col("errors"), "_raw", at)
    routes = with_raw.withColumns(
        {
            "key": F.col("object_key"),
            "topic_out": F.when(bad, F.lit(topics.DEAD_LETTER)).otherwise(F.col("intended_topic")),
            "dead_letter": F.when(bad, letter),
        }
    )
    return routes.drop("_raw")


def backfilled(listing: DataFrame, at: Column, kind: Column | None = None) -> DataFrame:
    return routed(records(listing, at, kind), at)


def summary(rows: DataFrame, instant: str = "last_modified", width: str = INTERVAL) -> DataFrame:
    """Records sent and rejected per bucket, kind, topic and half-open interval."""
    bad = F.size("errors") > 0
    return (
        rows.groupBy(
            "bucket", "media_kind", F.window(instant, width).alias("w"),
            F.col("intended_topic").alias("topic"),
        )
        .agg(F.count_if(~bad).alias("records_sent"), F.count_if(bad).alias("records_invalid"))
        .select(
            "bucket",
            "media_kind",
            clock.iso_timestamp(F.col("w.start")).alias("window_start"),
            clock.iso_timestamp(F.col("w.end")).alias("window_end"),
            "topic",
            "records_sent",
            "records_invalid",
        )
    )
