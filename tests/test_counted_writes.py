"""Counts taken while rows are written equal those of the aggregate."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tellurion.functions import topics
from tellurion.operators import backfill
from tellurion.sources import listings, sinks

NAMES = [*topics.MEDIA_TOPICS, topics.DEAD_LETTER]
BUCKETS = ("media-raw-2d-images", "media-raw-3d-images", "media-raw-2d-videos", "media-raw-3d-videos")
SHAPE = "bucket STRING, object_key STRING, size_bytes BIGINT, last_modified TIMESTAMP"


def listed(spark, n):
    start = datetime(2026, 1, 1)
    rows = [(BUCKETS[k % 3], f"k/{k}.mp4", -1 if k % 7 == 0 else k, start + timedelta(minutes=k)) for k in range(n)]
    return spark.createDataFrame(rows, SHAPE)


def routed(listing):
    return backfill.backfilled(listings.as_listing(listing), F.lit("now"))


def outgoing(rows):
    return rows.select(F.col("topic_out").alias("topic"), "key", F.to_json("event").alias("value"))


def expected(rows):
    counts = {"records": 0, **dict.fromkeys(NAMES, 0)}
    for r in backfill.summary(rows).collect():
        counts[r["topic"]] += r["records_sent"]
        counts[topics.DEAD_LETTER] += r["records_invalid"]
        counts["records"] += r["records_sent"] + r["records_invalid"]
    return counts


def test_counts_of_a_write(spark, tmp_path):
    rows = routed(listed(spark, 100))
    counts = sinks.write_counted(outgoing(rows), str(tmp_path / "t"), NAMES)
    assert counts == expected(rows) and counts[topics.DEAD_LETTER] == 15
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100


def test_counts_of_nothing(spark, tmp_path):
    rows = routed(listed(spark, 20)).where(F.length("key") > 99)
    counts = sinks.write_counted(outgoing(rows), str(tmp_path / "t"), NAMES)
    assert counts == {"records": 0, **dict.fromkeys(NAMES, 0)}


def test_counts_of_a_stream_by_batch(spark, tmp_path):
    listing = listed(spark, 60)
    for part in range(3):
        listing.where(F.length("object_key") % 3 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found = {}

    def write(batch, batch_id):
        # A repeated batch replaces its counts as it replaces its rows.
        found[batch_id] = sinks.write_counted(outgoing(routed(batch)), str(tmp_path / "out"), NAMES, batch_id)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "c"))
    query = writer.trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    assert len(found) > 1
    assert {n: sum(c[n] for c in found.values()) for n in ("records", *NAMES)} == expected(routed(listing))
