"""The streaming forms of queries: each runs over all files and ends.

Results are written to a run folder under the checkpoint folder of the session
and read back, so that nothing is held by the driver.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tellurion.operators import normalise
from tellurion.plans import ingest, state, views
from tellurion.plans.registry import query
from tellurion.session import run_folder
from tellurion.sources import changes
from tellurion.streaming import jobs
from tellurion.streaming.keyed import KeyedTable


def _finished(spark, name, start):
    """Run a streaming job to its end and return the folder of its output."""
    root = run_folder(spark, name)
    start(f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


def _records(spark, sf_dir):
    rows = views.view(spark, sf_dir, views.raw_records, streaming=True)
    return rows.select("event_id", "arrival_seq", "source_topic", "raw_json")


def _messages(spark, sf_dir):
    messages = views.view(spark, sf_dir, views.messages, streaming=True)
    return messages.withColumn("arrived_at", F.col("arrived_at").cast("timestamp"))


@query(f"""SELECT event_id, entity_id, event_ts, source_topic, mqtt_topic, event_kind, CAST(qos AS INT) AS qos, retain
  FROM ({state.NORMALISED}) n""")
def stream_normalised(spark, sf_dir):
    """Normalised events from a stream."""
    out = _finished(
        spark, "normalised",
        lambda path, mark: jobs.normalised_stream(_records(spark, sf_dir), path, mark, once=True),
    )
    return spark.read.parquet(out).select(
        "event_id", "entity_id", "event_ts", "source_topic", "mqtt_topic", "event_kind", "qos", "retain"
    )


@query(f"SELECT event_id, entity_id, event_ts FROM ({state.ACCEPTED}) a WHERE accepted")
def stream_latest(spark, sf_dir):
    """Accepted rows from a stream with keyed state."""
    return _latest(spark, sf_dir, "latest")


@query(f"SELECT event_id, entity_id, event_ts FROM ({state.ACCEPTED}) a WHERE accepted")
def stream_latest_batches(spark, sf_dir):
    """The same rows with each batch cut into many small blocks."""
    return _latest(spark, sf_dir, "latest-batches", block_rows=1024)


def _latest(spark, sf_dir, name, **options):
    events = normalise.normalised(_records(spark, sf_dir)).select(
        "event_id", "arrival_seq", "entity_id", "event_ts"
    )
    out = _finished(
        spark, name,
        lambda path, mark: jobs.accepted_by_batch(
            events, path, mark, ("arrival_seq", "event_id"), once=True, **options
        ),
    )
    return spark.read.parquet(f"{out}/accepted").select("event_id", "entity_id", "event_ts")


TEXTS = f"""SELECT event_id, entity_id, accepted, '{{"entity_id":"' || entity_id || '","event_ts":"' || event_ts ||
  '","source_topic":"' || source_topic || '","mqtt_topic":"' || mqtt_topic || '","event_kind":"' || event_kind ||
  '","payload_b64":"' || payload_b64 || '","qos":' || qos || ',"retain":' || retain || ',"raw_json":' ||
  CAST(to_json(raw_json) AS STRING) || '}}' AS value,
  row_number() OVER (PARTITION BY entity_id ORDER BY event_ts DESC, arrival_seq DESC, event_id DESC) AS r
  FROM ({state.ACCEPTED}) a"""


@query(f"""SELECT 'feature' AS kind, event_id, entity_id, value FROM ({TEXTS}) t
  UNION ALL SELECT 'accepted', event_id, entity_id, value FROM ({TEXTS}) t WHERE accepted
  UNION ALL SELECT 'state', event_id, entity_id, value FROM ({TEXTS}) t WHERE r = 1""")
def stream_features_and_state(spark, sf_dir):
    """Features, accepted rows and final states that one stream writes."""
    records = _records(spark, sf_dir)
    order = ("arrival_seq", "event_id")
    out = _finished(
        spark, "features-and-state",
        lambda path, mark: jobs.features_and_state(records, path, mark, order, once=True),
    )
    features = spark.read.parquet(f"{out}/features")
    accepted = spark.read.parquet(f"{out}/accepted")
    events = normalise.normalised(_records(spark, sf_dir)).schema
    held = KeyedTable(spark, f"{out}/state", events, ["entity_id"], ["event_ts", *order]).rows()

    def named(kind, rows, key, value):
        return rows.select(F.lit(kind).alias("kind"), "event_id", key.alias("entity_id"), value.alias("value"))

    return (
        named("feature", features, F.col("entity_id"), normalise.as_text(features))
        .unionByName(named("accepted", accepted, F.col("key"), F.col("value")))
        .unionByName(named("state", held, F.col("entity_id"), normalise.as_text(held)))
    )


@query(f"""SELECT entity_id, event_ts, event_id FROM (SELECT *, row_number() OVER
  (PARTITION BY entity_id ORDER BY event_ts DESC, arrival_seq DESC, event_id DESC) AS r
  FROM ({state.NORMALISED}) n) x WHERE r = 1""")
def stream_state_table(spark, sf_dir):
    """Final state per entity, folded batch by batch."""
    events = normalise.normalised(_records(spark, sf_dir)).select(
        "event_id", "arrival_seq", "entity_id", "event_ts"
    )
    order = ("arrival_seq", "event_id")
    out = _finished(
        spark, "state", lambda path, mark: jobs.state_table(events, path, mark, order, once=True)
    )
    held = KeyedTable(spark, out, events.schema, ["entity_id"], ["event_ts", *order]).rows()
    return held.select("entity_id", "event_ts", "event_id")


@query(ingest.CATEGORY_COUNTS)
def stream_dlq_windows(spark, sf_dir):
    """Errors per day and category from a stream."""
    out = _finished(
        spark, "dead-letters",
        lambda path, mark: jobs.updated(
            jobs.dead_letter_windows(_messages(spark, sf_dir)), path, mark, once=True
        ),
    )
    counts = jobs.current(spark.read.parquet(out), ["window_start", "category"])
    return counts.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "category", "n")


@query(f"""SELECT CASE WHEN errs = '' THEN route ELSE 'dlq.events' END AS topic, {ingest.DEVICE} AS key, count(*) AS n
  FROM ({ingest.OUTCOME}) o GROUP BY 1, 2""")
def stream_routed(spark, sf_dir):
    """Records per outgoing topic and key, written by a stream with one directory per topic."""
    out = _finished(
        spark, "routed",
        lambda path, mark: jobs.routed_stream(_messages(spark, sf_dir), path, mark, once=True),
    )
    return spark.read.parquet(out).groupBy("topic", "key").agg(F.count("*").alias("n"))


@query(f"""SELECT o_custkey AS id, "offset" || '.50' AS amount, ts_ms FROM (SELECT *, row_number() OVER
  (PARTITION BY o_custkey ORDER BY ts_ms DESC, "offset" DESC) AS r FROM {state.CHANGES} c) x WHERE r = 1 AND op <> 'd'""")
def stream_changes(spark, sf_dir):
    """Current rows of a table after a stream of its changes."""
    records = views.view(spark, sf_dir, views.change_records, streaming=True).select("offset", "value")
    parsed = changes.change_envelope(records, "id: BIGINT, amount: STRING")
    out = _finished(
        spark, "changes",
        lambda path, mark: jobs.upserted_changes(parsed, ["id"], path, mark, once=True),
    )
    table = jobs.changes_table(spark, out, jobs.changed_rows(parsed, ["id"]).schema, ["id"])
    return changes.folded(table.rows(), ["id"])
