"""Queries over raw records: normalisation, latest state, registers, changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tellurion.operators import blocks, latest, normalise
from tellurion.plans import views
from tellurion.plans.registry import query
from tellurion.session import run_folder
from tellurion.sources import changes, dated, landing

RECORDS = views.duck(views.raw_records)
INFERRED = """CASE WHEN form = 9 THEN 'unknown' WHEN event_type = 'click' THEN 'dev-' || user_id
  WHEN event_type IN ('view', 'signup') THEN 'WF-' || user_id WHEN event_type = 'purchase' THEN 'cam-' || user_id
  WHEN slot = 7 THEN 'frame' ELSE 'orphan-' || user_id END"""
KIND = """CASE slot WHEN 0 THEN 'sensor' WHEN 1 THEN 'gps' WHEN 2 THEN 'image2d' WHEN 3 THEN 'image3d'
  WHEN 4 THEN 'video2d' WHEN 5 THEN 'video3d' ELSE CASE WHEN form = 9 THEN 'unknown'
  WHEN event_type = 'click' THEN 'gps' WHEN event_type = 'purchase' THEN 'video2d'
  WHEN slot = 7 THEN 'image3d' ELSE 'unknown' END END"""
NORMALISED = f"""SELECT event_id, arrival_seq, source_topic, raw_json,
  CASE WHEN form IN (2, 8, 9) THEN {INFERRED} ELSE 'dev-' || user_id END AS entity_id,
  CASE WHEN form IN (3, 4) THEN '2024-06-01T00:00:00+00:00' WHEN form = 10 THEN '' ELSE stamp END AS event_ts,
  CASE WHEN form = 9 THEN '' ELSE sent_topic END AS mqtt_topic, {KIND} AS event_kind,
  CASE WHEN form = 11 THEN 'YWJj' ELSE '' END AS payload_b64,
  CASE form WHEN 2 THEN event_id % 3 WHEN 5 THEN 1 WHEN 11 THEN 2 ELSE 0 END AS qos,
  form IN (5, 9, 11) AS retain
  FROM {RECORDS} r WHERE form NOT IN (0, 1, 7)"""
ACCEPTED = f"""SELECT *, coalesce(event_ts >= max(event_ts) OVER (PARTITION BY entity_id
  ORDER BY arrival_seq, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS accepted
  FROM ({NORMALISED}) n"""


def _records(spark, sf_dir):
    records = views.view(spark, sf_dir, views.raw_records)
    return records.select("event_id", "arrival_seq", "source_topic", "raw_json")


def _cuts(spark, sf_dir, rows):
    """Cuts of the arrival order, measured on the stored column before any text is parsed."""
    return blocks.cuts(views.view(spark, sf_dir, views.raw_records), "arrival_seq", rows)


def _normalised(spark, sf_dir):
    return normalise.normalised(_records(spark, sf_dir))


@query(f"""SELECT event_id, entity_id, event_ts, source_topic, mqtt_topic, event_kind, payload_b64,
  CAST(qos AS INT) AS qos, retain, raw_json FROM ({NORMALISED}) n""")
def normalised_events(spark, sf_dir):
    """The nine columns of every record that is a JSON object."""
    return _normalised(spark, sf_dir).select("event_id", *normalise.COLUMNS)


@query(f"""SELECT event_id, '{{"entity_id":"' || entity_id || '","event_ts":"' || event_ts ||
  '","source_topic":"' || source_topic || '","mqtt_topic":"' || mqtt_topic || '","event_kind":"' || event_kind ||
  '","payload_b64":"' || payload_b64 || '","qos":' || qos || ',"retain":' || retain || ',"raw_json":' ||
  CAST(to_json(raw_json) AS STRING) || '}}' AS value FROM ({NORMALISED}) n""")
def feature_texts(spark, sf_dir):
    """Compact JSON of every normalised event."""
    events = _normalised(spark, sf_dir)
    return events.select("event_id", normalise.as_text(events).alias("value"))


@query(f"""SELECT source_topic, event_kind, count(*) AS n FROM ({NORMALISED}) n GROUP BY 1, 2""")
def event_kind_counts(spark, sf_dir):
    """Events per source topic and kind."""
    return _normalised(spark, sf_dir).groupBy("source_topic", "event_kind").agg(
        F.count("*").alias("n")
    )


@query(f"""SELECT event_id, entity_id, event_ts FROM ({ACCEPTED}) a WHERE accepted""")
def latest_accepted(spark, sf_dir):
    """Rows that update the state of their entity when they arrive."""
    at = _cuts(spark, sf_dir, latest.BLOCK_ROWS)
    rows = latest.accepted(_normalised(spark, sf_dir), tie="event_id", cuts=at)
    return rows.select("event_id", "entity_id", "event_ts")


@query(f"""SELECT event_id, entity_id, event_ts FROM ({ACCEPTED}) a WHERE accepted""")
def latest_accepted_blocks(spark, sf_dir):
    """The same rows with histories cut into many small blocks."""
    at = _cuts(spark, sf_dir, 512)
    # Columns that one side of the scan would not use keep it from sharing its exchange.
    events = _normalised(spark, sf_dir).select("event_id", "entity_id", "event_ts", "arrival_seq")
    rows = latest.accepted(events, tie="event_id", cuts=at)
    return rows.select("event_id", "entity_id", "event_ts")


@query(f"""SELECT event_id, entity_id FROM (SELECT *, coalesce(t, TIMESTAMPTZ '0001-01-01') >= coalesce(max(t) OVER (PARTITION BY entity_id
  ORDER BY arrival_seq, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TIMESTAMPTZ '0001-01-01') AS accepted
  FROM (SELECT *, TRY_CAST(nullif(event_ts, '') AS TIMESTAMPTZ) AS t FROM ({NORMALISED}) n) q) a
  WHERE accepted""")
def latest_accepted_by_instant(spark, sf_dir):
    """Acceptance by parsed instants instead of texts; rows without one rank lowest."""
    timed = normalise.with_event_time(_normalised(spark, sf_dir))
    at = _cuts(spark, sf_dir, latest.BLOCK_ROWS)
    rows = latest.accepted(timed, tie="event_id", order_by="event_time", cuts=at)
    return rows.select("event_id", "entity_id")


def _log(spark, sf_dir):
    """The records as two topic logs in one table."""
    rows = views.view(spark, sf_dir, views.raw_records)
    log = rows.select(
        "slot", F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("raw_json").cast("binary").alias("value"), F.col("source_topic").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    return landing.union_logs([log.where("slot < 4").drop("slot"), log.where("slot >= 4").drop("slot")])


@query(f"""SELECT event_id AS log_offset, source_topic, raw_json, epoch_us(ts) AS arrival_seq FROM {RECORDS} r""")
def log_records(spark, sf_dir):
    """Log rows as raw records with their place in the order of arrival."""
    return landing.raw_records(_log(spark, sf_dir)).select(
        F.col("offset").alias("log_offset"), "source_topic", "raw_json", "arrival_seq"
    )


@query(f"""SELECT entity_id, event_ts, source_topic, event_id AS log_offset FROM (SELECT n.*, row_number() OVER
  (PARTITION BY entity_id ORDER BY event_ts DESC, epoch_us(r.ts) DESC, n.source_topic DESC, n.event_id % 4 DESC, n.event_id DESC) AS k
  FROM ({NORMALISED}) n JOIN (SELECT event_id, ts FROM {RECORDS} q) r USING (event_id)) x WHERE k = 1""")
def log_latest_state(spark, sf_dir):
    """Final state of every entity from log rows alone."""
    rows = normalise.normalised(landing.raw_records(_log(spark, sf_dir)))
    state = latest.latest_state(rows, tie="arrival_tie")
    return state.select("entity_id", "event_ts", "source_topic", F.col("offset").alias("log_offset"))


@query(f"""SELECT event_id AS log_offset, entity_id, event_ts, coalesce(event_ts >= max(event_ts) OVER (PARTITION BY entity_id
  ORDER BY us, source_topic, event_id % 4, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS accepted
  FROM (SELECT n.*, epoch_us(r.ts) AS us FROM ({NORMALISED}) n JOIN (SELECT event_id, ts FROM {RECORDS} q) r USING (event_id)) j""")
def log_acceptance(spark, sf_dir):
    """Acceptance on log rows, whose order of arrival counts microseconds."""
    log = landing.raw_records(_log(spark, sf_dir))
    at = blocks.cuts(log, "arrival_seq", 2048)
    judged = latest.with_acceptance(normalise.normalised(log), tie="arrival_tie", cuts=at)
    return judged.select(F.col("offset").alias("log_offset"), "entity_id", "event_ts", "accepted")


@query(f"""SELECT entity_id, event_ts, event_id, event_kind, source_topic FROM (SELECT *, row_number() OVER
  (PARTITION BY entity_id ORDER BY event_ts DESC, arrival_seq DESC, event_id DESC) AS r
  FROM ({NORMALISED}) n) x WHERE r = 1""")
def latest_state(spark, sf_dir):
    """Final state of every entity."""
    rows = _normalised(spark, sf_dir).select(
        "entity_id", "event_ts", "arrival_seq", "event_id", "event_kind", "source_topic"
    )
    return latest.latest_state(rows, tie="event_id").select(
        "entity_id", "event_ts", "event_id", "event_kind", "source_topic"
    )


@query(f"""SELECT event_kind, count(*) AS n_features, count(*) FILTER (accepted) AS n_state,
  count(*) FILTER (NOT accepted) AS n_stale FROM ({ACCEPTED}) a GROUP BY 1""")
def stale_counts(spark, sf_dir):
    """Rows that reach the features, the state, and that are stale."""
    at = _cuts(spark, sf_dir, latest.BLOCK_ROWS)
    judged = latest.with_acceptance(_normalised(spark, sf_dir), tie="event_id", cuts=at)
    return judged.groupBy("event_kind").agg(
        F.count("*").alias("n_features"),
        F.count_if("accepted").alias("n_state"),
        F.count_if(~F.col("accepted")).alias("n_stale"),
    )


FINDINGS = views.duck(views.findings)


@query(f"""SELECT finding_id, asset_id, severity, status, updated_us FROM (SELECT *, row_number() OVER
  (PARTITION BY finding_id ORDER BY updated_us DESC, tie DESC, tie2 DESC, tie3 DESC) AS r FROM {FINDINGS} f) x
  WHERE r = 1""")
def compacted_registers(spark, sf_dir):
    """Last record per finding."""
    rows = views.view(spark, sf_dir, views.findings)
    last = latest.compacted(rows, ["finding_id"], ["updated_us", "tie", "tie2", "tie3"])
    return last.select("finding_id", "asset_id", "severity", "status", "updated_us")


@query("""SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate FROM orders
  WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 365 DAY""")
def retained_evidence(spark, sf_dir):
    """Evidence records within their retention of one year."""
    rows = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return latest.retained(rows, "o_orderdate", F.expr("TIMESTAMP_NTZ '1998-01-01 00:00:00'"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate FROM orders
  WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' - INTERVAL 365 DAY""")
def retained_by_layout(spark, sf_dir):
    """The same records from a table by month, after its expired months were dropped."""
    rows = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    path, as_of = run_folder(spark, "evidence"), F.expr("TIMESTAMP_NTZ '1998-01-01 00:00:00'")
    dated.write(rows, path, "o_orderdate", unit="month")
    dated.expire(spark, path, as_of, unit="month")
    return dated.retained(spark, path, "o_orderdate", as_of, unit="month")


CHANGES = views.duck(views.change_records)


@query(f"""SELECT o_custkey AS id, "offset" || '.50' AS amount, ts_ms FROM (SELECT *, row_number() OVER
  (PARTITION BY o_custkey ORDER BY ts_ms DESC, "offset" DESC) AS r FROM {CHANGES} c) x WHERE r = 1 AND op <> 'd'""")
def cdc_fold(spark, sf_dir):
    """Current rows of a table after all its changes."""
    records = views.view(spark, sf_dir, views.change_records).select("offset", "value")
    parsed = changes.change_envelope(records, "id: BIGINT, amount: STRING")
    return changes.folded(parsed, ["id"])
