"""Inputs of the registered queries, derived from the given tables.

Every view is one SELECT over whole tables, written once and rendered for both
Spark and the SQL that checks it, so that both start from the same rows. What
the operators compute from these rows is stated separately on each side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The few functions whose names differ between the two dialects.
SPARK = {
    "us": "unix_micros(CAST({} AS TIMESTAMP))",
    "iso": "(date_format({}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || '+00:00')",
    "div": "({} div {})",
    "bytes": "CAST({} AS BINARY)",
    "bad_bytes": "unhex('FF0088')",
    "list": "array({})",
    "plus_seconds": "timestamp_micros(unix_micros(CAST({} AS TIMESTAMP)) + CAST(1000000 AS BIGINT) * ({}))",
    "at": "TIMESTAMP '{}'",
}
DUCK = {
    "us": "epoch_us({})",
    "iso": "(strftime({}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00')",
    "div": "({} // {})",
    "bytes": "encode({})",
    "bad_bytes": "unhex('FF0088')",
    "list": "[{}]",
    "plus_seconds": "make_timestamp(epoch_us({}) + CAST(1000000 AS BIGINT) * ({}))",
    "at": "TIMESTAMP '{}'",
}


class Dialect:
    """Renders ``$name(args)`` marks in view text."""

    def __init__(self, forms: dict[str, str]):
        self.forms = forms

    def __call__(self, name: str, *args: str) -> str:
        return self.forms[name].format(*args)


def messages(d: Dialect) -> str:
    """Device messages, one per event."""
    us, iso = d("us", "ts"), d("iso", "ts")
    s, ms = d("div", us, "1000000"), d("div", us, "1000")
    cents = "CAST(round(value * 100) AS BIGINT)"
    lat = "CAST(event_id % 179 - 89 AS STRING) || '.25'"
    lon = "CAST(event_id % 359 - 179 AS STRING) || '.5'"
    text = f"""CASE event_type
      WHEN 'click' THEN CASE
        WHEN event_id % 11 = 0 THEN '{{"timestamp":"' || {iso} || '","cents":' || {cents} || '}}'
        WHEN event_id % 7 = 0 THEN '{{"timestamp":"' || {iso} || '","lat":91.5,"lon":-200.25,"speed":-3.5}}'
        WHEN event_id % 5 = 0 THEN '{{"utcTimestamp":' || {ms} || ',"latitude":null,"lat":12.5,"longitude_deg":' || {lon} || ',"heading":361}}'
        WHEN event_id % 3 = 0 THEN '{{"time":' || {s} || ',"latitude_deg":' || {lat} || ',"longitude":"east","altitude":12.25}}'
        ELSE '{{"utcTimestamp":' || {s} || ',"lat":' || {lat} || ',"lon":' || {lon} || ',"speed":1.5,"heading":' || event_id % 360 || '}}' END
      WHEN 'view' THEN CASE
        WHEN event_id % 9 = 0 THEN CAST({cents} AS STRING)
        ELSE '{{"utc_timestamp":' || {ms} || ',"cents":' || {cents} || '}}' END
      WHEN 'signup' THEN CASE
        WHEN event_id % 10 = 0 THEN '{{"timestamp":"","cents":' || {cents} || '}}'
        ELSE '{{"utcTimestamp":' || {s} || ',"accX":-0.05,"cents":' || {cents} || '}}' END
      WHEN 'purchase' THEN CASE
        WHEN event_id % 6 = 0 THEN '{{"timestamp":"' || {iso} || '","bucket":"media-raw-2d-videos","object_key":"k/' || event_id || '.mp4","object_uri":"s3://media-raw-2d-videos/k/' || event_id || '.mp4","format":"mp4","size_bytes":-' || {cents} || ',"frame_rate":0,"width":1.5}}'
        WHEN event_id % 2 = 0 THEN '{{"timestamp":"' || {iso} || '","bucket":"media-raw-2d-videos","object_key":"k/' || event_id || '.mp4","object_uri":"s3://media-raw-2d-videos/k/' || event_id || '.mp4","format":"mp4","size_bytes":' || {cents} || ',"frame_rate":25,"qos":"x"}}'
        WHEN event_id % 5 = 0 THEN '{{"frame":' || {cents} || ',"timestamp":123,"device_id":"own-' || user_id || '","retain":"no"}}'
        ELSE '{{"frame":' || {cents} || '}}' END
      ELSE CASE
        WHEN event_id % 12 = 0 THEN '{{"a":1}} x' || event_id
        WHEN event_id % 3 = 0 THEN '{{bad json' || event_id
        ELSE '[1,' || {cents} || ']' END END"""
    return f"""SELECT event_id, user_id, event_type, ts,
      CASE event_type
        WHEN 'click' THEN 'devices/dev-' || user_id || '/gnss/fix'
        WHEN 'view' THEN 'wildfi/tags/WF-' || user_id || '/environment'
        WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'wildfi/WF-' || user_id || '/imu'
          ELSE 'Wild-Fi/imu/WF-' || user_id || '/acc' END
        WHEN 'purchase' THEN 'devices/cam-' || user_id || '/video2d'
        ELSE 'orphan-' || user_id END AS topic,
      CASE WHEN event_type = 'error' AND event_id % 3 = 2 THEN {d("bad_bytes")}
        ELSE {d("bytes", text)} END AS payload,
      CAST(event_id % 3 AS INT) AS qos, event_id % 4 = 0 AS retain,
      ts AS arrived_at, event_id + (event_id % 5) * 40 AS arrival_seq,
      {iso} AS ingested_at, {cents} AS cents
      FROM events"""


def raw_records(d: Dialect) -> str:
    """Raw topic records with the odd forms that a normaliser meets."""
    iso = d("iso", "ts")
    base = f"""SELECT event_id, user_id, event_type, ts, event_id % 12 AS form, event_id % 8 AS slot,
      event_id + (event_id % 5) * 40 AS arrival_seq, {iso} AS stamp,
      CASE event_id % 8 WHEN 0 THEN 'raw.sensor' WHEN 1 THEN 'raw.gps' WHEN 2 THEN 'raw.image2d.meta'
        WHEN 3 THEN 'raw.image3d.meta' WHEN 4 THEN 'raw.video2d.meta' WHEN 5 THEN 'RAW.VIDEO3D.META'
        ELSE 'site.other' END AS source_topic,
      CASE event_type
        WHEN 'click' THEN 'devices/dev-' || user_id || '/gnss/fix'
        WHEN 'view' THEN 'wildfi/tags/WF-' || user_id || '/environment'
        WHEN 'signup' THEN 'wildfi/WF-' || user_id || '/imu'
        WHEN 'purchase' THEN 'devices/cam-' || user_id || '/video2d'
        ELSE 'orphan-' || user_id END
        || CASE WHEN event_id % 8 = 7 THEN '/pointcloud/frame' ELSE '' END AS sent_topic
      FROM events"""
    late = '"ingested_at":"2024-06-01T00:00:00+00:00"'
    return f"""SELECT event_id, user_id, event_type, form, slot, arrival_seq, source_topic, sent_topic, stamp, ts,
      CASE form
        WHEN 0 THEN '{{bad json' || event_id
        WHEN 1 THEN '[1,' || event_id || ']'
        WHEN 2 THEN '{{"device_id":null,"timestamp":"' || stamp || '","mqtt_topic":"' || sent_topic || '","qos":' || event_id % 3 || '}}'
        WHEN 3 THEN '{{"device_id":"dev-' || user_id || '","timestamp":null,{late},"mqtt_topic":"' || sent_topic || '"}}'
        WHEN 4 THEN '{{"device_id":"dev-' || user_id || '","timestamp":"",{late},"mqtt_topic":"' || sent_topic || '"}}'
        WHEN 5 THEN '{{"device_id":"dev-' || user_id || '","timestamp":"' || stamp || '","mqtt_topic":"' || sent_topic || '","qos":"1","retain":"false"}}'
        WHEN 6 THEN '{{"device_id":"dev-' || user_id || '","timestamp":"' || stamp || '","mqtt_topic":"' || sent_topic || '","qos":null,"retain":0}}'
        WHEN 7 THEN '{{"device_id":"dev-' || user_id || '"}} trailing'
        WHEN 8 THEN '{{"device_id":0,"timestamp":"' || stamp || '","mqtt_topic":"' || sent_topic || '","retain":[]}}'
        WHEN 9 THEN '{{"device_id":"","timestamp":"' || stamp || '","mqtt_topic":null,"retain":[0]}}'
        WHEN 10 THEN '{{"device_id":"dev-' || user_id || '","mqtt_topic":"' || sent_topic || '","qos":"high"}}'
        ELSE ' {{"device_id":"dev-' || user_id || '","timestamp":"' || stamp || '","mqtt_topic":"' || sent_topic || '","payload_b64":"YWJj","qos":2,"retain":true,"n":{{"deep":[1,2]}}}} ' END AS raw_json
      FROM ({base}) b"""


def samples(d: Dialect) -> str:
    """Metric samples: availability of ten jobs, a gauge and counters that reset."""
    series = "'job-' || CAST(user_id % 10 AS STRING)"
    place = "'host-' || CAST(user_id % 5 AS STRING)"
    return f"""SELECT event_id, {series} AS job, {place} AS instance, ts,
        CASE WHEN event_type = 'error' THEN 0.0 ELSE 1.0 END AS up,
        CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) AS cents,
        CAST((event_id % 500) * 10 + user_id % 7 AS DOUBLE) AS counter,
        CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id AS DOUBLE) END AS gauge
      FROM events"""


def listing(d: Dialect) -> str:
    """Object listing rows of four media buckets; some name no bucket."""
    at = d("plus_seconds", d("at", "2024-01-01 00:00:00"), "doc_id * 97")
    return f"""SELECT doc_id,
      CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 4 = 0 THEN 'media-raw-2d-images'
        WHEN doc_id % 4 = 1 THEN 'media-raw-3d-images' WHEN doc_id % 4 = 2 THEN 'media-raw-2d-videos'
        ELSE 'media-raw-3d-videos' END AS bucket,
      CASE doc_id % 4 WHEN 0 THEN 'image2d' WHEN 1 THEN 'image3d' WHEN 2 THEN 'video2d'
        ELSE 'video3d' END AS kind,
      source || '/' || CASE doc_id % 6 WHEN 0 THEN doc_id || '.JPG' WHEN 1 THEN doc_id || '.las'
        WHEN 2 THEN doc_id || '.mp4' WHEN 3 THEN doc_id || '' WHEN 4 THEN '.hidden' || doc_id
        ELSE doc_id || '.tar.gz' END AS object_key,
      CASE WHEN doc_id % 13 = 0 THEN -n_chars ELSE n_chars END AS size_bytes,
      {at} AS last_modified
      FROM documents"""


def notifications(d: Dialect) -> str:
    """Object store notifications with one or two records."""
    item = (
        "'{{\"eventTime\":\"2024-01-01T00:00:00Z\",\"eventName\":\"{name}\",\"s3\":{{\"bucket\":{{\"name\":\"' || source || '\"}},"
        "\"object\":{{\"key\":\"{key}/' || doc_id || '.png\",\"size\":' || n_chars || '}}}}}}'"
    )
    one = item.format(name="ObjectCreated:Put", key="a")
    two = item.format(name="ObjectRemoved:Delete", key="b")
    return f"""SELECT doc_id, source, n_chars,
      CASE WHEN doc_id % 3 = 0 THEN '{{"Records":[' || {one} || ',' || {two} || ']}}'
        ELSE '{{"Records":[' || {one} || ']}}' END AS value FROM documents"""


def datasets(d: Dialect) -> str:
    """Dataset catalogue, one per part."""
    return f"""SELECT 'ds-' || p_partkey AS dataset_id, p_name AS title,
      CASE p_partkey % 5 WHEN 0 THEN 'raw' WHEN 1 THEN 'derived' WHEN 2 THEN 'aggregate'
        WHEN 3 THEN 'metadata' ELSE 'research_release' END AS dataset_type,
      CASE p_partkey % 6 WHEN 0 THEN 'public' WHEN 1 THEN 'internal' WHEN 2 THEN 'restricted'
        WHEN 3 THEN 'personal' WHEN 4 THEN 'sensitive' ELSE 'mixed' END AS classification,
      CASE p_size % 4 WHEN 0 THEN 'open' WHEN 1 THEN 'mediated' WHEN 2 THEN 'restricted'
        ELSE 'embargoed' END AS access_mode,
      CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE 'dmp-' || p_partkey % 120 END AS dmp_id,
      {d("list", "'prod-' || p_partkey % 40, 'prod-' || (p_partkey % 7 + 50)")} AS data_products,
      {d("list", "'raw.sensor', 'raw.gps'")} AS source_topics, p_partkey
      FROM part"""


def data_plans(d: Dialect) -> str:
    return """SELECT 'dmp-' || s_suppkey AS dmp_id,
      CASE s_suppkey % 5 WHEN 0 THEN 'approved' WHEN 1 THEN 'active' WHEN 2 THEN 'draft'
        WHEN 3 THEN 'needs_review' ELSE 'retired' END AS status FROM supplier"""


def export_requests(d: Dialect) -> str:
    """Export requests, one per order; one in ten names an unknown dataset."""
    named = "{'name': 'Author ' || o_custkey, 'affiliation': 'Lab'}"
    nobody = "{'name': '', 'affiliation': 'Lab'}"
    if d.forms is SPARK:
        named = "named_struct('name', 'Author ' || o_custkey, 'affiliation', 'Lab')"
        nobody = "named_struct('name', '', 'affiliation', 'Lab')"
    return f"""SELECT o_orderkey AS request_id,
      CASE WHEN o_orderkey % 10 = 0 THEN 'ds-unknown-' || o_custkey WHEN o_orderkey % 101 = 1 THEN ' '
        ELSE 'ds-' || o_custkey END AS dataset_id,
      CASE o_orderkey % 7 WHEN 0 THEN 'open' WHEN 1 THEN 'closed' WHEN 2 THEN 'embargoed'
        WHEN 3 THEN 'restricted' WHEN 4 THEN 'secret' ELSE NULL END AS access_right,
      o_orderstatus = 'F' AS publish,
      CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 4 = 1 END AS legal_review_approved,
      CASE o_orderkey % 5 WHEN 0 THEN ' https://doi.org/10.5072/' || o_orderkey WHEN 1 THEN '10.5072/' || o_orderkey
        WHEN 2 THEN ' ' ELSE NULL END AS doi,
      CASE o_orderkey % 3 WHEN 0 THEN 'https://data.example.org/' || o_orderkey
        WHEN 1 THEN 'http://data.example.org/' || o_orderkey ELSE NULL END AS landing_page_url,
      CASE WHEN o_orderkey % 2 = 0 THEN 'Title ' || o_orderkey ELSE '' END AS title,
      CASE o_orderkey % 4 WHEN 0 THEN '2021' WHEN 1 THEN '21' WHEN 2 THEN '20211' ELSE NULL END AS publication_year,
      CASE WHEN o_orderkey % 3 = 0 THEN {d("list", named + ", " + nobody)} ELSE {d("list", nobody)} END AS creators
      FROM orders"""


def findings(d: Dialect) -> str:
    """Vulnerability findings, one record per line item; a finding may have several records."""
    return f"""SELECT 'f-' || l_orderkey || '-' || l_linenumber AS finding_id, 'asset-' || l_suppkey AS asset_id,
      CASE CAST(l_quantity AS INT) % 4 WHEN 0 THEN 'critical' WHEN 1 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS severity,
      CASE l_partkey % 5 WHEN 0 THEN 'open' WHEN 1 THEN 'patched' WHEN 2 THEN 'open' WHEN 3 THEN 'accepted_risk'
        ELSE 'false_positive' END AS status,
      'owner-' || l_suppkey % 8 AS owner,
      {d("us", "l_shipdate")} AS updated_us, l_partkey AS tie, l_suppkey AS tie2, l_extendedprice AS tie3,
      {d("plus_seconds", "l_shipdate", "86400 * 30 * l_linenumber")} AS due_at
      FROM lineitem"""


def permissions(d: Dialect) -> str:
    """Permission events per subject and product, one per order."""
    return f"""SELECT o_orderkey AS permission_id, 'c-' || o_custkey AS subject_id, 'p-' || o_orderkey % 5 AS product_id,
      CASE o_orderkey % 6 WHEN 0 THEN 'withdrawn' WHEN 1 THEN 'expired' WHEN 2 THEN 'updated' ELSE 'granted' END AS event_type,
      {d("plus_seconds", "o_orderdate", "o_orderkey % 86400")} AS occurred_at
      FROM orders"""


def access_requests(d: Dialect) -> str:
    """Access requests, one per line item."""
    return f"""SELECT l_orderkey * 10 + l_linenumber AS request_id, 'c-' || l_partkey AS subject_id,
      'p-' || l_suppkey % 5 AS product_id,
      {d("plus_seconds", "l_shipdate", "l_linenumber * 3600")} AS requested_at,
      l_extendedprice AS price
      FROM lineitem"""


def assessments(d: Dialect) -> str:
    """Control assessments, one record per line item."""
    return f"""SELECT CASE l_suppkey % 6 WHEN 0 THEN 'NIS2' WHEN 1 THEN 'DORA' WHEN 2 THEN 'CRA'
        WHEN 3 THEN 'GDPR' WHEN 4 THEN 'DGA' ELSE 'Data Act' END AS regulation,
      'ctl-' || l_partkey % 200 AS control_id,
      CASE l_linenumber % 4 WHEN 0 THEN 'implemented' WHEN 1 THEN 'partial' WHEN 2 THEN 'todo' ELSE 'blocked' END AS status,
      {d("us", "l_shipdate")} AS assessed_us, l_orderkey * 10 + l_linenumber AS seq, l_extendedprice AS price
      FROM lineitem"""


def evidence_texts(d: Dialect) -> str:
    """Evidence records of four topics as texts, some of which break their contract."""
    us = d("us", "o_orderdate")
    stamp = "'2024-01-01T00:00:00Z'"
    return f"""SELECT o_orderkey AS record_id,
      CASE o_orderkey % 5 WHEN 0 THEN 'security.vulnerability.findings' WHEN 1 THEN 'dataact.user.exports'
        WHEN 2 THEN 'resilience.backup.tests' WHEN 3 THEN 'governance.access.requests'
        ELSE 'site.unlisted' END AS topic,
      CASE o_orderkey % 5
        WHEN 0 THEN CASE WHEN o_orderkey % 3 = 0
          THEN '{{"finding_id":"f","asset_id":"a","source":"s","severity":"severe","status":"open","detected_at":"yesterday","note":1}}'
          ELSE '{{"finding_id":"f","asset_id":"a","source":"s","severity":"high","status":"open","detected_at":"2024-01-01T00:00:00Z"}}' END
        WHEN 1 THEN CASE WHEN o_orderkey % 2 = 0
          THEN '{{"export_id":7,"user_id":"u","data_product_id":"p","format":"json","delivery_channel":"api","created_at":"2024-01-01T00:00:00+00:00","status":"created","record_count":-' || (o_custkey + 1) || '}}'
          ELSE '{{"export_id":"e","request_id":"r","user_id":"u","data_product_id":"p","format":"json","delivery_channel":"pigeon","created_at":"2024-01-01T00:00:00.5Z","status":"created","size_bytes":1.0}}' END
        WHEN 2 THEN CASE WHEN o_orderkey % 7 = 0 THEN '{{broken'
          ELSE '{{"test_id":"t","system":"s","tested_at":"2024-13-01T00:00:00Z","result":"passed","rpo_minutes":1.5,"rto_minutes":' || o_custkey || ',"findings":["x",1]}}' END
        WHEN 3 THEN '{{"request_id":"r","product_id":"p","requester_id":null,"requester_type":"researcher","declared_purpose":"x","requested_at":"2024-01-01T00:00:00Z","status":"approved","requested_fields":[]}}'
        ELSE '{{"anything":true}}' END AS value
      FROM orders"""


def change_records(d: Dialect) -> str:
    """Change records of a customer table, one per order, as texts."""
    us = d("us", "o_orderdate")
    row = "'{{\"id\":' || o_custkey || ',\"amount\":\"' || o_orderkey || '.50\"}}'".replace("{{", "{").replace("}}", "}")
    return f"""SELECT o_orderkey AS offset, o_custkey, {d("div", us, "1000")} AS ts_ms,
      CASE WHEN o_orderkey % 7 = 0 THEN 'd' WHEN o_orderkey % 7 = 1 THEN 'c' ELSE 'u' END AS op,
      CASE WHEN o_orderkey % 7 = 0 THEN '{{"op":"d","before":' || {row} || ',"after":null,"ts_ms":' || {d("div", us, "1000")} || '}}'
        ELSE '{{"op":"' || CASE WHEN o_orderkey % 7 = 1 THEN 'c' ELSE 'u' END || '","before":null,"after":' || {row} || ',"ts_ms":' || {d("div", us, "1000")} || '}}' END AS value
      FROM orders"""


TABLES_OF = {
    messages: "events", raw_records: "events", samples: "events", listing: "documents",
    notifications: "documents", datasets: "part", data_plans: "supplier",
    export_requests: "orders", findings: "lineitem", permissions: "orders",
    access_requests: "lineitem", assessments: "lineitem", evidence_texts: "orders",
    change_records: "orders",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files."""
    schema = table(spark, sf_dir, name).schema
    # As a pattern the path may be one file as well as a folder of files.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}[.]parquet")


#: Views of texts that are parsed at tens of microseconds a row.
COSTLY = (messages, evidence_texts)


def dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt evenly over the session's number of shuffle partitions.

    A file is read by as many tasks as it has row groups at most, and a row group
    of a million short rows is minutes of parsing for one task.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def view(spark: SparkSession, sf_dir: str, of, streaming: bool = False) -> DataFrame:
    """A view as a DataFrame; costly ones are dealt over tasks before their texts are made."""
    source = TABLES_OF[of]
    text = of(Dialect(SPARK)).replace(f"FROM {source}", "FROM {source}")
    # Braces of JSON literals are doubled for the formatter, the table is not.
    text = text.replace("{", "{{").replace("}", "}}").replace("{{source}}", "{source}")
    rows = (stream if streaming else table)(spark, sf_dir, source)
    if of in COSTLY and not streaming:
        rows = dealt(rows)
    return spark.sql(text, source=rows)


def duck(of) -> str:
    """A view as a subquery of the checking SQL."""
    return f"({of(Dialect(DUCK))})"
