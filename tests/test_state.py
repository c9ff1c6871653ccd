"""Normalisation, latest state, blocks and streams."""

import datetime
import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tellurion.operators import blocks, deadletters, ingest, latest, normalise
from tellurion.sources import changes, sinks
from tellurion.streaming import jobs


def normalised(spark, *records):
    frame = spark.createDataFrame(records, "source_topic STRING, raw_json STRING")
    return normalise.normalised(frame)


def test_normalised_rows(spark):
    raw = (
        '{"payload_b64":"AQI=","retain":"yes","device_id":"buoy-77","qos":2.9,'
        '"mqtt_topic":"sea/devices/buoy-12/gnss/position","timestamp":"2031-07-15T06:30:00+02:00","depth":4}'
    )
    rows = normalised(spark, ("raw.media", raw), ("raw.gps", '{"a":'), ("raw.gps", '"text"'), ("raw.gps", None)).collect()
    assert [tuple(r) for r in rows] == [
        ("buoy-77", "2031-07-15T06:30:00+02:00", "raw.media", "sea/devices/buoy-12/gnss/position", "gps", "AQI=", 2, True, raw)
    ]
    events = normalised(spark, ("raw.media", raw))
    text = events.select(normalise.as_text(events)).collect()[0][0]
    assert json.loads(text) == {c: rows[0][c] for c in normalise.COLUMNS} and list(json.loads(text)) == list(normalise.COLUMNS)


@pytest.mark.parametrize(
    ("levels", "kind"),
    [
        ("gnss", "gps"), ("volumetric-video", "video3d"), ("camera-stream", "video2d"), ("pointcloud", "image3d"),
        ("image", "image2d"), ("salinity", "unknown"),
    ],
)
def test_event_kinds(spark, levels, kind):
    row = normalised(spark, ("somewhere", json.dumps({"mqtt_topic": f"sea/devices/buoy-3/{levels}/x1"}))).collect()[0]
    assert (row["event_kind"], row["entity_id"]) == (kind, "buoy-3")


def arrivals(n, seed):
    """Arrivals in which one entity holds a third of all rows."""
    dice = random.Random(seed)
    return [
        ("hot" if dice.random() < 0.34 else f"e{dice.randrange(9)}", f"t{dice.randrange(40):03d}", i)
        for i in range(n)
    ]


def accepted_by_hand(rows):
    best, kept = {}, []
    for entity, ts, seq in sorted(rows, key=lambda r: r[2]):
        if entity not in best or ts >= best[entity]:
            best[entity] = ts
            kept.append((entity, ts, seq))
    return sorted(kept)


SCHEMA = "entity_id STRING, event_ts STRING, arrival_seq BIGINT"


@pytest.mark.parametrize("block_rows", [1, 7, 50, 10_000])
def test_acceptance_is_the_same_for_all_block_sizes(spark, block_rows):
    rows = arrivals(400, 3)
    frame = spark.createDataFrame(rows, SCHEMA)
    kept = latest.accepted(frame, block_rows=block_rows).select("entity_id", "event_ts", "arrival_seq")
    assert sorted(map(tuple, kept.collect())) == accepted_by_hand(rows)
    last = {e: (t, s) for e, t, s in sorted(accepted_by_hand(rows), key=lambda r: r[2])}
    state = latest.latest_state(frame).collect()
    assert {r["entity_id"]: (r["event_ts"], r["arrival_seq"]) for r in state} == last


def test_lookback_copies_rows_into_every_block_that_needs_them(spark):
    frame = spark.createDataFrame([("a", i) for i in (0, 9, 10, 19, 20, 35)], "k STRING, p BIGINT")
    spread, keys, own = blocks.lookback(frame, ["k"], "p", 5, blocks_per_span=2)
    assert sorted((r["p"], r["_block"]) for r in spread.collect()) == [
        (0, 0), (9, 0), (9, 1), (10, 1), (19, 1), (19, 2), (20, 2), (35, 3), (35, 4),
    ]
    assert sorted(r["p"] for r in spread.filter(own).collect()) == [0, 9, 10, 19, 20, 35]


def parts(spark, tmp_path, rows, n):
    """Rows as n files that a stream reads one by one."""
    folder = tmp_path / uuid.uuid4().hex
    for i in range(n):
        chunk = rows[i * len(rows) // n : (i + 1) * len(rows) // n]
        spark.createDataFrame(chunk, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


def test_streams_agree_with_tables_and_survive_a_restart(spark, tmp_path):
    rows = arrivals(240, 5)
    folder = parts(spark, tmp_path, rows, 3)

    def source():
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)

    def run():
        jobs.accepted_by_batch(source(), f"{tmp_path}/a", f"{tmp_path}/ca", once=True).awaitTermination()
        jobs.accepted_by_batch(
            source(), f"{tmp_path}/b", f"{tmp_path}/cb", once=True, block_rows=16
        ).awaitTermination()

    run()
    more = [("hot", "t000", 1000), ("hot", "t999", 1001), ("new", "t001", 1002)]
    spark.createDataFrame(more, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    run()
    want = accepted_by_hand(rows + more)
    for path in (f"{tmp_path}/a/accepted", f"{tmp_path}/b/accepted"):
        got = spark.read.parquet(path).select("entity_id", "event_ts", "arrival_seq").collect()
        assert sorted(map(tuple, got)) == want


def test_late_dead_letters_are_counted(spark, tmp_path):
    schema = "topic STRING, payload BINARY, qos INT, retain BOOLEAN, ingested_at STRING, arrived_at TIMESTAMP"
    folder, days = str(tmp_path / "in"), (["2026-01-09", "2026-01-10"], ["2026-01-07", "2026-01-10"], ["2026-01-07"])

    def row(day):
        at = datetime.datetime.fromisoformat(f"{day}T12:00:00")
        return ("tenant/devices/cam-1/video2d", b'{"frame":12}', 1, False, f"{day}T12:00:00+00:00", at)

    for own in days:
        spark.createDataFrame([row(d) for d in own], schema).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        jobs.updated(jobs.dead_letter_windows(source), f"{tmp_path}/d", f"{tmp_path}/cd", once=True).awaitTermination()
    counts = jobs.current(spark.read.parquet(f"{tmp_path}/d"), ["window_start", "category"])
    events = ingest.ingested(spark.read.schema(schema).parquet(folder)).filter(F.size("errors") > 0)
    want = sorted(map(tuple, deadletters.category_counts(events, "arrived_at").collect()))
    assert sorted(map(tuple, counts.select("window_start", "category", "n").collect())) == want
    frames = sorted((str(start)[:10], n) for start, category, n in want if category.startswith("field not allowed"))
    assert frames == [("2026-01-07", 2), ("2026-01-09", 1), ("2026-01-10", 2)]


def test_changes_fold_and_fan_out(spark, tmp_path):
    records = [
        (0, '{"op":"c","before":null,"after":{"id":1,"a":"x"},"ts_ms":1}'),
        (1, '{"op":"u","before":null,"after":{"id":1,"a":"y"},"ts_ms":2}'),
        (2, '{"op":"c","before":null,"after":{"id":2,"a":"z"},"ts_ms":2}'),
        (3, '{"op":"d","before":{"id":2,"a":"z"},"after":null,"ts_ms":2}'),
    ]
    parsed = changes.change_envelope(
        spark.createDataFrame(records, "offset BIGINT, value STRING"), "id: BIGINT, a: STRING"
    )
    assert [tuple(r) for r in changes.folded(parsed, ["id"]).collect()] == [(1, "y", 2)]
    out = spark.createDataFrame([("raw.gps", "k", "1"), ("dlq.events", "k", "2")], "topic STRING, key STRING, value STRING")
    for _ in range(2):
        sinks.write_by_topic(out, str(tmp_path / "fan"), 7)
    back = spark.read.parquet(str(tmp_path / "fan" / "batch_id=7"))
    assert sorted((r["topic"], r["value"]) for r in back.collect()) == [("dlq.events", "2"), ("raw.gps", "1")]


def test_retention(spark):
    frame = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2023-06-01 00:00:00'), (TIMESTAMP '2023-05-31 00:00:00') AS t(at)")
    kept = latest.retained(frame, "at", F.lit("2024-05-31 00:00:00").cast("timestamp"))
    assert [str(r["at"]) for r in kept.collect()] == ["2023-06-01 00:00:00"]
