"""Backfill windows and records, metric queries."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tellurion.functions import clock, objects
from tellurion.operators import backfill, metrics
from tellurion.plans.panels import PANELS, Panels
from tellurion.sources import listings


def test_windows():
    start, end = clock.window_bounds("2026-01-01T00:00:00Z", "2026-01-01T02:00:00+01:00")
    assert (start, end) == (datetime(2026, 1, 1, 0, tzinfo=UTC), datetime(2026, 1, 1, 1, tzinfo=UTC))
    last = clock.window_bounds(since_minutes=30, now=datetime(2026, 1, 1, 2, tzinfo=UTC))
    assert last[0] == datetime(2026, 1, 1, 1, 30, tzinfo=UTC)


@pytest.mark.parametrize(
    "arguments",
    [
        {}, {"start": "2026-01-01T00:00:00Z"}, {"since_minutes": 0}, {"since_minutes": -1},
        {"start": "2026-01-01T00:00:00Z", "end": "2026-01-01T00:00:00Z"},
    ],
)
def test_bad_windows(arguments):
    with pytest.raises(ValueError):
        clock.window_bounds(**arguments)


def test_object_names(spark):
    cases = {
        "folder/file.JPG": ("jpg", "image/jpeg"), "folder/noext": ("bin", "application/octet-stream"),
        "a.b/c": ("bin", "application/octet-stream"), ".hidden": ("bin", "application/octet-stream"),
        "x.tar.gz": ("gz", "application/x-tar"), "capture/frame.png": ("png", "image/png"),
    }
    key = F.col("k")
    rows = spark.createDataFrame([(k,) for k in cases], "k STRING").select(
        "k", objects.object_format(key), objects.content_type(key)
    )
    assert {r[0]: (r[1], r[2]) for r in rows.collect()} == cases
    names = spark.createDataFrame([("dataset/features latest",), ("//",)], "n STRING")
    safe = names.select(objects.file_safe(F.col("n"), ".zenodo-manifest.json")).collect()
    assert [r[0] for r in safe] == ["dataset-features-latest.zenodo-manifest.json", "dataset.zenodo-manifest.json"]


def test_backfill_of_a_listing(spark):
    rows = [
        ("media-raw-2d-images", "ok/a.jpg", 5, datetime(2026, 1, 1, 0, 10)),
        ("media-raw-2d-images", "skip/b.jpg", 5, datetime(2026, 1, 1, 2, 0)),
        ("media-raw-3d-videos", "c.mp4", -5, datetime(2026, 1, 1, 0, 20)),
    ]
    frame = spark.createDataFrame(rows, "bucket STRING, object_key STRING, size_bytes BIGINT, last_modified TIMESTAMP")
    start, end = clock.window_bounds("2026-01-01T00:00:00Z", "2026-01-01T01:00:00Z")
    inside = listings.as_listing(frame).filter(clock.in_window(F.col("last_modified"), start, end))
    routed = backfill.backfilled(inside, F.lit("now"))
    found = {r["key"]: r for r in routed.select("key", "topic_out", F.to_json("event").alias("e"), F.to_json("dead_letter").alias("d")).collect()}
    assert set(found) == {"ok/a.jpg", "c.mp4"}
    event = json.loads(found["ok/a.jpg"]["e"])
    assert event["object_uri"] == "s3://media-raw-2d-images/ok/a.jpg"
    assert (event["camera_id"], event["tags"]["source"]) == ("unknown", "airflow-backfill")
    letter = json.loads(found["c.mp4"]["d"])
    assert (letter["source"], letter["source_topic"]) == ("airflow-backfill", "s3://media-raw-3d-videos/c.mp4")
    counts = {r["topic"]: (r["records_sent"], r["records_invalid"]) for r in backfill.summary(routed).collect()}
    assert counts == {"raw.image2d.meta": (1, 0), "raw.video3d.meta": (0, 1)}


def test_file_listing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jpg").write_bytes(b"123")
    start, end = datetime(2000, 1, 1, tzinfo=UTC), datetime(2100, 1, 1, tzinfo=UTC)
    rows = listings.listed_objects(spark, str(tmp_path), "b", start, end, "in/").collect()
    assert [(r["object_key"], r["size_bytes"], r["object_uri"]) for r in rows] == [("in/a.jpg", 3, "s3://b/in/a.jpg")]


def samples(spark, metric, points, **labels):
    rows = [(metric, labels, float(s), v) for s, v in points]
    return spark.createDataFrame(rows, "metric STRING, labels MAP<STRING,STRING>, s DOUBLE, value DOUBLE").select(
        "metric", "labels", F.timestamp_seconds("s").alias("ts"), "value"
    )


def test_changes_count_inside_the_lookback(spark):
    points = [(i * 120, float(1 - i % 2)) for i in range(1, 7)]
    counted = {r["us"] // metrics.SECOND: r["n_changes"] for r in metrics.changes(samples(spark, "up", points, job="a")).collect()}
    # The sample 600 s before the last one is outside (t - 600, t].
    assert counted == {120: 0, 240: 1, 360: 2, 480: 3, 600: 4, 720: 4}
    dense = [(i * 100, float(1 - i % 2)) for i in range(1, 7)]
    flapping = metrics.flapping(samples(spark, "up", dense, job="a")).collect()
    assert [(r["us"] // metrics.SECOND, r["n_changes"]) for r in flapping] == [(600, 5)]


def test_rate_restarts_at_a_reset(spark):
    points = [(0, 0.0), (60, 60.0), (120, 30.0), (180, 90.0)]
    rated = metrics.rates(samples(spark, "c", points, job="a"))
    rates = {r["us"] // metrics.SECOND: round(r["rate"], 6) for r in rated.collect()}
    assert rates == {60: 1.0, 120: 0.75, 180: round(150 / 180, 6)}


def test_alert_fires_after_its_hold(spark):
    down = [(i * 15, 0.0) for i in range(9)]
    short = [(i * 15, 0.0) for i in range(8)] + [(120, 1.0)]
    both = samples(spark, "up", down, job="a").unionByName(samples(spark, "up", short, job="b"))
    for block in (None, 30 * metrics.SECOND):
        states = metrics.alert_states(both, F.col("value") == 0, metrics.TARGET_DOWN_FOR, "TargetDown", block)
        firing = states.filter("alertstate = 'firing'").collect()
        assert [(r["labels"]["job"], r["us"] // metrics.SECOND) for r in firing] == [("a", 120)]


def test_empty_selection_gives_no_row(spark):
    up = samples(spark, "up", [(0, 1.0)], job="prometheus")
    panels = Panels(up, lambda s: metrics.instant(s, 60 * metrics.SECOND))
    assert PANELS["targets_down"](panels).collect() == []
    assert [r["value"] for r in PANELS["prometheus_up"](panels).collect()] == [1.0]
    assert [r["value"] for r in PANELS["up_by_job"](panels).collect()] == [1.0]
    late = Panels(up, lambda s: metrics.instant(s, metrics.STALE_AFTER))
    assert PANELS["prometheus_up"](late).collect() == []


def test_every_panel_builds(spark):
    up = samples(spark, "up", [(0, 1.0), (15, 0.0)], job="flink", instance="i")
    alerts = metrics.alert_series(metrics.target_down(up))
    panels = Panels(up, lambda s: metrics.at_steps(s, 15 * metrics.SECOND), alerts=alerts)
    assert len(PANELS) == 39
    for build in PANELS.values():
        assert "value" in build(panels).columns
