"""Tables by time: pruned reads, expiry by folder, repeated batches."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tellurion.operators import latest
from tellurion.sources import dated

DAY_MS = 86_400_000
NOW = datetime(2026, 3, 20, 15, 30)


def as_of():
    return F.lit("2026-03-20 15:30:00").cast("timestamp")


def framed(spark, rows):
    return spark.createDataFrame(rows, "id LONG, at TIMESTAMP")


def ids(frame):
    return sorted(r["id"] for r in frame.collect())


@pytest.fixture
def rows():
    return [(k, NOW - timedelta(hours=7 * k)) for k in range(100)] + [(1000, None)]


@pytest.mark.parametrize("unit", ["day", "month"])
def test_retained_rows_before_and_after_expiry(spark, tmp_path, rows, unit):
    path, keep = str(tmp_path / "t"), 6 * DAY_MS
    dated.write(framed(spark, rows), path, "at", unit=unit)
    want = ids(latest.retained(framed(spark, rows), "at", as_of(), keep))
    assert want == [k for k, at in rows if at and at >= NOW - timedelta(days=6)]
    assert ids(dated.retained(spark, path, "at", as_of(), keep, unit)) == want
    dropped = dated.expire(spark, path, as_of(), keep, unit)
    first = "2026-03-14" if unit == "day" else "2026-03-01"
    assert dropped and all(start < first for start in dropped)
    assert ids(dated.retained(spark, path, "at", as_of(), keep, unit)) == want
    left = ids(spark.read.parquet(path))
    assert left == sorted(k for k, at in rows if at is None or str(at) >= first)
    assert dated.expire(spark, path, as_of(), keep, unit) == []


def test_only_retained_periods_are_opened(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    dated.write(framed(spark, rows), path, "at")
    kept = dated.retained(spark, path, "at", as_of(), 2 * DAY_MS)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "period" in filters and ">= 2026-03-18" in filters
    opened = {p.split("period=")[1][:10] for p in (r[0] for r in kept.select(F.input_file_name()).distinct().collect())}
    assert opened == {"2026-03-18", "2026-03-19", "2026-03-20"}


def test_batches_add_and_repeat(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for batch, part in ((0, rows[:60]), (1, rows[50:]), (0, rows[:60])):
        dated.write(framed(spark, part), path, "at", batch)
    assert ids(spark.read.parquet(path)) == sorted(k for k, _ in rows[:60] + rows[50:])
    assert any("batch=1" in d for _, ds, _ in os.walk(path) for d in ds)


def test_names_of_the_layout_are_refused(spark, tmp_path, rows):
    with pytest.raises(ValueError, match="period"):
        dated.write(framed(spark, rows).withColumn("period", F.lit(1)), str(tmp_path / "t"), "at")
