"""Prefix scans read their input once; keyed tables fold; one job feeds features and state."""

import json
import math
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tellurion.operators import blocks, governance, latest, metrics, normalise
from tellurion.streaming import jobs
from tellurion.streaming.keyed import KeyedTable


@pytest.fixture
def plans(spark):
    """Plans with the reuse of exchanges resolved before they run."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def stored(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
    return spark.read.schema(schema).parquet(f"{tmp_path}/{name}")


@pytest.mark.parametrize("unit", [1, 1_000_000])
def test_cuts_bound_rows_whatever_the_unit(spark, unit):
    dice = random.Random(unit)
    places = sorted(dice.choices(range(10**6), k=5000))
    rows = spark.createDataFrame([(p * unit,) for p in places], "p long")
    at = blocks.cuts(rows, "p", 300)
    sizes = rows.groupBy(blocks.block_of(F.col("p"), at).alias("b")).agg(F.count("*").alias("n"), F.min("p").alias("p")).orderBy("p").collect()
    assert [r.b for r in sizes] == list(range(len(at) + 1)) and len(at) == 16
    assert max(r.n for r in sizes) <= 320
    assert blocks.cuts(rows, "p", 5000) == []


@pytest.mark.parametrize("n", [1, 2, 7, 8, 1000])
def test_blocks_are_found_by_halving(spark, plans, n):
    at = [3 * k for k in range(n)]
    values = [*range(-2, 3 * n + 2), None]
    rows = spark.createDataFrame([(v,) for v in values], "p long")
    placed = rows.select("p", blocks.block_of(F.col("p"), at).alias("b"))
    assert {r.p: r.b for r in placed.collect()} == {v: 0 if v is None else sum(a <= v for a in at) for v in values}
    # Not one step per cut, however they are grouped.
    assert "filter(" not in plans(placed)


@pytest.mark.parametrize("block_rows", [1000, 40])
def test_scans_read_their_input_once(spark, tmp_path, plans, block_rows):
    dice = random.Random(2)
    events = stored(
        spark, tmp_path, "e", [(f"e{dice.randrange(3)}", f"t{dice.randrange(50)}", i, "x" * 9, {"k": "v"}) for i in range(300)],
        "entity_id string, event_ts string, arrival_seq long, raw_json string, labels map<string,string>",
    )
    plan = plans(latest.with_acceptance(events, block_rows=block_rows))
    assert plan.count("FileScan") == 1 and ("ReusedExchange" in plan) == (block_rows == 40)

    p = stored(spark, tmp_path, "p", [(i, "s", i * 10, "granted") for i in range(100)], "permission_id int, subject string, s int, event_type string")
    r = stored(spark, tmp_path, "r", [(i, "s", i * 7) for i in range(100)], "request_id int, subject string, s int")
    asked = governance.permitted_at_request(
        r.withColumn("requested_at", F.timestamp_seconds("s")), p.withColumn("occurred_at", F.timestamp_seconds("s")),
        ["subject"], block_rows=block_rows,
    )
    plan = plans(asked)
    assert plan.count("FileScan") == 2 and ("ReusedExchange" in plan) == (block_rows == 40)

    samples = stored(
        spark, tmp_path, "m", [("up", {"job": f"j{i % 2}"}, i * metrics.SECOND, float(i % 5 > 0)) for i in range(200)],
        "metric string, labels map<string,string>, us long, value double",
    ).withColumn("ts", F.timestamp_micros("us")).drop("us")
    plan = plans(metrics.alert_states(samples, F.col("value") == 0, metrics.SECOND, "A", block_rows=block_rows))
    assert plan.count("FileScan") == 1 and ("ReusedExchange" in plan) == (block_rows == 40)


@pytest.mark.parametrize("block_rows", [1000, 40, 10])
def test_only_long_histories_are_cut(spark, tmp_path, plans, block_rows):
    dice = random.Random(4)
    names = ["long"] * 200 + [f"s{i % 60}" for i in range(300)] + [None] * 5
    rows = [(i, s, dice.randrange(90), dice.choice(["granted", "withdrawn"])) for i, s in enumerate(names)]
    p = stored(spark, tmp_path, "p", rows, "permission_id int, subject string, s int, event_type string")
    r = stored(spark, tmp_path, "r", [(i, s, dice.randrange(90)) for i, s in enumerate(names)], "request_id int, subject string, s int")
    asked = governance.permitted_at_request(
        r.withColumn("requested_at", F.timestamp_seconds("s")), p.withColumn("occurred_at", F.timestamp_seconds("s")),
        ["subject"], block_rows=block_rows,
    )
    want = {}
    for x in r.collect():
        earlier = [(s, i) for i, name, s, _ in rows if name == x.subject and s <= x.s]
        want[x.request_id] = max(earlier, default=(0, None))[1]
    assert {x.request_id: x.permission_id for x in asked.collect()} == want
    assert ("ReusedExchange" in plans(asked)) == (block_rows < 1000)
    if block_rows == 1000:
        assert blocks.in_long_groups(p, ["subject"], block_rows) is None
    else:
        assert set(names) - {None} >= {x.subject for x in p.where(blocks.in_long_groups(p, ["subject"], block_rows)).collect()} >= {"long"}


def test_many_short_histories_are_not_cut(spark, tmp_path, plans):
    p = stored(spark, tmp_path, "p", [(i, f"s{i % 40}", i, "granted") for i in range(200)], "permission_id int, subject string, s int, event_type string")
    r = stored(spark, tmp_path, "r", [(i, f"s{i % 40}", i) for i in range(200)], "request_id int, subject string, s int")
    asked = governance.permitted_at_request(
        r.withColumn("requested_at", F.timestamp_seconds("s")), p.withColumn("occurred_at", F.timestamp_seconds("s")),
        ["subject"], block_rows=100,
    )
    assert plans(asked).count("Exchange") == 1


def states_by_hand(points, hold, stale):
    found, since, before = {}, None, None
    for t, down in points:
        if before is None or not before[1] or t - before[0] > stale:
            since = t
        if down:
            found[t] = (since, "firing" if t - since >= hold else "pending")
        before = (t, down)
    return found


@pytest.mark.parametrize("block_rows", [1, 2, 7, 10_000])
def test_alert_states_are_those_of_a_walk(spark, block_rows):
    dice, rows, want = random.Random(9), [], {}
    for name, share in (("a", 0.9), ("b", 0.5), ("c", 1.0), ("hot", 0.8)):
        t, points = 0, []
        for _ in range(200 if name == "hot" else 40):
            t += dice.choice([1, 1, 2, 9])
            points.append((t, dice.random() < share))
        rows += [("up", {"job": name}, t, 0.0 if down else 1.0) for t, down in points]
        want[name] = states_by_hand(points, 4, 5)
    frame = spark.createDataFrame(rows, "metric string, labels map<string,string>, t long, value double")
    samples = frame.select("metric", "labels", F.timestamp_micros(F.col("t") * metrics.SECOND).alias("ts"), "value")
    got = metrics.alert_states(
        samples, F.col("value") == 0, 4 * metrics.SECOND, "A", stale_after=5 * metrics.SECOND, block_rows=block_rows
    ).collect()
    found = {name: {} for name in want}
    for r in got:
        found[r.labels["job"]][r.us // metrics.SECOND] = (r.held_since_us // metrics.SECOND, r.alertstate)
    assert found == want


def size(path):
    return sum(1 for f in Path(path).rglob("*.parquet")), sum(1 for f in Path(path).rglob("run=*"))


def test_a_keyed_table_is_bounded_by_its_live_keys(spark, tmp_path):
    schema = "k string, op string, ts_ms long"
    table = KeyedTable(
        spark, str(tmp_path / "t"), schema, ["k"], ["ts_ms"], buckets=4, removed=F.col("op") == "d", clock="ts_ms", keep=50
    )
    dice, want = random.Random(4), {}
    for batch_id in range(8):
        rows = [(f"k{dice.randrange(12)}", dice.choice("uud"), batch_id * 100 + i) for i in range(15)]
        frame = spark.createDataFrame(rows, schema)
        for _ in range(2 if batch_id in (3, 7) else 1):  # repeated batches
            table.fold(frame, batch_id)
        for k, op, ts in rows:
            want[k] = max(want.get(k, (0, "")), (ts, op))
        newest = max(ts for _, _, ts in rows)
        live = {k: v for k, v in want.items() if v[1] != "d"}
        held = {r.k: (r.ts_ms, r.op) for r in table.rows().collect()}
        assert {k: v for k, v in held.items() if v[1] != "d"} == live
        assert all(ts >= newest - 150 for ts, op in held.values() if op == "d")
    assert size(tmp_path / "t")[0] <= 8 and len(list((tmp_path / "t/manifest").glob("*.json"))) <= 2
    table.fold(spark.createDataFrame([(f"k{i}", "d", 5000) for i in range(12)], schema), 8)
    table.fold(spark.createDataFrame([(f"k{i}", "d", 5000) for i in range(12)] + [("z", "u", 9000)], schema), 9)
    assert [r.k for r in table.rows().collect()] == ["z"]


def test_an_older_change_after_a_deletion_does_not_bring_a_row_back(spark, tmp_path):
    schema = "k string, op string, ts_ms long"
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], ["ts_ms"], removed=F.col("op") == "d", clock="ts_ms", keep=1000)
    table.fold(spark.createDataFrame([("a", "d", 500)], schema), 0)
    table.fold(spark.createDataFrame([("a", "u", 400)], schema), 1)
    assert [(r.op, r.ts_ms) for r in table.rows().collect()] == [("d", 500)]


def test_features_and_state_survive_a_failure_between_the_writes(spark, tmp_path, monkeypatch):
    dice, folder, schema = random.Random(6), str(tmp_path / "in"), "source_topic string, raw_json string, arrival_seq long"
    rows = []
    for i in range(120):
        entity = "hot" if dice.random() < 0.4 else f"d{dice.randrange(5)}"
        text = json.dumps({"device_id": entity, "timestamp": f"2030-01-{dice.randrange(10, 28)}T00:00:00+00:00"})
        rows.append(("raw.gps", text if i % 17 else "{", i))
    for k in range(3):
        spark.createDataFrame(rows[k * 40 : k * 40 + 40], schema).coalesce(1).write.mode("append").parquet(folder)

    def run():
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        jobs.features_and_state(source, f"{tmp_path}/out", f"{tmp_path}/mark", once=True, block_rows=16).awaitTermination()

    real, calls = jobs.KeyedTable.fold, []

    def dies(table, batch, batch_id):
        calls.append(batch_id)
        if len(calls) == 4:  # the second batch: features and accepted rows are written, one table is folded
            raise RuntimeError("executor of the driver gone")
        return real(table, batch, batch_id)

    monkeypatch.setattr(jobs.KeyedTable, "fold", dies)
    with pytest.raises(Exception, match="gone"):
        run()
    monkeypatch.setattr(jobs.KeyedTable, "fold", real)
    run()
    events = normalise.normalised(spark.createDataFrame(rows, schema))
    features = spark.read.parquet(f"{tmp_path}/out/features")
    assert sorted(r.arrival_seq for r in features.collect()) == sorted(r.arrival_seq for r in events.collect())
    accepted = spark.read.parquet(f"{tmp_path}/out/accepted")
    assert sorted(r.arrival_seq for r in accepted.collect()) == sorted(r.arrival_seq for r in latest.accepted(events).collect())
    state = KeyedTable(spark, f"{tmp_path}/out/state", events.schema, ["entity_id"], ["event_ts", "arrival_seq"]).rows()
    assert sorted(map(str, state.select(*events.columns).collect())) == sorted(map(str, latest.latest_state(events).select(*events.columns).collect()))
    assert {Path(p).name for p in Path(f"{tmp_path}/out/features").iterdir()} >= {"batch_id=0", "batch_id=1", "batch_id=2"}


def lookbacks_by_hand(points, span):
    """``(n_changes, increase, n, first)`` of the samples in ``(t - span, t]``."""
    found = {}
    for i, (t, _) in enumerate(points):
        first = next(k for k in range(i + 1) if points[k][0] > t - span)
        inside = list(zip(points[first : i + 1], points[first + 1 : i + 1], strict=False))
        grown = [b - a if b >= a else b for (_, a), (_, b) in inside]
        found[t] = (sum(a != b for (_, a), (_, b) in inside), sum(grown), len(inside) + 1, points[first][0])
    return found


@pytest.mark.parametrize("span", [3, 10, 1000])
def test_lookbacks_are_those_of_a_walk_without_sliding_frames(spark, plans, span):
    dice, rows, want = random.Random(span), [], {}
    for name in ("a", "b"):
        times = sorted(dice.sample(range(-300, 900), 150))
        # One infinite value must not reach the look-backs that do not hold it.
        points = [(t, math.inf if i == 70 else float(dice.randrange(4))) for i, t in enumerate(times)]
        rows += [("c", {"job": name}, t * metrics.SECOND, v) for t, v in points]
        want |= {(name, t): v for t, v in lookbacks_by_hand(points, span).items()}
    frame = spark.createDataFrame(rows, "metric string, labels map<string,string>, us long, value double")
    samples = frame.withColumn("ts", F.timestamp_micros("us")).drop("us")
    counted, rated = metrics.changes(samples, span * metrics.SECOND), metrics.rates(samples, span * metrics.SECOND)
    assert not any("RangeFrame, -" in plans(x) for x in (counted, rated))
    changes = {(r.labels["job"], r.us // metrics.SECOND): r.n_changes for r in counted.collect()}
    assert changes == {k: v[0] for k, v in want.items()}
    rates = {(r.labels["job"], r.us // metrics.SECOND): r.rate for r in rated.collect()}
    assert rates == pytest.approx({k: v[1] / (k[1] - v[3]) for k, v in want.items() if v[2] > 1})


def test_lookbacks_count_samples_of_equal_times(spark):
    points = [(0, 1.0), (4, 2.0), (4, 2.0), (9, 5.0), (9, 5.0), (12, 6.0), (13, 8.0)]
    frame = spark.createDataFrame([("c", {"job": "a"}, t * metrics.SECOND, v) for t, v in points], "metric string, labels map<string,string>, us long, value double")
    samples = frame.withColumn("ts", F.timestamp_micros("us")).drop("us")
    found = {r.us // metrics.SECOND: r.n_changes for r in metrics.changes(samples, 10 * metrics.SECOND).collect()}
    # At 13, both samples of 4 are in; only the second follows another.
    assert found == {0: 0, 4: 1, 9: 2, 12: 2, 13: 3}
