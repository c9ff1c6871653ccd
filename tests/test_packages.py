"""Packages: bounded containers, offsets, read-back of single members."""

import hashlib
import random
import re

import pytest

from tellurion.sources import packages


def framed(spark, rows):
    return spark.createDataFrame(rows, "request_id LONG, file_name STRING, content STRING, other STRING")


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    dice = random.Random(5)
    letters = "aé語🦭\n"
    rows = [
        (dice.randrange(40), f"d-{dice.randrange(9)}.xml", "".join(dice.choices(letters, k=dice.randrange(120))), "x")
        for _ in range(300)
    ]
    rows += [(7, "same.xml", "request seven", "x"), (8, "same.xml", "request eight", "x")]
    rows += [(1, "empty", "", "x"), (2, "none", None, "x"), (None, "no request", "n", "x"), (3, None, "no name", "x")]
    rows += [(9, "long", "ß" * 5000, "x")] + [(5, "copy", "again", str(k)) for k in range(400)]
    path = str(tmp_path_factory.mktemp("package"))
    packages.write(framed(spark, rows), path, container_bytes=1000)
    return path, {(r, n, c or "") for r, n, c, _ in rows}


def test_every_member_comes_back_once(spark, written):
    path, want = written
    rows = packages.read(spark, path).collect()
    assert len(rows) == len(want)
    assert {(r["request_id"], r["file_name"], r["content"]) for r in rows} == want
    assert all(r["sha256"] == hashlib.sha256(r["content"].encode()).hexdigest() for r in rows)


def test_containers_are_bounded_and_gapless(spark, written):
    path, want = written
    longest = max(len(c.encode()) for *_, c in want)
    held = spark.read.parquet(f"{path}/containers").collect()
    assert len(held) > 10 and all(len(r["data"]) <= 1000 + longest for r in held)
    for row in held:
        at = 0
        for member in row["members"]:
            assert member["at"] == at
            at += member["size"]
        assert at == len(row["data"])


def test_wanted_members(spark, written):
    path, want = written
    keys = [(7, "same.xml"), (None, "no request"), (3, None), (9, "long"), (1, "not there")]
    wanted = spark.createDataFrame(keys + keys[:1], "request_id LONG, file_name STRING")
    got = {tuple(r) for r in packages.read(spark, path, wanted).select(*packages.KEYS, "content").collect()}
    assert got == {m for m in want if m[:2] in keys}


def test_one_member_by_pruned_scans(spark, written):
    path, _ = written
    found = packages.read_one(spark, path, {"request_id": 8, "file_name": "same.xml"})
    assert [r["content"] for r in found.collect()] == ["request eight"]
    plan = found._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan and "EqualNullSafe(request_id,8)" in plan
    assert packages.read_one(spark, path, {"request_id": 8, "file_name": "gone"}).collect() == []


def test_a_repeated_write_leaves_the_same_places(spark, tmp_path):
    rows = [(k % 7, f"f{k}", "t" * (k % 50), "x") for k in range(200)]
    for name, order in (("a", rows), ("b", rows[::-1])):
        packages.write(framed(spark, order).repartition(5), str(tmp_path / name), container_bytes=500)
    a, b = ({tuple(r) for r in packages.index(spark, str(tmp_path / n)).collect()} for n in "ab")
    assert a == b and len(a) == 200


def test_an_empty_package(spark, tmp_path):
    packages.write(framed(spark, []), str(tmp_path / "none"))
    assert packages.read(spark, str(tmp_path / "none")).count() == 0
    assert packages.index(spark, str(tmp_path / "none")).count() == 0


def test_two_exchanges(spark):
    packed = packages.containers(framed(spark, [(1, "a", "b", "x")]))
    plan = packed._jdf.queryExecution().executedPlan().toString()
    # Equal members are combined before the first; the second is by shard.
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_container_is_not_copied_for_each_member(spark, written):
    plan = packages.read(spark, written[0])._jdf.queryExecution().optimizedPlan().toString()
    # A column that a member cuts itself is copied whole for each.
    assert "substring(lambda" in plan and "substring(data#" not in plan


def test_a_row_group_holds_one_full_container(spark, tmp_path):
    pq = pytest.importorskip("pyarrow.parquet")
    # Content that compresses to nothing: a bound in compressed bytes would take it all for one group.
    texts = spark.range(64).selectExpr("id AS request_id", "'f' AS file_name", "repeat(char(97 + id % 26), 1 << 20) AS content")
    hashed = spark.conf.get("spark.sql.execution.useObjectHashAggregateExec")
    packages.write(texts, str(tmp_path / "p"))
    assert spark.conf.get("spark.sql.execution.useObjectHashAggregateExec") == hashed
    groups = []
    for file in (tmp_path / "p" / "containers").glob("*.parquet"):
        held = pq.ParquetFile(file).metadata
        groups += [held.row_group(k) for k in range(held.num_row_groups)]
    assert len(groups) >= 4 and all(g.num_rows == 1 for g in groups)
    data = [g.column(c) for g in groups for c in range(g.num_columns) if g.column(c).path_in_schema == "data"]
    assert len(data) == len(groups) and not any(c.is_stats_set for c in data)
    got = packages.read(spark, str(tmp_path / "p")).selectExpr("length(content) AS n", "request_id").collect()
    assert sorted(r["request_id"] for r in got) == list(range(64)) and {r["n"] for r in got} == {1 << 20}


def test_few_containers_are_read_by_a_task(spark, written):
    path, _ = written
    n = spark.read.parquet(f"{path}/containers").count()
    plan = packages.read(spark, path)._jdf.queryExecution().executedPlan().toString()
    # Of the places and of the containers, into as many tasks as these need, whatever the session's number.
    tasks = [int(k) for k in re.findall(r"Exchange hashpartitioning\(container#\d+L, (\d+)\)", plan)]
    assert tasks == [-(-n // 4)] * 2 and tasks[0] > 2 and tasks[0] != int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_containers_are_collected_along_a_sort(spark, tmp_path, monkeypatch):
    plans = []
    whole = packages.containers

    class Planned:
        """Notes the plan that the session makes at the time of the write."""

        def __init__(self, frame):
            self.frame = frame

        @property
        def write(self):
            again = self.frame.select("*")
            plans.append(again._jdf.queryExecution().executedPlan().toString())
            return again.write

    monkeypatch.setattr(packages, "containers", lambda *a: Planned(whole(*a)))
    packages.write(framed(spark, [(1, "a", "b", "x"), (2, "c", "d", "x")]), str(tmp_path / "p"))
    assert len(plans) == 1 and "SortAggregate" in plans[0] and "ObjectHashAggregate" not in plans[0]
    assert packages.read(spark, str(tmp_path / "p")).count() == 2
