"""Trees listed by tasks, and the difference of two inventories."""

import inspect
import os
from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest

from tellurion.sources import listings

ALWAYS = datetime(2000, 1, 1, tzinfo=UTC), datetime(2100, 1, 1, tzinfo=UTC)


@pytest.fixture
def tree(tmp_path):
    """Folders of very different sizes and depths, names that need care, an empty folder."""
    names = [f"site{i}/day{j}/{k}.jpg" for i in range(12) for j in range(5) for k in range((i * j) % 7)]
    names += [f"flat/{k}.las" for k in range(300)] + ["a/b/c/d/e/f/g/deep.mp4", "top.bin"]
    names += ["odd name/50%/\u00e9 #1?.jpg", ".hidden/.x", "_under/_y", "site1x/z.jpg"]
    for name in names:
        file = tmp_path / "root" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"x" * (len(name) % 5))
    (tmp_path / "root" / "empty").mkdir()
    return tmp_path / "root", names


def test_every_file_once_with_size_and_address(spark, tree):
    root, names = tree
    rows = listings.listed_objects(spark, str(root), "b", *ALWAYS).collect()
    assert Counter(r.object_key for r in rows) == Counter(names)
    assert all(r.size_bytes == len(r.object_key) % 5 and r.object_uri == f"s3://b/{r.object_key}" for r in rows)


@pytest.mark.parametrize("prefix", ["site1", "site1/", "site1/day", "a/b/c/d/e/f/g/deep", "top", "none/x", "top.bin/x", "fl"])
def test_prefixes_are_starts_of_keys(spark, tree, prefix):
    root, names = tree
    rows = listings.listed_objects(spark, f"{root}/", "b", *ALWAYS, prefix=prefix).collect()
    assert Counter(r.object_key for r in rows) == Counter(n for n in names if n.startswith(prefix))


def test_windows_are_half_open(spark, tmp_path):
    at = datetime(2024, 3, 1, 12, tzinfo=UTC)
    for i in range(4):
        (tmp_path / str(i)).write_bytes(b"")
        when = (at + timedelta(hours=i)).timestamp()
        os.utime(tmp_path / str(i), (when, when))
    found = listings.listed_objects(spark, str(tmp_path), "b", at + timedelta(hours=1), at + timedelta(hours=3)).collect()
    assert sorted((r.object_key, r.timestamp) for r in found) == [
        ("1", "2024-03-01T13:00:00+00:00"), ("2", "2024-03-01T14:00:00+00:00"),
    ]


def test_a_root_must_exist_and_may_be_empty(spark, tmp_path):
    with pytest.raises(Exception, match="gone"):
        listings.listed_objects(spark, f"{tmp_path}/gone", "b", *ALWAYS)
    assert listings.listed_objects(spark, str(tmp_path), "b", *ALWAYS).count() == 0


def test_no_file_is_listed_by_the_driver(spark, tree):
    """Names and files stay in tasks: the plan reads the written levels, the code collects nothing."""
    plan = listings.listed_objects(spark, str(tree[0]), "b", *ALWAYS)._jdf.queryExecution().toString()
    assert "parquet" in plan and "binaryFile" not in plan
    code = inspect.getsource(listings.listed_objects)
    assert "collect(" not in code and "toPandas" not in code and "toLocalIterator" not in code


def test_difference_of_inventories(spark):
    t, u = datetime(2024, 1, 1), datetime(2024, 1, 2)
    schema = "bucket string, object_key string, size_bytes long, last_modified timestamp, extra string"
    before = [("b", "same", 1, t, "x"), ("b", "size", 1, t, "x"), ("b", "time", 1, t, "x"), ("b", "gone", 1, t, "x"),
              (None, "k", 1, t, "x"), ("b", None, None, None, "x"), ("c", "same", 5, t, "x")]
    now = [("b", "same", 1, t, "y"), ("b", "size", 2, t, "y"), ("b", "time", 1, u, "y"), ("b", "new", 1, t, "y"),
           ("b", "new", 1, t, "z"), (None, "k", 1, t, "y"), ("b", None, None, None, "y"), ("c", "same", None, t, "y")]
    changed = listings.changed_objects(spark.createDataFrame(before, schema), spark.createDataFrame(now, schema))
    assert Counter((r.bucket, r.object_key, r.size_bytes, r.change) for r in changed.collect()) == Counter(
        [("b", "size", 2, "changed"), ("b", "time", 1, "changed"), ("c", "same", None, "changed"),
         ("b", "new", 1, "added"), ("b", "gone", 1, "removed")]
    )
    assert changed.columns == ["bucket", "object_key", "size_bytes", "last_modified", "change"]
    same = spark.createDataFrame(before, schema)
    assert listings.changed_objects(same, same).count() == 0
    nothing = spark.createDataFrame([], schema)
    assert {r.change for r in listings.changed_objects(nothing, same).collect()} == {"added"}
    assert listings.changed_objects(same, nothing).where("change = 'removed'").count() == 7
