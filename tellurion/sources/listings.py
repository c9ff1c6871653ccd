"""Object listings: from a file tree, from inventories and from store notifications.

A tree is listed by tasks, one level at a time: each task opens its share of the
folders of a level and gives their files, and the folders of the next level. The
driver learns how many folders a level has, never their names or files. A task
holds the entries of one folder at a time; stores whose folders are too long for
that publish inventories, which are compared by :func:`changed_objects`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellurion.functions import clock
from tellurion.session import run_folder

NOTIFICATION_SCHEMA = (
    "Records ARRAY<STRUCT<eventVersion STRING, eventSource STRING, awsRegion STRING, "
    "eventTime STRING, eventName STRING, s3 STRUCT<bucket: STRUCT<name: STRING, arn: STRING>, "
    "object: STRUCT<key: STRING, size: BIGINT, eTag: STRING, contentType: STRING, "
    "versionId: STRING, sequencer: STRING>>>>"
)
ENTRY_SCHEMA = "key STRING, is_folder BOOLEAN, size_bytes BIGINT, last_modified TIMESTAMP"
INVENTORY_KEY = ("bucket", "object_key")
ENTRY_ROWS = 10_000
FOLDERS_PER_TASK = 16
LISTING_COLUMNS = ("bucket", "object_key", "size_bytes", "timestamp", "object_uri")


def object_uri(bucket: Column, key: Column) -> Column:
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)


def _entries(
    batches: Iterator[pa.RecordBatch], root: str, prefix: str, open_store: Callable,
) -> Iterator[pa.RecordBatch]:
    """Files and folders directly in the folders of a batch, by key below the root."""
    store, base = open_store(root)
    base = base.rstrip("/") + "/"
    types = pa.schema(
        [("key", pa.string()), ("is_folder", pa.bool_()), ("size_bytes", pa.int64()), ("last_modified", pa.timestamp("us", "UTC"))]
    )
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            named = folder != "" and prefix.startswith(folder + "/")
            if named and store.get_file_info(base + folder).type != fs.FileType.Directory:
                continue  # the prefix names no folder
            found = store.get_file_info(fs.FileSelector(base + folder, allow_not_found=folder != ""))
            rows = []
            for entry in found:
                key = entry.path[len(base):]
                inside = entry.type == fs.FileType.Directory
                # A folder may hold keys of the prefix, or lie within it.
                if not (key.startswith(prefix) or inside and prefix.startswith(key + "/")):
                    continue
                rows.append((key, inside, None if inside else entry.size, entry.mtime))
            for start in range(0, len(rows), ENTRY_ROWS):
                columns = zip(*rows[start : start + ENTRY_ROWS])
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types.types)], schema=types)


def listed_objects(
    spark: SparkSession,
    root: str,
    bucket: str,
    start: datetime,
    end: datetime,
    prefix: str = "",
    open_store: Callable = fs.FileSystem.from_uri,
) -> DataFrame:
    """Objects under ``root`` changed in a half-open window; file contents are not read.

    Keys that begin with a dot or an underscore count as any other. ``prefix`` is
    the start of a key and need not end at a folder; folders outside it are not
    opened. ``open_store`` turns the address into a file system and a path in it.
    A root that does not exist is an error, a prefix without objects gives no row.
    Links to folders are followed, so a tree must not link back into itself. A level
    is written before the next one is listed: a lost executor lists its share again.
    """
    folder = run_folder(spark, "listing")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _entries(batches, root, prefix, open_store)

    # The whole directories of the prefix need not be looked up from the root.
    inside = prefix.rpartition("/")[0]
    level, width = 0, 1
    folders = spark.createDataFrame([(inside,)], "key STRING")
    while width:
        tasks = max(1, min(width, spark.sparkContext.defaultParallelism, width // FOLDERS_PER_TASK + 1))
        entries = folders.repartition(tasks, "key").mapInArrow(listed, ENTRY_SCHEMA)
        entries.write.parquet(f"{folder}/level={level}")
        found = spark.read.schema(ENTRY_SCHEMA).parquet(f"{folder}/level={level}")
        folders = found.where("is_folder").select("key")
        level, width = level + 1, folders.count()
    everything = spark.read.schema(f"{ENTRY_SCHEMA}, level INT").parquet(folder)
    files = everything.where("NOT is_folder").filter(clock.in_window(F.col("last_modified"), start, end))
    return as_listing(
        files.select(F.lit(bucket).alias("bucket"), F.col("key").alias("object_key"), "size_bytes", "last_modified")
    )


def changed_objects(before: DataFrame, now: DataFrame) -> DataFrame:
    """The difference of two inventories ``bucket, object_key, size_bytes, last_modified``.

    Rows of ``now`` that ``before`` does not hold are ``added``, or ``changed`` where
    it holds the key with another size or time; rows of keys that are gone are
    ``removed`` and keep what ``before`` says of them. Both joins are anti joins on
    keys; nulls equal nulls. Repeated rows of an inventory count once.
    """
    columns = (*INVENTORY_KEY, "size_bytes", "last_modified")

    def unheld(left: DataFrame, right: DataFrame, names: tuple[str, ...], how: str) -> DataFrame:
        others = right.select(*[F.col(c).alias(f"_{c}") for c in names]).distinct().withColumn("_held", F.lit(True))
        equal = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
        return left.join(others, equal, how)

    old, new = before.select(*columns).distinct(), now.select(*columns).distinct()
    fresh = unheld(unheld(new, old, columns, "left_anti"), old, INVENTORY_KEY, "left")
    change = F.when(F.col("_held"), F.lit("changed")).otherwise("added").alias("change")
    gone = unheld(old, new, INVENTORY_KEY, "left_anti")
    return fresh.select(*columns, change).unionByName(gone.select(*columns, F.lit("removed").alias("change")))


def as_listing(objects: DataFrame) -> DataFrame:
    """Add the timestamp text and the address to ``bucket, object_key, last_modified``."""
    return objects.withColumns(
        {
            "timestamp": clock.iso_timestamp(F.col("last_modified")),
            "object_uri": object_uri(F.col("bucket"), F.col("object_key")),
        }
    )


def notified_objects(notifications: DataFrame, value: str = "value") -> DataFrame:
    """One listing row per record of a store notification."""
    record = F.explode(F.from_json(F.col(value), NOTIFICATION_SCHEMA)["Records"]).alias("r")
    others = [c for c in notifications.columns if c != value]
    return notifications.select(*others, record).select(
        *others,
        F.col("r.eventName").alias("event_name"),
        F.col("r.eventTime").alias("timestamp"),
        F.col("r.s3.bucket.name").alias("bucket"),
        F.col("r.s3.object.key").alias("object_key"),
        F.col("r.s3.object.size").alias("size_bytes"),
        object_uri(F.col("r.s3.bucket.name"), F.col("r.s3.object.key")).alias("object_uri"),
    )
