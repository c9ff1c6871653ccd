"""Many small texts in few bounded files, with an index of offsets for single reads.

A member is ``content`` under its ``keys``, by default the request and the file name,
so that two requests for one dataset stay apart. Members lie end to end, as UTF-8, in
containers: rows of a Parquet table, each at most ``container_bytes`` and the member
that crosses that line. The index names the container, the offset, the size and the
digest of every member; it is read from the written containers, so it can be made
again at any time, and reading it touches no content.

Members are dealt into shards by a hash of their keys and digest; the number of shards
follows from the size of the input, and a shard that got more than its share makes more
containers. What a container holds does not depend on how rows come, so a repeated
write leaves the same members at the same places.

A task holds one container at a time when it writes: members are collected along a sort,
not in a hash table of containers, and each container ends its page and row group, so
that no reader gets more than a few of them at once. Reads deal few containers to a task.

Cases: null content counts as empty, null keys are keys like others. Rows with equal
keys and equal content are one member; they are combined before the shuffle. Equal keys
with different content are members of their own, told apart by ``sha256``. No rows give
an empty package. Columns beside the keys and the content are not written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KEYS = ("request_id", "file_name")
CONTAINER_BYTES = 16 << 20
#: Containers of one shard are numbered within a range of this length.
SHARD_RANGE = 1 << 24
#: About so many containers are joined with their places by one task.
TASK_CONTAINERS = 4
HASHED = "spark.sql.execution.useObjectHashAggregateExec"


def containers(
    files: DataFrame, keys: Sequence[str] = KEYS, container_bytes: int = CONTAINER_BYTES
) -> DataFrame:
    """Rows of ``container, data, members``; the members in the order of their offsets."""
    text = F.coalesce(F.col("content"), F.lit(""))
    rows = files.select(*keys, text.alias("content")).withColumn("sha256", F.sha2(F.encode("content", "UTF-8"), 256))
    total = rows.select(F.sum(F.octet_length("content").cast("long"))).first()[0] or 0
    shards = max(1, -(-total // container_bytes))
    members = rows.groupBy(*keys, "sha256").agg(F.first("content").alias("content"))
    dealt = members.withColumns(
        {"shard": F.pmod(F.xxhash64(*keys, "sha256"), F.lit(shards)), "size": F.octet_length("content").cast("long")}
    )
    before = Window.partitionBy("shard").orderBy(*keys, "sha256").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0)))
    container = (F.col("shard") * SHARD_RANGE + F.floor(F.col("at") / container_bytes)).cast("long")
    # One exchange by shard serves both the running sizes and the containers.
    together = (
        placed.withColumn("container", container)
        .groupBy("shard", "container")
        .agg(F.array_sort(F.collect_list(F.struct("at", *keys, "sha256", "size", "content"))).alias("m"))
    )
    places = F.transform(
        "m", lambda m: F.struct(*(m[k].alias(k) for k in keys), (m["at"] - F.col("m")[0]["at"]).alias("at"), m["size"], m["sha256"])
    )
    data = F.encode(F.array_join(F.transform("m", lambda m: m["content"]), ""), "UTF-8")
    return together.select("container", data.alias("data"), places.alias("members"))


def write(
    files: DataFrame, path: str, keys: Sequence[str] = KEYS, container_bytes: int = CONTAINER_BYTES
) -> None:
    """Write a package; a write that was broken off is repeated as a whole."""
    spark = files.sparkSession
    # Readers take a row group at once, and its size is measured compressed: it is bounded in rows.
    # Unless told otherwise, the writer looks at sizes after a hundred rows, here containers.
    blocks = {
        "parquet.block.size": container_bytes,
        "parquet.block.row.count.limit": max(1, CONTAINER_BYTES // container_bytes),
        "parquet.page.size.row.check.min": 1,
        # Snappy keeps buffers of a page beside the heap, zstd does not.
        "compression": "zstd",
        # Least and greatest values are whole containers, kept for each row group of a file.
        "parquet.column.statistics.enabled#data": "false",
        "parquet.enable.dictionary#data": "false",
    }
    packed = containers(files, keys, container_bytes)
    before = spark.conf.get(HASHED)
    try:
        # A hash table would hold the members of up to 128 containers, outside of managed memory.
        spark.conf.set(HASHED, "false")
        packed.write.mode("overwrite").options(**blocks).parquet(f"{path}/containers")
    finally:
        spark.conf.set(HASHED, before)
    write_index(spark, path, keys)


def write_index(spark: SparkSession, path: str, keys: Sequence[str] = KEYS) -> None:
    """Write the index anew from the containers, sorted by key so that lookups skip the rest."""
    held = spark.read.parquet(f"{path}/containers").select("container", F.inline("members"))
    held.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{path}/index")


def index(spark: SparkSession, path: str) -> DataFrame:
    """Where every member lies: its keys, ``container, at, size, sha256``."""
    return spark.read.parquet(f"{path}/index")


def read(spark: SparkSession, path: str, wanted: DataFrame | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Members with their ``content``; all of them, or those whose keys are in ``wanted``.

    Places travel to their container, one row for each; its content is cut there.
    """
    places = index(spark, path)
    if wanted is not None:
        same = [F.col(f"p.{k}").eqNullSafe(F.col(f"w.{k}")) for k in keys]
        places = places.alias("p").join(wanted.select(*keys).alias("w"), same, "left_semi")
    stored = spark.read.parquet(f"{path}/containers").select("container", "data")
    tasks = max(1, -(-stored.count() // TASK_CONTAINERS))
    cuts = (
        places.repartition(tasks, "container")
        .groupBy("container")
        .agg(F.collect_list(F.struct(*keys, "at", "size", "sha256")).alias("cuts"))
    )
    # Judged by its compressed files, the content could be taken for small enough to be broadcast.
    held = stored.repartition(tasks, "container").hint("merge").join(cuts, "container")

    def member(data: Column, c: Column) -> Column:
        text = F.substring(data, (c["at"] + 1).cast("int"), c["size"].cast("int"))
        return F.struct(*(c[k].alias(k) for k in keys), c["sha256"], F.decode(text, "UTF-8").alias("content"))

    # Each use of a binary column copies it whole: one use for all members of a container.
    cut = F.transform(F.array("data"), lambda data: F.transform("cuts", lambda c: member(data, c)))
    return held.select(F.inline(F.flatten(cut)))


def read_one(spark: SparkSession, path: str, key: Mapping[str, object]) -> DataFrame:
    """The members of one key by two pruned scans: of the index, then of their containers."""
    match = F.lit(True)
    for name, value in key.items():
        match = match & F.col(name).eqNullSafe(F.lit(value))
    places = index(spark, path).where(match)
    # At most the distinct contents of one key.
    numbers = [r["container"] for r in places.select("container").distinct().toLocalIterator()]
    held = spark.read.parquet(f"{path}/containers").where(F.col("container").isin(numbers)).select("container", "data")
    cut = F.substring("data", (F.col("at") + 1).cast("int"), F.col("size").cast("int"))
    return places.join(held, "container").select(*key, "sha256", F.decode(cut, "UTF-8").alias("content"))
