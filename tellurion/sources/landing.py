"""Readers of landed messages and of topic logs, as tables or streams."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellurion.functions import topics

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("qos", T.IntegerType()),
        T.StructField("retain", T.BooleanType()),
        T.StructField("arrived_at", T.TimestampType()),
        T.StructField("arrival_seq", T.LongType()),
    ]
)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def landed_messages(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    schema: T.StructType = MESSAGE_SCHEMA,
    max_files: int | None = None,
) -> DataFrame:
    """Messages from parquet files, with an explicit schema."""
    if not streaming:
        return spark.read.schema(schema).parquet(path)
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def subscribed_messages(
    messages: DataFrame, subscriptions: Iterable[str] = topics.DEFAULT_SUBSCRIPTIONS
) -> DataFrame:
    return messages.filter(topics.subscribed(F.col("topic"), subscriptions))


def kafka_options(
    servers: str,
    subscribe: Iterable[str],
    starting: str = "earliest",
    properties: Mapping[str, str] | None = None,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options of one reader over several topics; properties gain the client prefix."""
    if starting not in ("earliest", "latest"):
        raise ValueError("start at 'earliest' or 'latest'")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(subscribe),
        "startingOffsets": starting,
        **{f"kafka.{k}": v for k, v in (properties or {}).items()},
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def topic_log(
    spark: SparkSession, options: Mapping[str, str], streaming: bool = True
) -> DataFrame:
    """Several topics as one table or stream; needs the Kafka connector on the class path."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()


def raw_records(log: DataFrame) -> DataFrame:
    """Log rows as ``source_topic, raw_json`` with their arrival coordinates.

    Arrival order over topics is not defined by a log; here it is the log time
    in ``arrival_seq``, then topic, partition and offset in ``arrival_tie``. Both
    come from the row alone, so no sort of the log is needed.
    """
    return log.select(
        F.col("topic").alias("source_topic"),
        F.col("value").cast("string").alias("raw_json"),
        F.col("timestamp").alias("arrived_at"),
        F.unix_micros("timestamp").alias("arrival_seq"),
        F.struct("topic", "partition", "offset").alias("arrival_tie"),
        "partition",
        "offset",
    )


def union_logs(logs: Iterable[DataFrame]) -> DataFrame:
    """One table from several single-topic tables."""
    first, *rest = logs
    for log in rest:
        first = first.unionByName(log)
    return first
