"""Writers: topic logs, state tables, fan-out by topic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tellurion.operators import normalise

# Producer settings of the ingest path.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.linger.ms": "50",
    "kafka.batch.size": "131072",
    "kafka.compression.type": "lz4",
    "kafka.max.in.flight.requests.per.connection": "1",
}


def feature_records(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Normalised events as ``key, value`` keyed by entity, and columns to ``keep``."""
    value = normalise.as_text(events).alias("value")
    return events.select(F.col("entity_id").alias("key"), value, *keep)


def state_records(accepted: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Accepted events keyed by entity, so that compaction keeps one per entity."""
    return feature_records(accepted, keep)


def kafka_sink(
    records: DataFrame, servers: str, checkpoint: str, topic: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataStreamWriter:
    """Stream writer to topics; without ``topic`` each record names its own."""
    options = {
        "kafka.bootstrap.servers": servers,
        "checkpointLocation": checkpoint,
        **PRODUCER_OPTIONS,
        **{f"kafka.{k}": v for k, v in (properties or {}).items()},
    }
    if topic:
        options["topic"] = topic
    return records.writeStream.format("kafka").options(**options)


def write_by_topic(records: DataFrame, path: str, batch_id: int | None = None) -> None:
    """One directory per topic in a single job, without a shuffle.

    A batch owns its directory and overwrites it, so a repeated batch leaves
    the same files.
    """
    target = path if batch_id is None else f"{path}/batch_id={batch_id}"
    records.write.mode("overwrite").partitionBy("topic").parquet(target)


def write_counted(
    records: DataFrame, path: str, topics: Sequence[str], batch_id: int | None = None
) -> dict[str, int]:
    """Write by topic, and count while writing: all ``records`` and those of each topic.

    The counts are those of the tasks whose files stay; the rows are not read again.
    Nothing to write counts zero, as does a topic without a record.
    """
    seen = Observation()
    per_topic = [F.count_if(F.col("topic") == topic).alias(topic) for topic in topics]
    write_by_topic(records.observe(seen, F.count("*").alias("records"), *per_topic), path, batch_id)
    return {name: count or 0 for name, count in seen.get.items()}


def write_features(events: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Normalised events by event date and source topic, for partition pruning."""
    target = path if batch_id is None else f"{path}/batch_id={batch_id}"
    dated = events.withColumn("event_date", F.try_to_date(F.substring("event_ts", 1, 10)))
    dated.write.mode("overwrite").partitionBy("event_date", "source_topic").parquet(target)
