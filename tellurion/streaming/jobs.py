"""Streaming queries over the same column expressions as the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tellurion.operators import deadletters, ingest, latest, normalise
from tellurion.sources import sinks
from tellurion.streaming.keyed import KeyedTable

# Fixed value: time between checkpoints.
TRIGGER = "10 seconds"
# How long a deleted key is remembered, in milliseconds of the feed: a day.
TOMBSTONE_MS = 86_400_000


def _judged(
    batch: DataFrame, state: KeyedTable, batch_id: int, order: tuple[str, ...], block_rows: int
) -> DataFrame:
    """The rows of a batch that are accepted within it and against the state before it."""
    known = state.met_by(batch, batch_id)
    judged = latest.with_acceptance(
        batch, arrival=order[0], tie=order[1] if len(order) > 1 else None, block_rows=block_rows
    )
    current = F.col("known_ts").isNull() | F.coalesce(F.col("event_ts") >= F.col("known_ts"), F.lit(False))
    kept = judged.join(known, "entity_id", "left").filter(F.col("accepted") & current)
    return kept.select(*batch.columns)


def _state(spark: SparkSession, path: str) -> KeyedTable:
    """The greatest event time that was accepted per entity."""
    return KeyedTable(spark, path, "entity_id STRING, known_ts STRING", ["entity_id"], ["known_ts"])


def _seen(batch: DataFrame) -> DataFrame:
    return batch.groupBy("entity_id").agg(F.max("event_ts").alias("known_ts"))


def _each_batch(write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Keep a batch while it is written: it is read several times.

    What is lost with an executor is computed again from the source.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def accepted_by_batch(
    events: DataFrame, path: str, checkpoint: str, order: tuple[str, ...] = ("arrival_seq",),
    once: bool = False, block_rows: int = latest.BLOCK_ROWS,
) -> StreamingQuery:
    """Latest-state acceptance of a stream, one row out per accepted row.

    Every batch is ordered in blocks of bounded size, so an entity with any
    share of the rows spreads over many tasks, and then meets the state of the
    batches before it: one row per entity in a keyed table. Late rows are seen
    and rejected by their time, never dropped unseen. A batch writes its own
    directory and can be repeated.
    """
    state = _state(events.sparkSession, f"{path}/state")

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = _judged(batch, state, batch_id, order, block_rows)
        kept.write.mode("overwrite").parquet(f"{path}/accepted/batch_id={batch_id}")
        state.fold(_seen(batch), batch_id)

    return _triggered(events.writeStream.foreachBatch(_each_batch(write)), checkpoint, once).start()


def features_and_state(
    records: DataFrame, path: str, checkpoint: str, order: tuple[str, ...] = ("arrival_seq",),
    once: bool = False, block_rows: int = latest.BLOCK_ROWS,
) -> StreamingQuery:
    """Features, accepted rows and the state table from one stream of raw records.

    A batch is normalised once and written three times under its number: all of
    its events as features, those accepted as state records, and the last event
    per entity folded into the state table. Each write replaces what an earlier
    try of the same batch left, and acceptance reads the state before the batch,
    so a job that dies between two writes repeats the batch to the same rows.
    """
    events = normalise.normalised(records)
    spark = records.sparkSession
    known = _state(spark, f"{path}/known")
    state = KeyedTable(spark, f"{path}/state", events.schema, ["entity_id"], ["event_ts", *order])

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_features(batch, f"{path}/features", batch_id)
        kept = _judged(batch, known, batch_id, order, block_rows)
        sinks.state_records(kept, order).write.mode("overwrite").parquet(f"{path}/accepted/batch_id={batch_id}")
        state.fold(latest.latest_state(batch, *order), batch_id)
        known.fold(_seen(batch), batch_id)

    return _triggered(events.writeStream.foreachBatch(_each_batch(write)), checkpoint, once).start()


def state_table(
    events: DataFrame, path: str, checkpoint: str, order: tuple[str, ...] = ("arrival_seq",), once: bool = False
) -> StreamingQuery:
    """Final state per entity, folded batch by batch into a keyed table."""
    state = KeyedTable(events.sparkSession, path, events.schema, ["entity_id"], ["event_ts", *order])

    def write(batch: DataFrame, batch_id: int) -> None:
        state.fold(latest.latest_state(batch, *order), batch_id)

    return _triggered(events.writeStream.foreachBatch(_each_batch(write)), checkpoint, once).start()


def latest_table(events: DataFrame, order: tuple[str, ...] = ("arrival_seq",)) -> DataFrame:
    """Continuously maintained final state per entity, without Python."""
    others = [c for c in events.columns if c != "entity_id"]
    last = F.max_by(F.struct(*others), F.struct("event_ts", *order)).alias("last")
    return events.groupBy("entity_id").agg(last).select("entity_id", "last.*")


def dead_letter_windows(
    messages: DataFrame, at: str = "arrived_at", width: str = "1 day"
) -> DataFrame:
    """Dead-letter categories per window of a message stream.

    Without a watermark dead letters are counted however late they come. State is
    one count per window and category, kept for ever: the size of the result.
    """
    events = ingest.ingested(messages)
    return deadletters.category_counts(events.filter(F.size("errors") > 0), at, width)


def _triggered(writer: DataStreamWriter, checkpoint: str, once: bool) -> DataStreamWriter:
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)


def written(
    stream: DataFrame, path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Append a stream to parquet with exactly-once files."""
    writer = stream.writeStream.format("parquet").option("path", path).outputMode("append")
    return _triggered(writer, checkpoint, once).start()


def updated(
    stream: DataFrame, path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Write the rows an aggregation changes, one directory per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write).outputMode("update")
    return _triggered(writer, checkpoint, once).start()


def current(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The newest version of every key among the batches :func:`updated` wrote."""
    return latest.compacted(rows, keys, ["batch_id"]).drop("batch_id")


def routed_stream(
    messages: DataFrame, path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Ingest a message stream and write one directory per outgoing topic."""
    records = ingest.outgoing(ingest.ingested(messages))

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_by_topic(batch, path, batch_id)

    return _triggered(records.writeStream.foreachBatch(write), checkpoint, once).start()


def normalised_stream(
    records: DataFrame, path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Normalise a stream of raw records and write every row, late ones too."""
    return written(normalise.normalised(records), path, checkpoint, once)


def upserted_changes(
    changes: DataFrame, keys: list[str], path: str, checkpoint: str, once: bool = False,
    tombstone_ms: int = TOMBSTONE_MS,
) -> StreamingQuery:
    """Fold a change stream into a table of the last change per key.

    Batches rewrite only the buckets they touch. Deletions stay for
    ``tombstone_ms`` of the feed's own time, then their rows are gone.
    """
    keyed = changed_rows(changes, keys)
    table = changes_table(changes.sparkSession, path, keyed.schema, keys, tombstone_ms)

    def write(batch: DataFrame, batch_id: int) -> None:
        table.fold(batch, batch_id)

    return _triggered(keyed.writeStream.foreachBatch(_each_batch(write)), checkpoint, once).start()


def changed_rows(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Changes with their keys; a deletion carries its key in ``before``."""
    return changes.withColumns(
        {f"_key_{k}": F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")) for k in keys}
    )


def changes_table(
    spark: SparkSession, path: str, schema, keys: list[str], tombstone_ms: int = TOMBSTONE_MS
) -> KeyedTable:
    return KeyedTable(
        spark, path, schema, [f"_key_{k}" for k in keys], ["ts_ms", "offset"],
        removed=F.col("op") == "d", clock="ts_ms", keep=tombstone_ms,
    )
