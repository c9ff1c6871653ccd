"""Latest state per entity, compacted registers and retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellurion.operators import blocks

BLOCK_ROWS = blocks.BLOCK_ROWS
# Fixed value: retention of evidence topics that are not compacted, in milliseconds.
RETENTION_MS = 31_536_000_000


def with_acceptance(
    events: DataFrame,
    arrival: str = "arrival_seq",
    tie: str | None = None,
    order_by: str = "event_ts",
    block_rows: int = BLOCK_ROWS,
    cuts: Sequence | None = None,
) -> DataFrame:
    """Add ``accepted``: no earlier arrival of the entity had a greater ``order_by``.

    ``arrival`` orders the arrivals and may have any unit. It is cut at ``cuts``,
    by default at its measured quantiles, into blocks of about ``block_rows``
    rows, so an entity with any share of all rows is spread over many tasks. Where
    events are expensive to derive, measure the cuts on the stored records
    (:func:`blocks.cuts`). A null ``order_by`` ranks below all others.
    """
    order = [arrival] if tie is None else [arrival, tie]
    at = blocks.cuts(events, arrival, block_rows) if cuts is None else cuts
    running = blocks.with_running_max(
        events,
        keys=["entity_id"],
        order=order,
        value=F.col(order_by),
        block=blocks.block_of(F.col(arrival), at) if at else None,
        name="_greatest_before",
    )
    before = F.col("_greatest_before")
    reached = F.coalesce(F.col(order_by) >= before, F.lit(False))
    return running.withColumn("accepted", before.isNull() | reached).drop("_greatest_before")


def accepted(events: DataFrame, **options) -> DataFrame:
    """The rows that update the state of their entity when they arrive."""
    return with_acceptance(events, **options).filter("accepted").drop("accepted")


def compacted(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key. Partial aggregation keeps one row per key and task."""
    others = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*others), F.struct(*order)).alias("_last")
    return rows.groupBy(*keys).agg(last).select(*keys, "_last.*")


def latest_state(
    events: DataFrame, arrival: str = "arrival_seq", tie: str | None = None,
    order_by: str = "event_ts",
) -> DataFrame:
    """Final state per entity: the greatest ``order_by``, later arrivals winning ties."""
    order = [order_by, arrival] if tie is None else [order_by, arrival, tie]
    return compacted(events, ["entity_id"], order)


def retained(rows: DataFrame, at: str, as_of: Column, keep_ms: int = RETENTION_MS) -> DataFrame:
    """Rows no older than the retention time; the bound is a constant the scan can use."""
    return rows.filter(F.col(at) >= as_of - F.expr(f"make_dt_interval(0, 0, 0, {keep_ms / 1000})"))
