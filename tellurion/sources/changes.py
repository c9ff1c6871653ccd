"""Database change records folded to the current rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellurion.operators.latest import compacted


def change_envelope(records: DataFrame, row_schema: str, value: str = "value") -> DataFrame:
    """Parse ``op, before, after, ts_ms`` from JSON; other columns are kept."""
    schema = f"op STRING, before STRUCT<{row_schema}>, after STRUCT<{row_schema}>, ts_ms BIGINT"
    others = [c for c in records.columns if c != value]
    return records.select(*others, F.from_json(F.col(value), schema).alias("c")).select(
        *others, "c.*"
    )


def folded(changes: DataFrame, keys: Sequence[str], offset: str = "offset") -> DataFrame:
    """Rows that exist after all changes: the last change per key, deletions dropped.

    A deletion carries its key in ``before``.
    """
    keyed = changes.withColumns(
        {f"_key_{k}": F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")) for k in keys}
    )
    last = compacted(
        keyed.select(*[f"_key_{k}" for k in keys], "op", "after", "ts_ms", offset),
        [f"_key_{k}" for k in keys],
        ["ts_ms", offset],
    )
    return last.filter(F.col("op") != "d").select("after.*", "ts_ms")
