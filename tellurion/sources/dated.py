"""Tables laid out by time, for retention without rewriting.

A table has a folder per period (a day, or any unit of ``date_trunc`` from a day on) and
per batch. Reading what is retained opens only the folders that can hold it; expiry
drops whole folders and touches no file that stays. A batch owns its folders, so a
repeated batch leaves the same rows.

Cases: rows without a time lie in a folder of their own; they are never retained, as in
``latest.retained``, and never expired. The period in which the bound lies is kept whole
on disk and filtered when read. Readers that began before an expiry may miss the
dropped folders; run it while no query reads older than the bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellurion.operators import latest

PERIOD, BATCH = "period", "batch"
UNIT = "day"


def _start(at: Column, unit: str) -> Column:
    return F.date_trunc(unit, at).cast("date")


def _bound(as_of: Column, keep_ms: int) -> Column:
    return as_of - F.expr(f"make_dt_interval(0, 0, 0, {keep_ms / 1000})")


def write(rows: DataFrame, path: str, at: str, batch_id: int = 0, unit: str = UNIT) -> None:
    """Write a batch; large periods are split over tasks and small ones share a task."""
    clash = {PERIOD, BATCH} & set(rows.columns)
    if clash:
        raise ValueError(f"columns named like the layout: {sorted(clash)}")
    placed = rows.withColumns({PERIOD: _start(F.col(at), unit), BATCH: F.lit(batch_id)})
    placed.hint("rebalance", F.col(PERIOD)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(PERIOD, BATCH).parquet(path)


def retained(
    spark: SparkSession, path: str, at: str, as_of: Column, keep_ms: int = latest.RETENTION_MS, unit: str = UNIT
) -> DataFrame:
    """Rows no older than the retention time; earlier periods are not opened."""
    rows = spark.read.option("basePath", path).parquet(path)
    recent = rows.filter(F.col(PERIOD) >= _start(_bound(as_of, keep_ms), unit))
    return latest.retained(recent, at, as_of, keep_ms).drop(PERIOD, BATCH)


def expire(
    spark: SparkSession, path: str, as_of: Column, keep_ms: int = latest.RETENTION_MS, unit: str = UNIT
) -> list[str]:
    """Drop the periods that end before the retention time; their starts, in order.

    The driver lists one folder per period, and no file.
    """
    first_kept = spark.range(1).select(_start(_bound(as_of, keep_ms), unit).cast("string")).first()[0]
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for folder in store.listStatus(root):
        name, _, start = folder.getPath().getName().partition("=")
        # Folders of rows without a time have a name that is no date.
        if name == PERIOD and start[:1].isdigit() and start < first_kept:
            store.delete(folder.getPath(), True)
            dropped.append(start)
    return sorted(dropped)
