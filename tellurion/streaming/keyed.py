"""Tables with one row per key that a stream folds batch by batch.

Rows lie in hash buckets of their keys. A batch reads the buckets it touches,
keeps the last row of every key, and writes those buckets anew as a run named
by the batch. A manifest then names the run of every bucket; it is written to a
temporary file and renamed, so a reader sees all of a batch or nothing of it.

A repeated batch starts from the manifest before it and leaves the same rows.
Runs that the last manifest does not name are removed when the next batch
starts, when the stream has recorded the batch before as done. So the table
holds its live keys, and the buckets of one batch more. ``removed`` says which
rows are dropped once they are the last of their key and older, by ``clock``,
than ``keep`` below the newest row of the batch: tombstones are kept that long,
because an older change of their key could still arrive.

Reads and writes go through Spark's file systems. The driver sees names of
buckets and runs, never rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellurion.operators.latest import compacted

BUCKET = "_bucket"
# Buckets of a table; a batch rewrites the live keys of each bucket it touches.
BUCKETS = 64


class KeyedTable:
    """The last row of every key, by ``order``, among all rows that were folded in."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str],
        order: Sequence[str], buckets: int = BUCKETS, removed: Column | None = None,
        clock: str | None = None, keep: int = 0,
    ):
        self.spark, self.path, self.keys, self.order = spark, path.rstrip("/"), list(keys), list(order)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.buckets, self.removed, self.clock, self.keep = buckets, removed, clock, keep
        jvm = spark._jvm
        self._jvm, self._at = jvm, jvm.org.apache.hadoop.fs.Path
        self._files = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        if not self._files.exists(at):
            return []
        return [s.getPath().getName() for s in self._files.listStatus(at)]

    def _manifests(self) -> list[int]:
        names = self._names(f"{self.path}/manifest")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "_")

    def _manifest(self, batch_id: int | None) -> dict[int, int]:
        """The run of every bucket after a batch (of none: before the first)."""
        if batch_id is None:
            return {}
        stream = self._files.open(self._at(f"{self.path}/manifest/{batch_id}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {int(b): run for b, run in json.loads(text).items()}

    def _publish(self, batch_id: int, runs: dict[int, int]) -> None:
        folder = f"{self.path}/manifest"
        draft, final = self._at(f"{folder}/_{batch_id}"), self._at(f"{folder}/{batch_id}.json")
        out = self._files.create(draft, True)
        out.write(bytearray(json.dumps(runs), "utf-8"))
        out.close()
        if self._files.exists(final):
            self._files.delete(final, False)
        self._files.rename(draft, final)

    def _before(self, batch_id: int) -> int | None:
        return max((m for m in self._manifests() if m < batch_id), default=None)

    def _read(self, runs: dict[int, int]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/run={run}/{BUCKET}={b}" for b, run in sorted(runs.items())]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _tidy(self, before: int | None, batch_id: int) -> None:
        """Remove what neither the manifest before this batch nor the batch itself names."""
        runs = self._manifest(before)
        for name in self._names(self.path):
            if not name.startswith("run=") or int(name[4:]) >= batch_id:
                continue
            run = int(name[4:])
            if run not in runs.values():
                self._files.delete(self._at(f"{self.path}/{name}"), True)
                continue
            for bucket in self._names(f"{self.path}/{name}"):
                if bucket.startswith(BUCKET) and runs.get(int(bucket[len(BUCKET) + 1 :])) != run:
                    self._files.delete(self._at(f"{self.path}/{name}/{bucket}"), True)
        for old in self._manifests():
            if before is not None and old < before:
                self._files.delete(self._at(f"{self.path}/manifest/{old}.json"), False)

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _touched(self, rows: DataFrame) -> list[int]:
        return [r[0] for r in self._bucketed(rows).select(BUCKET).distinct().collect()]

    def rows(self) -> DataFrame:
        """All rows after the last finished batch."""
        return self._read(self._manifest(max(self._manifests(), default=None)))

    def met_by(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Rows before this batch in the buckets that its keys lie in."""
        runs = self._manifest(self._before(batch_id))
        return self._read({b: runs[b] for b in self._touched(batch) if b in runs})

    def fold(self, batch: DataFrame, batch_id: int) -> None:
        """Fold the rows of a batch into the table."""
        before = self._before(batch_id)
        self._tidy(before, batch_id)
        runs = self._manifest(before)
        touched = self._touched(batch)
        held = self._read({b: runs[b] for b in touched if b in runs})
        names = self.schema.fieldNames()
        both = self._bucketed(batch.select(*names).unionByName(held))
        last = compacted(both, [*self.keys, BUCKET], self.order)
        if self.removed is not None:
            gone = self.removed
            if self.clock is not None:
                newest = batch.agg(F.max(self.clock)).head()[0]
                gone = gone & (F.col(self.clock) < F.lit(newest) - self.keep)
            last = last.where(~F.coalesce(gone, F.lit(False)))
        kept = last.select(*names, BUCKET).repartition(BUCKET)
        run = f"{self.path}/run={batch_id}"
        kept.write.mode("overwrite").partitionBy(BUCKET).parquet(run)
        written = {int(n[len(BUCKET) + 1 :]) for n in self._names(run) if n.startswith(BUCKET)}
        runs = {b: r for b, r in runs.items() if b not in touched} | {b: batch_id for b in written}
        self._publish(batch_id, runs)
