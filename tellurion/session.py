"""Session settings the operators rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings only: nothing here sizes the cluster, so shuffle partition
# counts stay with the submitter and with adaptive execution.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JIT does not compile methods above 8000 bytecodes; past that size the
    # split, per-operator projections are faster than one fused method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Streaming state on disk instead of in executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Clusters name it in ``spark.checkpoint.dir``. A local folder is made only
    when the setting is absent, as in tests on one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tellurion-")


def run_folder(spark: SparkSession, name: str) -> str:
    """A folder that no earlier run has used."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
