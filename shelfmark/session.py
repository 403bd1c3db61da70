"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Settings the jobs rely on. Joins carry no broadcast hints: AQE compares measured sizes with
# autoBroadcastJoinThreshold, and splits skewed sort-merge partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Rows that reach Python carry whole pages, so batches are bounded by bytes, not only by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    # The extraction plans are made of hundreds of column calls; recording where each one was
    # written doubles the time to build them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "shelfmark", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local session may fall back to a temporary folder: on a cluster one machine's disk is
    neither visible to, nor survives the loss of, the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root().name
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@cache
def _local_root() -> tempfile.TemporaryDirectory:
    """One folder per process, removed when it ends."""
    return tempfile.TemporaryDirectory(prefix="shelfmark-", ignore_cleanup_errors=True)
