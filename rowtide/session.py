"""Session settings the rest of the package relies on."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Semantics, not tuning: identifiers of two source columns may differ only in case,
# and timestamps must read the same on every executor.
REQUIRED_CONF = {
    "spark.sql.caseSensitive": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
}

# Cluster defaults; every one of them can be overridden by the deployer. The first is an upper
# bound that adaptive execution shrinks: raise it to (bytes of the largest shuffle / 256 MB).
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.scheduler.mode": "FAIR",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the semantic settings on an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_CONF, **REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="rowtide-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _own_dir()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
