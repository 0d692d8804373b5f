"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Event time is UTC throughout; the fixture mapping and window bounds assume it.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Several streaming queries share the executors; FAIR pools (one per
    # query, see streaming.jobs) keep the 10 s departures query from queueing
    # behind the metrics aggregation.
    "spark.scheduler.mode": "FAIR",
    # The decode/enrich projections carry many aliases over one parsed struct;
    # constraint inference over them is exponential (86 s of planning for a
    # filter on the aggregate). Plain predicate pushdown is unaffected.
    "spark.sql.constraintPropagation.enabled": "false",
    # Stateful queries fix their shuffle partitions at the first checkpoint;
    # RocksDB keeps large state off the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "railyard") -> SparkSession:
    """Session for tests, the bench and local runs (cluster jobs get theirs from spark-submit)."""
    os.environ.setdefault("TZ", "UTC")
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "8g")
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Runtime SQL settings every query needs, also in a session we did not build.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.constraintPropagation.enabled": "false",
}


def ensure_utc(spark: SparkSession) -> None:
    """Window bounds, ISO text and the fixture mapping are all defined in UTC;
    also applies the other runtime settings of RUNTIME_CONF."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, sinks and lineage cuts.

    On a cluster this is the folder named by ``spark.checkpoint.dir``, which must be
    set; only a local session without one (tests) gets a temporary folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="railyard-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir()
    return d


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused sub-folder of the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{label}-{uuid.uuid4().hex[:12]}"


def _hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_path(spark: SparkSession, path: str) -> list[str]:
    """Children of a folder in any file system Spark knows; none if it does not exist."""
    p, fs = _hadoop_path(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(p)] if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder in any file system Spark knows."""
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)
