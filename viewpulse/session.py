"""Session helpers: a local session for tests/bench and the shared folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "viewpulse") -> SparkSession:
    """A local session with AQE on and the UI off (tests, bench)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("VIEWPULSE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for lineage cuts and staged tables.

    Read from the session (``SparkContext`` checkpoint dir or the
    ``spark.checkpoint.dir`` setting).  A local session has one disk, so there
    a missing setting gives a fresh temporary folder; on a cluster it is an error,
    since executors would write to their own disks.
    """
    try:  # classic sessions; a Spark Connect session has no SparkContext
        sc = spark.sparkContext
        d = sc.getCheckpointDir()
    except Exception:
        sc, d = None, None
    d = d or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    if sc is None or not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir (or pass stage_dir) to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="viewpulse-shared-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
