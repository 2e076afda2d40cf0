"""The log of daily runs: which stage wrote which table from which inputs.

An append-only JSON table beside the outputs, a line for each finished stage or published table.  A run
that died is taken up where it stopped: a stage whose inputs have the same fingerprint is
read back instead of built.  A reader asks it which folder holds the current version of a report.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from viewpulse.sources.files import path_exists

LOG_SCHEMA = "at_micros long, run_id string, snapshot_date_key int, stage string, fingerprint string, path string"


def _entries(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").json(path)


class RunLog:
    """Entries of one snapshot in a warehouse folder's log; ``resume=False`` writes entries but reuses nothing."""

    def __init__(self, spark: SparkSession, path: str, run_id: str = "", snapshot_date_key: int | None = None, resume: bool = True):
        self.spark, self.path, self.run_id, self.key = spark, path, run_id, snapshot_date_key
        own = F.col("snapshot_date_key").eqNullSafe(F.lit(snapshot_date_key))
        last = _entries(spark, path).groupBy("stage").agg(
            F.max_by(F.when(own, F.struct("fingerprint", "path")), F.when(own, F.col("at_micros"))).alias("e"), F.max("at_micros").alias("at")
        ).collect()  # a row a stage
        #: stage -> fingerprint and path of its last entry for this snapshot, and the time of its last entry for any
        self.newest: dict[str, tuple[str, str]] = {r["stage"]: tuple(r["e"]) for r in last if resume and r["e"]}
        self.last_micros: dict[str, int] = {r["stage"]: r["at"] for r in last}

    def record(self, *entries: tuple[str, str, str]) -> None:
        """A line for each (stage, fingerprint, path), in a folder of its own, so that concurrent writers don't meet."""
        names = [f.split() for f in LOG_SCHEMA.split(", ")]
        lines = [(time.time_ns() // 1000, self.run_id, self.key, *e) for e in entries]
        rows = F.array(*[F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(line, names)]) for line in lines])
        self.spark.range(1, numPartitions=1).select(F.inline(rows)).write.json(f"{self.path}/{uuid.uuid4().hex}")
        self.newest |= {stage: (fingerprint, path) for stage, fingerprint, path in entries}

    def done(self, stage: str, fingerprint: str) -> str | None:
        """The path that the stage's newest entry names, if it is of these inputs and still there."""
        known, path = self.newest.get(stage, ("", ""))
        return path if known == fingerprint and path_exists(self.spark, path) else None

    def table(self, stage: str, fingerprint: str, build: Callable[[], DataFrame], folder: str) -> DataFrame:
        """A stage's written table: that of an earlier run of the same inputs, or built and written now."""
        path = self.done(stage, fingerprint)
        if path is None:
            path = f"{folder}/{stage}-{fingerprint}-{self.run_id}"
            build().write.mode("overwrite").parquet(path)
            self.record((stage, fingerprint, path))
        return self.spark.read.parquet(path)

    def step(self, stage: str, fingerprint: str, do: Callable[[], object], path: str) -> None:
        """A stage that changes tables in place and may be repeated; left out when its newest entry is of these inputs."""
        if self.done(stage, fingerprint) is None:
            do()
            self.record((stage, fingerprint, path))


def current_tables(spark: SparkSession, out: str) -> dict[str, str]:
    """The folder of the current version of each table of a warehouse folder: name -> path."""
    log = _entries(spark, f"{out.rstrip('/')}/run_log").where(F.col("stage").startswith("publish:"))
    newest = log.groupBy(F.substring_index("stage", ":", -1).alias("name")).agg(F.max_by("path", "at_micros").alias("path"))
    return {r["name"]: r["path"] for r in newest.collect()}  # a row a table


__all__ = ["RunLog", "current_tables"]
