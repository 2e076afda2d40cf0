"""Per-day partials that follow their files: a day whose files changed is built again, and no other.

The streams of ``viewpulse.streaming`` read a file once and never look at it again.  Here a log's files are listed, each
day has a fingerprint of their names, sizes and times, and days whose fingerprint isn't the one that their
partials were built from are read and their partition replaced.  A day that vanished stops counting.  Each day has one
partition however often it changes, so nothing has to be compacted.

``<partials>/rows`` holds the partials by day, ``<partials>/days`` a line for each build: the day and its fingerprint.
A build that dies before its line is written is repeated.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse.operators import content as C
from viewpulse.sources import logs as L
from viewpulse.sources.checked import day_of
from viewpulse.sources.files import list_files, path_exists
from viewpulse.streaming.ingest import search_partials

DAYS_SCHEMA = "at_micros long, day date, fingerprint string"

#: kind -> (day column, reader, partial aggregate)
KINDS: dict[str, tuple[str, Callable, Callable]] = {
    "search": ("log_date", L.read_search_log, search_partials),
    "content": ("Date", L.read_content_log, lambda log: C.daily_pivot(C.with_type(log))),
}


def day_fingerprints(spark: SparkSession, root: str, kind: str, layout: str = "daily", start=None, end=None) -> DataFrame:
    """``day, fingerprint`` of the days of ``[start, end]`` that are there, from a listing alone."""
    files = list_files(spark, L.day_paths(spark, root, start, end, kind, layout))
    h = F.xxhash64("path", F.unix_micros("modificationTime"), "length")
    state = [F.count("*"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(h, 32)), F.bit_xor(h)]
    return files.groupBy(day_of(F.col("path")).alias("day")).agg(F.concat_ws("-", *state).alias("fingerprint")).where("day IS NOT NULL")


def built_days(spark: SparkSession, partials: str) -> DataFrame:
    """``day, fingerprint`` of the days with partials; a fingerprint of NULL is a day that vanished."""
    path = f"{partials.rstrip('/')}/days"
    if not path_exists(spark, path):
        return spark.createDataFrame([], "day date, fingerprint string")
    lines = spark.read.schema(DAYS_SCHEMA).option("recursiveFileLookup", "true").json(path)
    last = lines.groupBy("day").agg(F.max(F.struct("at_micros", F.struct("fingerprint").alias("state"))).alias("last"))
    return last.select("day", F.col("last.state.fingerprint").alias("fingerprint"))


def refresh_partials(spark: SparkSession, root: str, partials: str, kind: str, layout: str = "daily", start=None, end=None) -> list[_dt.date]:
    """Build the partials of new and changed days of ``[start, end]``, forget vanished ones; the days that were built."""
    column, read, aggregate = KINDS[kind]
    partials = partials.rstrip("/")
    first, last = (F.lit(L.as_date(d)) if d else None for d in (start, end))
    known = built_days(spark, partials)
    known = known.where((F.col("day") >= first) if first is not None else F.lit(True)).where((F.col("day") <= last) if last is not None else F.lit(True))
    both = day_fingerprints(spark, root, kind, layout, start, end).join(known.withColumnRenamed("fingerprint", "before"), "day", "full_outer")
    moved = both.where(~F.col("fingerprint").eqNullSafe(F.col("before"))).select("day", "fingerprint")
    changes = {r["day"]: r["fingerprint"] for r in moved.collect()}  # days of a window
    if not changes:
        return []
    days = sorted(d for d, f in changes.items() if f is not None)
    if days:
        # of the range, only the changed days' folders are read
        rows = read(spark, root, days[0], days[-1], layout, days=days)
        aggregate(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(f"{partials}/rows")
    at = time.time_ns() // 1000
    lines = spark.createDataFrame([(at, d, f) for d, f in changes.items()], DAYS_SCHEMA)
    lines.coalesce(1).write.json(f"{partials}/days/{uuid.uuid4().hex}")
    return days


def live_days(spark: SparkSession, partials: str) -> list[_dt.date]:
    """The days whose partials count."""
    return [r["day"] for r in built_days(spark, partials).where("fingerprint IS NOT NULL").collect()]  # days of the log
