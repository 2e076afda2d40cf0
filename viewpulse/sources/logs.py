"""Raw log readers (W-01, W-02) and the data-driven window (W-03).

Two on-disk layouts are read:

* ``daily`` - the operational layout: search log as one folder of parquet
  per day (``root/YYYYMMDD/*.parquet``), content log as one JSON-lines file
  per day (``root/YYYYMMDD.json``).  One listing of the root gives its days;
  those of the requested range, either side of which may be open, become a
  single glob, so one scan reads them and nothing else.
* ``hive`` - date-partitioned folders (``log_date=YYYY-MM-DD`` /
  ``Date=YYYY-MM-DD``), where the range filter prunes partitions.

A missing day is skipped in both; a missing root folder raises.

Both readers use fixed schemas (no inference pass).  A content row may be
wrapped in an ``_source`` envelope; flat and wrapped rows can be mixed.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewpulse import schemas as S
from viewpulse.functions.dates import as_date, in_window, month_before, month_start_before

SEARCH_DAY_IN_PATH = r"/(\d{8})/[^/]+$"
CONTENT_DAY_IN_PATH = r"/(\d{8})\.json(/[^/]+)?$"


def days_between(spark: SparkSession, root: str, start, end, kind: str, layout: str = "daily") -> list[_dt.date]:
    """The days of ``[start, end]`` that are there; either side may be open."""
    first, last = as_date(start) if start else _dt.date.min, as_date(end) if end else _dt.date.max
    return [d for d in days_on_disk(spark, root, kind, layout) if first <= d <= last]


def day_path(root: str, day: _dt.date, kind: str, layout: str = "daily") -> str:
    """Where a day's rows are: a folder, or the JSON file of a day in the daily layout."""
    if layout == "hive":
        return f"{root.rstrip('/')}/{'Date' if kind == 'content' else 'log_date'}={day:%Y-%m-%d}"
    return f"{root.rstrip('/')}/{day:%Y%m%d}{'.json' if kind == 'content' else ''}"


def day_paths(spark: SparkSession, root: str, start, end, kind: str, layout: str = "daily") -> list[str]:
    return [day_path(root, d, kind, layout) for d in days_between(spark, root, start, end, kind, layout)]


def _day_files(spark: SparkSession, root: str, start, end, kind: str, chosen: list[_dt.date] | None = None) -> str | None:
    """A glob of the days of ``[start, end]`` that are there (either side may be open); None when there is none."""
    suffix = ".json" if kind == "content" else ""
    days = [d.strftime("%Y%m%d") for d in days_between(spark, root, start, end, kind) if chosen is None or d in chosen]
    return f"{root.rstrip('/')}/{{{','.join(days)}}}{suffix}" if days else None


def root_exists(spark: SparkSession, root: str) -> bool:
    """Whether the folder itself is there (asked through Spark's file system layer)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _require_root(spark: SparkSession, root: str) -> None:
    """A day may be missing, the log itself may not: a mistyped path must not look like an empty log."""
    if not root_exists(spark, root):
        raise FileNotFoundError(f"no such log folder: {root}")


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed empty DataFrame (no rows, no Python-side data)."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


SEARCH_OUT_SCHEMA = T.StructType(S.SEARCH_LOG_FIELDS + [T.StructField("log_date", T.DateType())])
CONTENT_OUT_SCHEMA = T.StructType(S.CONTENT_FIELDS + [T.StructField("Date", T.DateType())])


def _chosen(df: DataFrame, day_col: str, days: list[_dt.date] | None) -> DataFrame:
    return df if days is None else df.where(F.col(day_col).isin(days))


def read_search_log(spark: SparkSession, root: str, start=None, end=None, layout: str = "daily", days: list[_dt.date] | None = None) -> DataFrame:
    """W-01: search-log rows of every existing day in ``[start, end]`` (of ``days`` only, when given).

    Output: ``user_id, keyword, datetime, proxy_isp, platform, networkType, log_date``.
    """
    _require_root(spark, root)
    if layout == "hive":
        df = spark.read.schema(SEARCH_OUT_SCHEMA).parquet(root)
        return _chosen(in_window(df, "log_date", start, end), "log_date", days).select(*SEARCH_OUT_SCHEMA.fieldNames())
    files = _day_files(spark, root, start, end, "search", days)
    if files is None:
        return empty_frame(spark, SEARCH_OUT_SCHEMA)
    df = spark.read.schema(S.SEARCH_LOG_SCHEMA).parquet(files)
    day = F.try_to_date(F.regexp_extract(F.col("_metadata.file_path"), SEARCH_DAY_IN_PATH, 1), "yyyyMMdd")
    return df.select(*S.SEARCH_LOG_SCHEMA.fieldNames(), day.alias("log_date"))


def unwrap_content() -> list:
    """Each row is wrapped as a whole or not at all, so a field missing inside is NULL."""
    wrapped = F.col("_source").isNotNull()
    return [F.when(wrapped, F.col("_source")[f.name]).otherwise(F.col(f.name)).alias(f.name) for f in S.CONTENT_FIELDS]


def read_content_log(spark: SparkSession, root: str, start=None, end=None, layout: str = "daily", days: list[_dt.date] | None = None) -> DataFrame:
    """W-02: content-log rows of every existing day in ``[start, end]`` (of ``days`` only, when given), ``_source`` unwrapped.

    Output: ``Contract, AppName, TotalDuration, Date``.
    """
    _require_root(spark, root)
    if layout == "hive":
        schema = T.StructType(S.CONTENT_FILE_SCHEMA.fields + [T.StructField("Date", T.DateType())])
        df = _chosen(in_window(spark.read.schema(schema).json(root), "Date", start, end), "Date", days)
        return df.select(*unwrap_content(), "Date")
    files = _day_files(spark, root, start, end, "content", days)
    if files is None:
        return empty_frame(spark, CONTENT_OUT_SCHEMA)
    df = spark.read.schema(S.CONTENT_FILE_SCHEMA).json(files)
    day = F.try_to_date(F.regexp_extract(F.col("_metadata.file_path"), CONTENT_DAY_IN_PATH, 1), "yyyyMMdd")
    return df.select(*unwrap_content(), day.alias("Date"))


def latest_date(df: DataFrame, date_col: str = "log_date") -> DataFrame:
    """W-03: one row ``max_date, window_start`` (first day of the month before ``max_date``)."""
    m = df.agg(F.max(date_col).alias("max_date"))
    return m.select("max_date", month_start_before(F.col("max_date")).alias("window_start"))


def days_on_disk(spark: SparkSession, root: str, kind: str = "search", layout: str = "daily") -> list[_dt.date]:
    """The days present under a raw-log root: one listing of the root's own entries, no file below them.

    Days come back to the driver, at most one entry a day of history.
    """
    _require_root(spark, root)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    names = [s.getPath().getName() for s in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]
    pattern = r"(?:log_date|Date|day)=(\d{4})-?(\d{2})-?(\d{2})" if layout == "hive" else r"(\d{4})(\d{2})(\d{2})" + ("" if kind == "search" else r"\.json")
    days = []
    for name in names:
        if m := re.fullmatch(pattern, name):
            try:
                days.append(_dt.date(*map(int, m.groups())))
            except ValueError:  # eight digits that are no day
                continue
    return sorted(days)


def resolve_window(spark: SparkSession, search_root: str | None, content_root: str | None,
                   start=None, end=None, layout: str = "daily") -> tuple[_dt.date, _dt.date] | None:
    """Explicit dates win; a missing ``end`` is the newest day on disk over both
    logs, a missing ``start`` the first day of the month before ``end``."""
    if end is None:
        days = [days_on_disk(spark, root, kind, layout)[-1:] for root, kind in ((search_root, "search"), (content_root, "content")) if root]
        newest = [d for own in days for d in own]
        if not newest:
            return None
        end = max(newest)
    end = as_date(end)
    return (month_before(end) if start is None else as_date(start)), end


# --- staging of the test adapters (for the scan queries) ---------------------------

_STAGED: dict[str, str] = {}


def fresh_root(spark: SparkSession, name: str) -> str:
    """A folder of the shared storage that nobody else uses."""
    from viewpulse.session import shared_dir

    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def open_days(spark: SparkSession, days: int) -> Iterator[None]:
    """Writes by day that keep a file open for each of up to ``days`` days, so that a task doesn't sort its rows by day first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, "0")
    spark.conf.set(name, str(max(int(before), days)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stage_logs(spark: SparkSession, sf_dir: str) -> str:
    """Write the test-data adapters as date-partitioned raw logs in the shared folder, once for each state of the tables."""
    from viewpulse.sources import testdata as TD
    from viewpulse.sources.files import fingerprint, path_exists

    state = fingerprint(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in TD.TABLES])
    if state not in _STAGED or not path_exists(spark, _STAGED[state]):
        root = fresh_root(spark, "staged")
        with open_days(spark, 64):  # the logs have 44 and 31 days
            TD.search_log(spark, sf_dir).write.partitionBy("log_date").parquet(f"{root}/log_search")
            TD.content_log(spark, sf_dir).write.partitionBy("Date").json(f"{root}/log_content")
        _STAGED[state] = root
    return _STAGED[state]


def staged_search_log(spark: SparkSession, sf_dir: str, start, end) -> DataFrame:
    root = stage_logs(spark, sf_dir)
    return read_search_log(spark, f"{root}/log_search", start, end, layout="hive")


def staged_content_log(spark: SparkSession, sf_dir: str, start, end) -> DataFrame:
    root = stage_logs(spark, sf_dir)
    return read_content_log(spark, f"{root}/log_content", start, end, layout="hive")
