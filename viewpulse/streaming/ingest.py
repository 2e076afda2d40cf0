"""File-source streams that write per-day partial aggregates, and the
profile builders that read them.

Partial tables are partitioned by ``batch_id`` and then by day; a replayed
micro-batch overwrites its own folder, so the sink is idempotent
(exactly-once with the stream checkpoint), and the window filter of a
profile build prunes the day partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from viewpulse import schemas as S
from viewpulse.functions.text import clean_keyword, search_month
from viewpulse.operators import content as C
from viewpulse.operators import search as Q
from viewpulse.functions.dates import in_window
from viewpulse.plans.profiles import DEVICE_COLS, SEARCH_PROFILE_COLS, top_pairs
from viewpulse.sources.logs import CONTENT_DAY_IN_PATH, SEARCH_DAY_IN_PATH, empty_frame, root_exists, unwrap_content


# A backlog (first run over history) is split into micro-batches of at most
# this many files; ``availableNow`` then runs them one after another.
MAX_FILES_PER_BATCH = 10_000


def _write_batch(path: str, day_col: str):
    def sink(batch: DataFrame, batch_id: int) -> None:
        # one folder per batch (a replay overwrites only itself), split by day for window pruning
        batch.write.mode("overwrite").partitionBy(day_col).parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    return sink


def _check_state(spark: SparkSession, partials: str, checkpoint: str) -> None:
    """Partials without their checkpoint would be counted again: all files would be read anew beside them."""
    if root_exists(spark, partials) and not root_exists(spark, checkpoint):
        raise ValueError(f"{partials} has no stream checkpoint at {checkpoint}: restore it, or start with new partials")


def _partials(spark: SparkSession, path: str, fields: list[tuple[str, str]]) -> DataFrame:
    """The written partials; a log without any file yet has none."""
    schema = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])
    if not root_exists(spark, path):
        return empty_frame(spark, schema)
    return spark.read.schema(schema).parquet(path)


def _start(stream: DataFrame, transform, partials: str, checkpoint: str, name: str | None,
           day_col: str) -> StreamingQuery:
    sink = _write_batch(partials, day_col)
    w = stream.writeStream.foreachBatch(lambda df, bid: sink(transform(df), bid))
    w = w.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    return w.start()


# ---- content ---------------------------------------------------------------------


def _content_stream(spark: SparkSession, root: str, layout: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if layout == "hive":
        schema = T.StructType(S.CONTENT_FILE_SCHEMA.fields + [T.StructField("Date", T.DateType())])
        return reader.schema(schema).json(root).select(*unwrap_content(), "Date")
    src = reader.schema(S.CONTENT_FILE_SCHEMA).json(f"{root.rstrip('/')}/*.json")
    day = F.try_to_date(F.regexp_extract(F.col("_metadata.file_path"), CONTENT_DAY_IN_PATH, 1), "yyyyMMdd")
    return src.select(*unwrap_content(), day.alias("Date"))


def ingest_content(spark: SparkSession, root: str, partials: str, checkpoint: str, layout: str = "daily",
                   max_files_per_trigger: int | None = MAX_FILES_PER_BATCH) -> StreamingQuery:
    """Stream new content-log files into ``(Contract, Date)`` partial Type sums."""
    _check_state(spark, partials, checkpoint)
    stream = _content_stream(spark, root, layout, max_files_per_trigger)
    return _start(stream, lambda b: C.daily_pivot(C.with_type(b)), partials, checkpoint, None, "Date")


def _live(df: DataFrame, day_col: str, days) -> DataFrame:
    return df if days is None else df.where(F.col(day_col).isin(list(days)))


def content_profile_from_partials(spark: SparkSession, partials: str, start=None, end=None,
                                  threshold: int = S.ACTIVE_DAYS_THRESHOLD, days=None) -> DataFrame:
    """W-21 from the partials (of ``days``, when given): merge the batches per day, then the usual day-to-contract fold."""
    p = in_window(_partials(spark, partials, [("Contract", "string"), *[(t, "bigint") for t in S.TYPES], ("Date", "date")]), "Date", start, end)
    p = _live(p, "Date", days)
    daily = p.groupBy("Contract", "Date").agg(*[F.sum(F.col(f"`{t}`")).alias(t) for t in S.TYPES])
    return C.profile_from_daily(C.with_taste(C.with_most_watch(daily)), threshold)


# ---- search ----------------------------------------------------------------------


def _search_stream(spark: SparkSession, root: str, layout: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    cols = S.SEARCH_LOG_SCHEMA.fieldNames()
    if layout == "hive":
        schema = T.StructType(S.SEARCH_LOG_FIELDS + [T.StructField("log_date", T.DateType())])
        return reader.schema(schema).parquet(root).select(*cols, "log_date")
    src = reader.schema(S.SEARCH_LOG_SCHEMA).parquet(f"{root.rstrip('/')}/*/")
    day = F.try_to_date(F.regexp_extract(F.col("_metadata.file_path"), SEARCH_DAY_IN_PATH, 1), "yyyyMMdd")
    return src.select(*cols, day.alias("log_date"))


def search_partials(batch: DataFrame) -> DataFrame:
    """Per (user, day, month, cleaned keyword): searches and the largest device struct.

    Keywords are cleaned here once; the length rule and the month-to-period
    tagging depend on the snapshot and are applied when the profile is built.
    """
    rows = batch.where(F.col("user_id").isNotNull()).select(
        "user_id",
        "log_date",
        F.when(F.col("keyword").isNotNull(), clean_keyword("keyword")).alias("keyword"),
        search_month("datetime").alias("month"),
        F.struct("log_date", *DEVICE_COLS).alias("dev"),
    )
    # the device is a grouping key first, so that raw rows are hashed and not sorted
    counted = rows.groupBy("user_id", "log_date", "month", "keyword", "dev").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("user_id", "log_date", "month", "keyword").agg(F.sum("n").alias("n"), F.max("dev").alias("dev"))


SEARCH_PARTIALS = [
    ("user_id", "string"), ("month", "int"), ("keyword", "string"), ("n", "bigint"),
    ("dev", "struct<log_date:date," + ",".join(f"{c}:string" for c in DEVICE_COLS) + ">"), ("log_date", "date"),
]


def ingest_search(spark: SparkSession, root: str, partials: str, checkpoint: str, layout: str = "daily",
                  max_files_per_trigger: int | None = MAX_FILES_PER_BATCH) -> StreamingQuery:
    """Stream new search-log files into per-day keyword partials."""
    _check_state(spark, partials, checkpoint)
    stream = _search_stream(spark, root, layout, max_files_per_trigger)
    return _start(stream, search_partials, partials, checkpoint, None, "log_date")


def search_profile_from_partials(spark: SparkSession, partials: str, kmap: DataFrame, end_date, start_date=None,
                                 with_device: bool = True, min_len: int = S.MIN_KEYWORD_LENGTH, days=None) -> DataFrame:
    """W-15 from the partials (of ``days``, when given): same two-level aggregate as the batch build."""
    p = _live(in_window(_partials(spark, partials, SEARCH_PARTIALS), "log_date", start_date, end_date), "log_date", days)
    period = F.when(F.length("keyword") >= F.lit(min_len), Q.period_of(F.col("month"), end_date))
    tagged = p.select("user_id", period.alias("period"), "keyword", "n", "dev").select(
        "user_id", "period", F.when(F.col("period").isNotNull(), F.col("keyword")).alias("keyword"), "n", "dev"
    )
    lvl1 = tagged.groupBy("user_id", "period", "keyword").agg(
        F.sum("n").alias("search_count"), F.max("dev").alias("dev")
    )
    pairs = top_pairs(lvl1, with_device=True)
    prof = Q.category_shift(Q.map_categories(pairs, kmap))
    return prof.select(*SEARCH_PROFILE_COLS, *(DEVICE_COLS if with_device else []))
