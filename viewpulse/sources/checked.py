"""Raw logs read past damage: unreadable files, corrupt rows, and days whose columns differ.

**Search log.** A survey opens the footer of every Parquet file, in tasks, and reads nothing else.  Files that are not
Parquet go to quarantine.  The others are grouped by names and types of the columns that matter: each group is one read, its
columns are cast to the log's types, missing ones are NULL, and the groups are united.  The driver gets one row a
folder; files one by one only for folders that hold several groups or an unreadable file.

**Content log.** Lines are parsed to VARIANT, without an inference pass and without a fixed schema, so
that every field of a record can be asked for (``read_content_envelope``).  Lines that aren't JSON objects, and records whose duration
isn't a whole number, go to quarantine.

Quarantine rows are ``source, day, file, kind, reason, record``.  Times given as whole numbers are seconds since 1970 (milliseconds
from 100,000,000,000 on).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewpulse import schemas as S
from viewpulse.sources import logs as L
from viewpulse.sources.files import file_system, list_files

QUARANTINE_SCHEMA = "source string, day date, file string, kind string, reason string, record string"
UNREADABLE, CORRUPT = "unreadable file", "corrupt row"
DAY_IN_PATH = r"/(?:log_date=|Date=)?(\d{4})-?(\d{2})-?(\d{2})(?:\.json)?(?:/[^/]*)?$"


@dataclass
class CheckedLog:
    """The good rows of a log, and what was kept from them."""

    rows: DataFrame
    quarantine: DataFrame


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    """Quarantined files and rows by file: ``source, day, file, kind, n``."""
    return quarantine.groupBy("source", "day", "file", "kind").agg(F.count("*").alias("n"))


def keep_good(log: CheckedLog, path: str) -> DataFrame:
    """Write the quarantine to ``path`` (a second pass over a content log's lines) and go on with the good rows."""
    log.quarantine.write.mode("overwrite").parquet(path)
    return log.rows


def day_of(path: Column) -> Column:
    return F.try_to_date(F.concat(*[F.regexp_extract(path, DAY_IN_PATH, i) for i in (1, 2, 3)]), "yyyyMMdd")


# --- search log --------------------------------------------------------------------

TEXT_COLUMNS = S.SEARCH_LOG_SCHEMA.fieldNames()


def survey(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """``path, folder, columns, error`` of every Parquet file below ``paths``: names and types of ``columns`` from its footer."""
    wanted = set(columns)

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for b in batches:
            found, errors = [], []
            for uri in b.column(0).to_pylist():
                try:
                    system, path = file_system(uri)
                    with system.open_input_file(path) as f:
                        own = {x.name: x.type for x in pq.ParquetFile(f).schema_arrow if x.name in wanted}
                    nested = sorted(n for n, t in own.items() if pa.types.is_nested(t))
                    found.append(",".join(f"{n}:{own[n]}" for n in sorted(own)))
                    errors.append(f"nested columns: {', '.join(nested)}" if nested else None)
                except Exception as e:  # whatever is wrong with the file is the finding
                    found.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:500])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string()), pa.array(errors, pa.string())], names=["path", "columns", "error"])

    # opening a footer is slow and its file's size doesn't matter, so files are dealt out evenly
    tasks = max(1, spark.sparkContext.defaultParallelism)
    surveyed = list_files(spark, paths).select("path").repartition(tasks, "path").mapInArrow(footers, "path string, columns string, error string")
    return surveyed.withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]*$", 1))


def as_text(column: Column, kind: T.DataType) -> Column:
    """A user, keyword or device column of any simple type as text; whole doubles without their fraction."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        whole = (column == F.floor(column)) & (F.abs(column) < 1e15)
        return F.when(whole, column.cast("long").cast("string")).otherwise(column.cast("string"))
    return column.cast("string")


def as_time_text(column: Column, kind: T.DataType) -> Column:
    """A time column of any simple type as ``yyyy-MM-dd HH:mm:ss`` text; text stays as it is."""
    if isinstance(kind, T.IntegralType):
        n = column.cast("long")
        column = F.when(F.abs(n) >= 100_000_000_000, F.timestamp_millis(n)).otherwise(F.timestamp_seconds(n))
    elif not isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return as_text(column, kind)
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def conform(df: DataFrame) -> DataFrame:
    """Any day's rows in the search log's columns: typed casts, NULL for a column that isn't there."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cast = lambda n: (as_time_text if n == "datetime" else as_text)(F.col(n), types[n])
    return df.select(*[(cast(n) if n in types else F.lit(None).cast("string")).alias(n) for n in TEXT_COLUMNS],
                     day_of(F.col("_metadata.file_path")).alias("log_date"))


def read_search_log_checked(spark: SparkSession, root: str, start=None, end=None, layout: str = "daily") -> CheckedLog:
    """W-01 past damage: the readable files of ``[start, end]``, whatever columns their days have, and the others in quarantine."""
    paths = L.day_paths(spark, root, start, end, "search", layout)
    found = survey(spark, paths, TEXT_COLUMNS).cache() if paths else None
    none = L.empty_frame(spark, T._parse_datatype_string(QUARANTINE_SCHEMA))
    if found is None:
        return CheckedLog(L.empty_frame(spark, L.SEARCH_OUT_SCHEMA), none)
    bad = found.where("error IS NOT NULL")
    folders = found.groupBy("folder").agg(F.count_distinct("columns").alias("n"), F.any_value("columns").alias("columns"), F.count("error").alias("bad"))
    groups: dict[str, list[str]] = {}
    mixed = []
    for r in folders.collect():  # a row a folder of the window
        if r["n"] == 1 and not r["bad"]:
            groups.setdefault(r["columns"], []).append(r["folder"])
        else:
            mixed.append(r["folder"])
    if mixed:
        for r in found.where(F.col("folder").isin(mixed) & F.col("error").isNull()).select("path", "columns").collect():  # files of damaged folders
            groups.setdefault(r["columns"], []).append(r["path"])
    rows = L.empty_frame(spark, L.SEARCH_OUT_SCHEMA)
    for _, own in sorted(groups.items()):
        # the partition column of a folder isn't wanted, its day comes from the path
        rows = rows.unionByName(conform(spark.read.option("recursiveFileLookup", "true").parquet(*own)))
    quarantine = bad.select(F.lit("search").alias("source"), day_of(F.col("path")).alias("day"), F.col("path").alias("file"),
                            F.lit(UNREADABLE).alias("kind"), F.col("error").alias("reason"), F.lit(None).cast("string").alias("record"))
    return CheckedLog(rows, quarantine)


# --- content log -------------------------------------------------------------------


def _lines(spark: SparkSession, root: str, start, end, layout: str) -> DataFrame:
    """``record, file, Date, parsed, doc, reason`` of each line that isn't blank: the whole record, and the part inside its envelope."""
    paths = L.day_paths(spark, root, start, end, "content", layout)
    if not paths:
        return spark.range(0).select(F.lit("").alias("record"), F.lit("").alias("file"), F.current_date().alias("Date"),
                                     *[F.try_parse_json(F.lit("")).alias(c) for c in ("parsed", "doc")], F.lit("").alias("reason"))
    text = spark.read.option("recursiveFileLookup", "true").text(paths)
    file = F.col("_metadata.file_path")
    lines = text.where(F.trim("value") != "").select(F.col("value").alias("record"), file.alias("file"), day_of(file).alias("Date"), F.try_parse_json("value").alias("parsed"))
    inner = F.try_variant_get("parsed", "$._source", "variant")
    docs = lines.withColumn("doc", F.when(inner.isNotNull() & ~F.is_variant_null(inner), inner).otherwise(F.col("parsed")))
    number = lambda t: F.try_variant_get("doc", "$.TotalDuration", t)
    reason = (F.when(F.col("parsed").isNull(), "not JSON")
              .when(~F.schema_of_variant("doc").startswith("OBJECT"), "not an object")
              .when(number("string").isNotNull() & number("bigint").isNull(), "TotalDuration is no whole number"))
    return docs.withColumn("reason", reason)


def read_content_envelope(spark: SparkSession, root: str, start=None, end=None, layout: str = "daily") -> DataFrame:
    """Every good record of ``[start, end]``: ``Contract, AppName, TotalDuration, Date`` and the whole record as VARIANTs ``doc`` (its
    inside, where it is wrapped) and ``envelope``.  Any field: ``F.try_variant_get("doc", "$.Mac", "string")``."""
    fields = [F.try_variant_get("doc", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in S.CONTENT_FIELDS]
    return _lines(spark, root, start, end, layout).where("reason IS NULL").select(*fields, "Date", "doc", F.col("parsed").alias("envelope"))


def read_content_log_checked(spark: SparkSession, root: str, start=None, end=None, layout: str = "daily") -> CheckedLog:
    """W-02 past damage: the good records of ``[start, end]``, and the lines that are none in quarantine."""
    bad = _lines(spark, root, start, end, layout).where("reason IS NOT NULL").select(
        F.lit("content").alias("source"), F.col("Date").alias("day"), "file", F.lit(CORRUPT).alias("kind"), "reason", "record")
    return CheckedLog(read_content_envelope(spark, root, start, end, layout).select(*[f.name for f in S.CONTENT_FIELDS], "Date"), bad)
