"""Dimensions that grow with the fact (W-24, W-25, W-27): new attributes replace old ones by key, old keys stay.

The fact keeps every snapshot, so a dimension row must outlive the run that brought it.  A dimension is a
parquet table partitioned by a hash of its key; an upsert finds the rows that are new or changed,
and rewrites the partitions that hold them, no others.

The new partitions are written whole to a staging folder first.  Only then do they replace the old
ones, which is repeatable: a run that dies in between is finished from the staged copy.  (The changes are staged too, since they
can't be found again once a part of them is in place.)
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse.plans.runlog import RunLog

BUCKET = re.compile(r"bucket_of_(\d+)")


def _bucket_column(df: DataFrame) -> str | None:
    return next((c for c in df.columns if BUCKET.fullmatch(c)), None)


def read_dimension(spark: SparkSession, path: str) -> DataFrame | None:
    """The dimension's rows without their partition column; None when there is no such table yet."""
    table = _stored(spark, path)
    return None if table is None else table.drop(_bucket_column(table))


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def changed_rows(old: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The rows of ``updates`` whose key is new or whose attributes differ; attributes may be NULL."""
    attributes = [c for c in updates.columns if c != key]
    before = old.select(key, F.struct(F.lit(True).alias("known"), *attributes).alias("_before"))
    same = F.lit(True)
    for c in attributes:
        same = same & F.col(c).eqNullSafe(F.col(f"_before.{c}"))
    return updates.join(before, key, "left").where(F.col("_before").isNull() | ~same).drop("_before")


def merged_rows(old: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """All rows of both, those of ``updates`` where both have the key.  Keys are unique on either side."""
    return updates.unionByName(old.select(*updates.columns).join(updates.select(key), key, "left_anti"))


def upsert_dimension(updates: DataFrame, path: str, log: RunLog, fingerprint: str, stage_dir: str, key: str = "Profile_ID",
                     buckets: int = 64) -> int:
    """Merge ``updates`` (one row a key; rows without a key are left out) into the table at ``path``; the number of rewritten
    partitions (of a new table: all).

    ``buckets`` is for a new table; one that is there keeps its own number.  Pick it so that a
    partition is some hundred MB, as each is written by one task.
    """
    spark = updates.sparkSession
    name = path.rstrip("/").rsplit("/", 1)[-1]
    old = _stored(spark, path)
    b = (_bucket_column(old) if old is not None else None) or f"bucket_of_{buckets}"
    n = int(BUCKET.fullmatch(b)[1])
    updates = updates.where(F.col(key).isNotNull()).withColumn(b, F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))

    if old is None:  # nothing to lose: a first load that died is loaded again
        updates.repartition(F.col(b)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(b).parquet(path)
        return n
    changed = log.table(f"{name}-changes", fingerprint, lambda: changed_rows(old, updates, key), stage_dir)
    touched = [r[0] for r in changed.select(b).distinct().collect()]  # at most one a partition
    if touched:
        rows = merged_rows(old.where(F.col(b).isin(touched)), changed, key)
        staged = log.table(f"{name}-partitions", fingerprint, lambda: rows.repartition(F.col(b)), stage_dir)
        staged.repartition(F.col(b)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(b).parquet(path)
    return len(touched)
