"""Helpers shared by the operators: shared-folder tables, hashing columns, text columns."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which every executor sees.

    Only a local session, which has a single disk, gets a temporary folder when
    the setting is missing; on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="viewpulse-shared-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back, which ends its lineage.

    A lost executor costs the reader nothing, and every later use sees the same rows.
    """
    path = f"{shared_folder(df.sparkSession)}/viewpulse-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def crc_remainder(col: str, modulus: int) -> Column:
    """crc32 of the value written as text, modulo ``modulus`` (null for null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % modulus


def ends_of_runs(changes):
    """(starts, ends) of the runs that a boolean array of first-of-run flags describes."""
    import numpy as np

    starts = np.flatnonzero(changes)
    return starts, np.append(starts[1:], len(changes))


def concat_ranges(starts, lengths):
    """Indices of the ranges ``[starts[i], starts[i] + lengths[i])``, one after another."""
    import numpy as np

    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)
