"""Keyword dictionary I/O: a ``keyword,category`` CSV with a header, all strings."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from viewpulse import schemas as S


def read_keyword_map(spark: SparkSession, path: str) -> DataFrame:
    """Read the dictionary (empty when the path does not exist yet)."""
    try:
        return spark.read.schema(S.KEYWORD_MAP_SCHEMA).option("header", True).csv(path)
    except AnalysisException:
        from viewpulse.sources.logs import empty_frame

        return empty_frame(spark, S.KEYWORD_MAP_SCHEMA)


def write_keyword_map(df: DataFrame, path: str) -> None:
    """Write a dictionary version.  Write to a new path, never to the one being read."""
    df.select("keyword", "category").write.mode("overwrite").option("header", True).csv(path)
