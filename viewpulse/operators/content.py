"""Viewing-log operators (content side).

Input rows: ``Contract, AppName, TotalDuration, Date``.  The day-level steps
work on all days at once (one job, grouped by ``Contract, Date``) instead of
one plan per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewpulse import schemas as S
from viewpulse.functions.content import MASK_BITS, app_type, day_code, most_watched, most_watched_of, taste, taste_of


def with_type(df: DataFrame) -> DataFrame:
    """AppName -> Type; drop unknown apps and the garbage contract ``'0'``.

    ``Contract != '0'`` also drops NULL contracts (NULL comparison is not true).
    Output: ``Contract, Type, TotalDuration`` plus ``Date`` when present.
    """
    keep = ["Date"] if "Date" in df.columns else []
    typed = df.select("Contract", app_type("AppName").alias("Type"), "TotalDuration", *keep)
    return typed.where((F.col("Contract") != F.lit("0")) & F.col("Type").isNotNull())


def daily_pivot(df: DataFrame) -> DataFrame:
    """Per ``(Contract, Date)``: summed duration of each of the five Types.

    A Type without rows that day is NULL (not 0).  Conditional sums give the
    same rows as ``pivot("Type", TYPES)`` with a fixed schema and one shuffle,
    and the partial aggregate shrinks a hot contract before the exchange.
    """
    sums = [F.sum(F.when(F.col("Type") == F.lit(t), F.col("TotalDuration"))).alias(t) for t in S.TYPES]
    return df.groupBy("Contract", "Date").agg(*sums)


def with_most_watch(df: DataFrame) -> DataFrame:
    """Add ``MostWacth`` (sic): the day's most watched Type."""
    return df.withColumn("MostWacth", most_watched())


def with_taste(df: DataFrame) -> DataFrame:
    """Add ``Taste``: the Types watched that day, '-'-joined."""
    return df.withColumn("Taste", taste())


def activity_label(active_days, threshold: int = S.ACTIVE_DAYS_THRESHOLD) -> "F.Column":
    """'High' when a contract was active on more than ``threshold`` days, else 'Low'."""
    return F.when(active_days > F.lit(threshold), F.lit("High")).otherwise(F.lit("Low"))


def with_activity(df: DataFrame, threshold: int = S.ACTIVE_DAYS_THRESHOLD) -> DataFrame:
    """Row-level activity: ``Active_Count`` = active days of the contract, ``Active`` High/Low.

    The window is partitioned by Contract over day rows, so a partition holds
    at most one row per day of the window.
    """
    w = Window.partitionBy("Contract")
    return df.withColumn("Active_Count", F.count("Date").over(w)).withColumn(
        "Active", activity_label(F.col("Active_Count"), threshold)
    )


def daily_profile(log: DataFrame) -> DataFrame:
    """W-16..W-19 composed: one row per (Contract, Date) with Type sums, MostWacth, Taste."""
    return with_taste(with_most_watch(daily_pivot(with_type(log))))


def profile_from_daily(daily: DataFrame, threshold: int = S.ACTIVE_DAYS_THRESHOLD) -> DataFrame:
    """Fold day rows into one row per Contract.

    Totals are sums over days; ``MostWacth``/``Taste`` come from the earliest
    day, kept as the smallest of (day, code of the day's answer) in one number, so that day rows are hashed and not sorted;
    ``Active`` counts the days.  The activity window is folded into this aggregate.
    """
    code_bits = MASK_BITS + 3
    first = F.min(F.shiftleft(F.unix_date("Date").cast("long"), code_bits) + day_code()).alias("first")
    folded = daily.groupBy("Contract").agg(
        *[F.sum(F.col(f"`{t}`")).alias(S.total_col(t)) for t in S.TYPES], first, F.count("Date").alias("days"))
    code = F.col("first").bitwiseAND((1 << code_bits) - 1)
    return folded.select("Contract", *S.TOTAL_COLS, most_watched_of(code).alias("MostWacth"), taste_of(code).alias("Taste"),
                         activity_label(F.col("days"), threshold).alias("Active"))
