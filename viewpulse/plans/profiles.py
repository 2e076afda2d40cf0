"""W-15 search profile and W-21 content profile: one scan and two aggregation shuffles each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewpulse import schemas as S
from viewpulse.functions.dates import in_window
from viewpulse.functions.text import clean_keyword, search_month
from viewpulse.operators import content as C
from viewpulse.operators import search as Q

SEARCH_PROFILE_COLS = [
    "user_id", "most_searched_prev", "count_prev", "most_searched_curr", "count_curr",
    "category_prev", "category_curr", "Trending_Type", "Previous",
]
DEVICE_COLS = ["proxy_isp", "platform", "networkType"]


def search_pairs(log: DataFrame, end_date, start_date=None, with_device: bool = False,
                 min_len: int = S.MIN_KEYWORD_LENGTH) -> DataFrame:
    """W-04..W-08 (and W-22 when ``with_device``) fused into two aggregates.

    Level 1 groups every windowed row of a known user by
    ``(user_id, period, keyword)``; rows that fail cleaning keep NULL period
    and keyword, so they still feed the device pick but no keyword count.
    Level 2 groups by ``user_id``: top keyword per period (largest count,
    smallest keyword) and the latest device.  Both levels combine map-side,
    so a hot user or keyword is reduced before its shuffle.
    """
    rows = in_window(log, "log_date", start_date, end_date).where(F.col("user_id").isNotNull())
    # Clean once per row; the second projection only reads the cleaned columns.
    dev = [F.struct("log_date", *DEVICE_COLS).alias("dev")] if with_device else []
    cleaned = rows.select(
        "user_id",
        F.when(F.col("keyword").isNotNull(), clean_keyword("keyword")).alias("kw"),
        search_month("datetime").alias("month"),
        *dev,
    )
    period = F.when(F.length("kw") >= F.lit(min_len), Q.period_of(F.col("month"), end_date))
    tagged = cleaned.select(
        "user_id", period.alias("period"), "kw", *(["dev"] if with_device else [])
    ).select("user_id", "period", F.when(F.col("period").isNotNull(), F.col("kw")).alias("keyword"),
             *(["dev"] if with_device else []))
    counts = F.count(F.lit(1)).alias("search_count")
    if not with_device:
        return top_pairs(tagged.groupBy("user_id", "period", "keyword").agg(counts))
    # The device is a grouping key of the first aggregate, whose buffer is then a
    # number: raw rows are hashed, not sorted.  Its few rows carry the maximum.
    per_day = tagged.groupBy("user_id", "period", "keyword", "dev").agg(counts)
    lvl1 = per_day.groupBy("user_id", "period", "keyword").agg(
        F.sum("search_count").alias("search_count"), F.max("dev").alias("dev"))

    return top_pairs(lvl1, with_device)


def top_pairs(lvl1: DataFrame, with_device: bool = False) -> DataFrame:
    """Level 2: per user the top keyword of each period (largest ``search_count``,
    smallest keyword) and the largest ``dev`` struct; users with both periods only.

    ``lvl1`` has ``user_id, period, keyword, search_count`` (+ ``dev``).
    """
    key = Q.rank_key(F.col("search_count"), F.col("keyword"))
    aggs = [
        F.min(F.when(F.col("period") == Q.PREV, key)).alias("bp"),
        F.min(F.when(F.col("period") == Q.CURR, key)).alias("bc"),
    ]
    if with_device:
        aggs.append(F.max("dev").alias("dev"))
    lvl2 = lvl1.groupBy("user_id").agg(*aggs)
    out = ["user_id", *Q.pair_columns(F.col("bp"), F.col("bc"))]
    if with_device:
        out += [F.col("dev").getField(c).alias(c) for c in DEVICE_COLS]
    return lvl2.where(F.col("bp").isNotNull() & F.col("bc").isNotNull()).select(*out)


def build_search_profile(log: DataFrame, kmap: DataFrame, end_date, start_date=None,
                         with_device: bool = False, min_len: int = S.MIN_KEYWORD_LENGTH) -> DataFrame:
    """W-15: search profile per user (plus device columns when ``with_device``)."""
    pairs = search_pairs(log, end_date, start_date, with_device, min_len)
    shifted = Q.category_shift(Q.map_categories(pairs, kmap))
    return shifted.select(*SEARCH_PROFILE_COLS, *(DEVICE_COLS if with_device else []))


def build_content_profile(log: DataFrame, start_date=None, end_date=None,
                          threshold: int = S.ACTIVE_DAYS_THRESHOLD) -> DataFrame:
    """W-21: per Contract the five duration totals, MostWacth, Taste and Active
    (High when active on more than ``threshold`` days)."""
    return C.profile_from_daily(C.daily_profile(in_window(log, "Date", start_date, end_date)), threshold)
