"""The six marketing reports over the fact table (W-31..W-37).

Each report reads the newest snapshot that has rows of its ``data_source``, and no other: a snapshot
holds two months already, so older ones would add other months' volumes and states that have passed.  A
profile that is in both logs by now, or that left the newest snapshot, doesn't count.
Profiles seen in both logs are left out by default (the report contract);
``include_both=True`` counts them too.  The key of the newest snapshot (``newest``, see ``newest_snapshot``) is a
literal that prunes the fact's partitions; only over a fact that isn't a table partitioned by it is the key
a scalar subquery.

The fact has one row a profile in a snapshot (W-29), so users are counted without a shuffle by
profile: one aggregate by the report's keys, which combines map-side.  Shares are windows over the already aggregated
report rows (a few dozen rows at most, bounded by the key domains).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewpulse import schemas as S
from viewpulse.functions.dates import date_key, yyyymmdd_to_date


def _sources(source: str, include_both: bool) -> Column:
    """The report's profiles: one source (default), or also the profiles seen in both logs."""
    if include_both:
        return F.col("data_source").isin(source, S.SOURCE_BOTH)
    return F.col("data_source") == F.lit(source)


PARTITION_OF_KEY = re.compile(r"/snapshot_date_key=(\d+)/")


def partition_keys(fact: DataFrame) -> list[int] | None:
    """The snapshot keys of a fact read from a table partitioned by them, from its file names alone; else None."""
    keys = [PARTITION_OF_KEY.search(f) for f in fact.inputFiles()]
    return sorted({int(k[1]) for k in keys}) if keys and all(keys) else None


def newest_snapshot(fact: DataFrame, source: str, include_both: bool = False) -> int | None:
    """The newest snapshot key with rows of the source, found from partition values.

    Keys are few (one a load); a key is opened only to see whether it holds such rows.
    """
    keys = partition_keys(fact)
    if keys is None:
        keys = sorted(r[0] for r in fact.select("snapshot_date_key").distinct().collect())
    for key in reversed(keys):
        if not fact.where((F.col("snapshot_date_key") == key) & _sources(source, include_both)).isEmpty():
            return key
    return None


def _newest(fact: DataFrame, source: str, include_both: bool, newest: int | None) -> Column:
    if newest is None and partition_keys(fact):
        newest = newest_snapshot(fact, source, include_both)
        return F.lit(newest).cast("long")  # NULL when no snapshot has the source: an empty report
    if newest is not None:
        return F.lit(newest).cast("long")
    return fact.where(_sources(source, include_both)).agg(F.max("snapshot_date_key").cast("long").alias("m")).scalar()


def _window_cols(max_key: Column) -> dict[str, Column]:
    max_d = yyyymmdd_to_date(max_key)
    min_d = F.trunc(F.add_months(max_d, -1), "MM")
    return {
        "max_date": max_key,
        "min_date": date_key(min_d).cast("long"),
        "max_day_of_month": F.dayofmonth(max_d).cast("long"),
        "days_in_prev_month": F.dayofmonth(F.last_day(min_d)).cast("long"),
    }


def report_window(fact: DataFrame, source: str = S.SOURCE_CONTENT, newest: int | None = None) -> DataFrame:
    """W-31: one row ``data_source, max_date, min_date, max_day_of_month, days_in_prev_month``."""
    one = fact.sparkSession.range(1).select(_newest(fact, source, False, newest).alias("max_date"))
    return one.select(F.lit(source).alias("data_source"), *[c.alias(n) for n, c in _window_cols(F.col("max_date")).items()])


def _scoped(fact: DataFrame, source: str, include_both: bool, newest: int | None) -> tuple[DataFrame, dict[str, Column]]:
    """The source's rows of its newest snapshot, and the window's columns."""
    key = _newest(fact, source, include_both, newest)
    return fact.where(_sources(source, include_both) & (F.col("snapshot_date_key") == key)), _window_cols(key)


def with_service(f: DataFrame, dim: DataFrame) -> DataFrame:
    # The service dimension is the constant 7-row table: broadcast is bounded.
    d = dim.select("service_key", F.col("category_group").alias("CategoryGroup"), F.col("Type").alias("Category"))
    return f.join(F.broadcast(d), "service_key", "inner")


def pct(num: Column, den: Column) -> Column:
    return F.round(num * F.lit(100.0) / F.nullif(den, F.lit(0)), 2)


def _users(f: DataFrame, keys: list[str], flags: dict[str, Column] | None = None) -> DataFrame:
    """Users per ``keys`` (+ users satisfying each flag); a row is a user."""
    return f.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("TongUser"), *[F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in (flags or {}).items()])


def category_loyalty(fact: DataFrame, dim: DataFrame, source: str = S.SOURCE_CONTENT,
                     include_both: bool = False, newest: int | None = None) -> DataFrame:
    """W-32: per (CategoryGroup, Category): users, loyal (High) users, at-risk (Low) users, % loyal."""
    f, _ = _scoped(fact, source, include_both, newest)
    f = with_service(f, dim)
    agg = _users(
        f,
        ["CategoryGroup", "Category"],
        {"UserTrungThanh": F.col("Active") == "High", "UserNguyCo": F.col("Active") == "Low"},
    )
    return agg.select(
        "CategoryGroup", "Category", "TongUser", "UserTrungThanh", "UserNguyCo",
        pct(F.col("UserTrungThanh"), F.col("TongUser")).alias("TiLe_TrungThanh"),
    )


def category_taste(fact: DataFrame, dim: DataFrame, source: str = S.SOURCE_CONTENT,
                   include_both: bool = False, newest: int | None = None) -> DataFrame:
    """W-33: per (CategoryGroup, Category, Taste): users and their share within the Category."""
    f, _ = _scoped(fact, source, include_both, newest)
    f = with_service(f.where(F.col("Taste").isNotNull()), dim)
    agg = _users(f, ["CategoryGroup", "Category", "Taste"])
    share = pct(F.col("TongUser"), F.sum("TongUser").over(Window.partitionBy("Category")))
    return agg.select("CategoryGroup", "Category", "Taste", "TongUser", share.alias("PhanTram_TrongCategory"))


def power_vs_casual(fact: DataFrame, dim: DataFrame, source: str = S.SOURCE_CONTENT,
                    include_both: bool = False, newest: int | None = None) -> DataFrame:
    """W-34: per (Active, CategoryGroup, Category): users and their share within the Active group."""
    f, _ = _scoped(fact, source, include_both, newest)
    f = with_service(f, dim).withColumnRenamed("Active", "UserType")
    agg = _users(f, ["UserType", "CategoryGroup", "Category"])
    share = pct(F.col("TongUser"), F.sum("TongUser").over(Window.partitionBy("UserType")))
    return agg.select("UserType", "CategoryGroup", "Category", "TongUser", share.alias("PhanTram_TrongNhom"))


def genre_bucket(taste: Column) -> Column:
    """Number of genres in a Taste string -> bucket label ('' counts as one)."""
    genres = F.size(F.split(taste, "-"))
    return F.element_at(F.array(*[F.lit(b) for b in S.DIVERSITY_BUCKETS]), F.least(genres, F.lit(len(S.DIVERSITY_BUCKETS))))


def taste_diversity(fact: DataFrame, source: str = S.SOURCE_CONTENT, include_both: bool = False, newest: int | None = None) -> DataFrame:
    """W-35: per (genre-count bucket, Active): users and share of all users in the report.

    The grand total is a window over the aggregated rows, whose count is
    bounded by 4 buckets x the Active values.
    """
    f, _ = _scoped(fact, source, include_both, newest)
    f = f.where(F.col("Taste").isNotNull()).withColumn("SoTheLoaiXem", genre_bucket(F.col("Taste")))
    agg = _users(f, ["SoTheLoaiXem", "Active"])
    share = pct(F.col("TongUser"), F.sum("TongUser").over(Window.partitionBy()))
    return agg.select("SoTheLoaiXem", "Active", "TongUser", share.alias("PhanTram"))


def search_growth(fact: DataFrame, source: str = S.SOURCE_SEARCH, include_both: bool = False, newest: int | None = None) -> DataFrame:
    """W-36: per previous-month category: search volumes of both months, daily run
    rates (current month over its elapsed days, previous over its length), growth %.

    ``count_curr`` is summed under ``category_prev`` (report contract).
    """
    f, w = _scoped(fact, source, include_both, newest)
    f = f.where(F.col("category_prev").isNotNull() & F.col("category_curr").isNotNull())
    agg = f.groupBy(F.col("category_prev").alias("Category")).agg(
        F.sum("count_prev").alias("sp"), F.sum("count_curr").alias("sc")
    )
    rate_curr = F.col("sc") / F.nullif(w["max_day_of_month"], F.lit(0))
    rate_prev = F.col("sp") / F.nullif(w["days_in_prev_month"], F.lit(0))
    growth = (rate_curr - rate_prev) * F.lit(100.0) / F.nullif(rate_prev, F.lit(0.0))
    return agg.select(
        "Category",
        F.col("sp").cast("long").alias("LuotTimKiem_ThangTruoc"),
        F.col("sc").cast("long").alias("LuotTimKiem_ThangNay"),
        F.round(rate_curr, 2).alias("TB_MoiNgay_ThangNay"),
        F.round(rate_prev, 2).alias("TB_MoiNgay_ThangTruoc"),
        F.round(growth, 2).alias("PhanTram_TangTruong"),
    )


def interest_migration(fact: DataFrame, source: str = S.SOURCE_SEARCH, include_both: bool = False, newest: int | None = None) -> DataFrame:
    """W-37: users who changed category: (from, to) users and share of the leavers of ``from``."""
    f, _ = _scoped(fact, source, include_both, newest)
    f = f.where(
        (F.col("Trending_Type") == "Changed")
        & F.col("category_prev").isNotNull()
        & F.col("category_curr").isNotNull()
    ).select(F.col("category_prev").alias("RoiKhoi"), F.col("category_curr").alias("ChuyenSang"))
    agg = _users(f, ["RoiKhoi", "ChuyenSang"])
    share = pct(F.col("TongUser"), F.sum("TongUser").over(Window.partitionBy("RoiKhoi")))
    return agg.select("RoiKhoi", "ChuyenSang", "TongUser", share.alias("PhanTram_RoiKhoi"))


def content_reports(fact: DataFrame, dim: DataFrame, include_both: bool = False, newest: int | None = None) -> dict[str, DataFrame]:
    """The four viewing reports, each over the ``log_content`` window."""
    kw = {"include_both": include_both, "newest": newest}
    return {
        "olap_category_loyalty": category_loyalty(fact, dim, **kw),
        "olap_category_taste": category_taste(fact, dim, **kw),
        "olap_power_vs_casual": power_vs_casual(fact, dim, **kw),
        "olap_taste_diversity": taste_diversity(fact, **kw),
    }


def search_reports(fact: DataFrame, include_both: bool = False, newest: int | None = None) -> dict[str, DataFrame]:
    """The two search reports, each over the ``log_search`` window."""
    kw = {"include_both": include_both, "newest": newest}
    return {"olap_search_growth": search_growth(fact, **kw), "olap_interest_migration": interest_migration(fact, **kw)}


def all_reports(fact: DataFrame, dim: DataFrame, include_both: bool = False) -> dict[str, DataFrame]:
    """All six, with the newest snapshot of each source looked up once."""
    content = newest_snapshot(fact, S.SOURCE_CONTENT, include_both)
    search = newest_snapshot(fact, S.SOURCE_SEARCH, include_both)
    return {**content_reports(fact, dim, include_both, content), **search_reports(fact, include_both, search)}


# Presentation order of each report (applied when reading a report, not stored).
REPORT_ORDER = {
    "olap_category_loyalty": [("TiLe_TrungThanh", False)],
    "olap_category_taste": [("Category", True), ("PhanTram_TrongCategory", False)],
    "olap_power_vs_casual": [("UserType", True), ("TongUser", False)],
    "olap_taste_diversity": [("SoTheLoaiXem", True)],
    "olap_search_growth": [("PhanTram_TangTruong", False)],
    "olap_interest_migration": [("TongUser", False)],
}


def ordered(report: DataFrame, name: str) -> DataFrame:
    """A report in its presentation order (reports are a few dozen rows)."""
    return report.orderBy(*[F.asc(c) if up else F.desc(c) for c, up in REPORT_ORDER[name]])
