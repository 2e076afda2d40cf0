from pyspark.sql import functions as F

from fixtures import E1_EXPECTED, content_log
from viewpulse import schemas as S
from viewpulse.operators import content as C
from viewpulse.plans.profiles import build_content_profile


def test_content_profile_edges(spark):
    got = {r["Contract"]: tuple(r[1:]) for r in build_content_profile(content_log(spark)).collect()}
    assert got == E1_EXPECTED


def test_garbage_rows_dropped(spark):
    typed = C.with_type(content_log(spark))
    contracts = {r[0] for r in typed.select("Contract").distinct().collect()}
    assert "0" not in contracts and None not in contracts and "G1" not in contracts


def test_daily_pivot_fixed_schema(spark):
    # A day without a Type still has all five columns (NULL), never a missing column.
    daily = C.daily_pivot(C.with_type(content_log(spark)).where(F.col("Contract") == "B1"))
    assert daily.columns == ["Contract", "Date", *S.TYPES]
    r = daily.where(F.col("Date") == "2022-06-01").first()
    assert r["Giai Tri"] == 10 and r["Phim Truyen"] is None


def test_activity_window_matches_fold(spark):
    daily = C.daily_profile(content_log(spark))
    by_window = {r["Contract"]: r["Active"] for r in C.with_activity(daily).select("Contract", "Active").distinct().collect()}
    folded = {r["Contract"]: r["Active"] for r in C.profile_from_daily(daily).collect()}
    assert by_window == folded


def test_duration_conserved(spark):
    raw = C.with_type(content_log(spark)).agg(F.sum("TotalDuration")).first()[0]
    prof = build_content_profile(content_log(spark))
    total = prof.select(sum(F.coalesce(F.col(c), F.lit(0)) for c in S.TOTAL_COLS).alias("t")).agg(F.sum("t")).first()[0]
    assert raw == total


def test_activity_threshold_parameter(spark):
    low = {r["Contract"]: r["Active"] for r in build_content_profile(content_log(spark), threshold=4).collect()}
    assert low["C1"] == "High" and low["B1"] == "High" and low["A1"] == "Low"
    rows = C.with_activity(C.daily_profile(content_log(spark)), threshold=6).where(F.col("Contract") == "B1")
    assert {r["Active"] for r in rows.collect()} == {"Low"}
