import datetime as dt
import json
import os

from pyspark.sql import functions as F

from fixtures import E1_ROWS, E2_MAP, E2_ROWS, END, START
from viewpulse.plans.daily_run import refresh_keyword_map, run_snapshot
from viewpulse.sources import dictionary as D
from viewpulse.sources import logs as L


def _write_daily_logs(spark, root):
    """Raw layout: search/YYYYMMDD/*.parquet and content/YYYYMMDD.json (mixed flat and _source rows)."""
    by_day = {}
    for i, (u, ts, kw) in enumerate(E2_ROWS):
        by_day.setdefault(ts[:10].replace("-", ""), []).append((u, kw, ts, f"isp{i % 2}", "box", "wifi"))
    for day, rows in by_day.items():
        spark.createDataFrame(rows, L.S.SEARCH_LOG_SCHEMA).write.parquet(f"{root}/search/{day}")
    os.makedirs(f"{root}/content", exist_ok=True)
    files = {}
    for i, (c, app, dur, day) in enumerate(E1_ROWS):
        rec = {"Contract": c, "AppName": app, "TotalDuration": dur}
        if i % 2:
            rec = {"_index": "history", "_id": str(i), "_source": rec}
        files.setdefault(day.strftime("%Y%m%d"), []).append(json.dumps(rec))
    for day, lines in files.items():
        with open(f"{root}/content/{day}.json", "w") as fh:
            fh.write("\n".join(lines) + "\n")
    os.makedirs(f"{root}/map", exist_ok=True)
    with open(f"{root}/map/mapping.csv", "w") as fh:
        fh.write("keyword,category\n" + "\n".join(f"{k},{c}" for k, c in E2_MAP) + "\n")


def test_read_daily_layout_range(spark, scratch):
    _write_daily_logs(spark, scratch)
    s = L.read_search_log(spark, f"{scratch}/search", "20220601", "20220630")
    days = {r[0] for r in s.select("log_date").distinct().collect()}
    assert min(days) == dt.date(2022, 6, 1) and max(days) <= dt.date(2022, 6, 30)
    assert s.count() == sum(1 for r in E2_ROWS if r[1].startswith("2022-06"))
    c = L.read_content_log(spark, f"{scratch}/content", "20220601", "20220603")
    assert c.count() == sum(1 for r in E1_ROWS if r[3] <= dt.date(2022, 6, 3))
    assert c.where(F.col("Contract").isNull()).count() == 1  # the NULL contract row, not unwrap failures
    empty = L.read_search_log(spark, f"{scratch}/search", "20210101", "20210102")
    assert empty.count() == 0 and empty.columns == list(L.SEARCH_OUT_SCHEMA.fieldNames())


def test_window_from_listing(spark, scratch):
    _write_daily_logs(spark, scratch)
    with open(f"{scratch}/search/README.txt", "w") as fh:  # a stray file must not break the listing
        fh.write("not a log\n")
    start, end = L.resolve_window(spark, f"{scratch}/search", f"{scratch}/content")
    assert (start, end) == (START, END.replace(day=6))  # newest day on disk: 2022-07-06
    assert L.resolve_window(spark, f"{scratch}/search", None, "20220601", "20220714") == (START, END)


def test_run_snapshot_end_to_end(spark, scratch):
    _write_daily_logs(spark, scratch)
    out = f"{scratch}/wh"
    res = run_snapshot(spark, f"{scratch}/search", f"{scratch}/content", f"{scratch}/map/mapping.csv", out,
                       end="20220714")
    assert res.snapshot_date_key == 20220714
    fact = spark.read.parquet(res.tables["fact_customer_360"])
    assert fact.count() == 10
    loyal = {tuple(r) for r in spark.read.parquet(res.tables["olap_category_loyalty"]).collect()}
    assert ("Entertainment", "Giai Tri", 2, 1, 1, 50.0) in loyal
    from viewpulse.plans.warehouse import register_views

    register_views(spark, res.tables)
    top = spark.sql("SELECT Category FROM olap_category_loyalty ORDER BY TiLe_TrungThanh DESC, Category LIMIT 1")
    assert top.first()[0] == "Giai Tri"
    assert spark.sql("SELECT count(*) FROM fact_customer_360 WHERE data_source = 'log_content'").first()[0] == 7
    # rerun is idempotent
    run_snapshot(spark, f"{scratch}/search", f"{scratch}/content", f"{scratch}/map/mapping.csv", out, end="20220714")
    assert spark.read.parquet(res.tables["fact_customer_360"]).count() == 10
    assert spark.read.parquet(res.tables["dim_date"]).count() == 61


def test_refresh_keyword_map(spark, scratch):
    _write_daily_logs(spark, scratch)
    log = L.read_search_log(spark, f"{scratch}/search", START, END)
    new = refresh_keyword_map(spark, log, END, f"{scratch}/map/mapping.csv", f"{scratch}/map/v2", START)
    got = {r[0]: r[1] for r in new.collect()}
    assert got["tom"] == "Animation"  # existing entry kept
    assert got["zzz"] == "Other" and got["love story"] == "Romance"
    assert D.read_keyword_map(spark, f"{scratch}/nowhere").count() == 0


def test_catalog_tables(spark, scratch):
    from fixtures import content_log, keyword_map, search_log
    from viewpulse.operators import star as ST
    from viewpulse.plans.profiles import build_content_profile, build_search_profile
    from viewpulse.plans.warehouse import load_table

    _write_daily_logs(spark, scratch)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS vp_test LOCATION '{scratch}/db'")
    args = (spark, f"{scratch}/search", f"{scratch}/content", f"{scratch}/map/mapping.csv", f"{scratch}/wh")
    run_snapshot(*args, end="20220714", database="vp_test")
    run_snapshot(*args, end="20220714", database="vp_test")  # rerun: same rows
    assert spark.table("vp_test.fact_customer_360").count() == 10
    # an older snapshot is appended next to the newest one
    sp = build_search_profile(search_log(spark), keyword_map(spark), END, START, with_device=True)
    older = ST.build_fact(ST.build_obt(sp, build_content_profile(content_log(spark))), ST.dim_service(spark), 20220630)
    load_table(older, f"{scratch}/wh/fact_customer_360", "append", table="vp_test.fact_customer_360")
    keys = {r[0]: r[1] for r in spark.table("vp_test.fact_customer_360").groupBy("snapshot_date_key").count().collect()}
    assert keys == {20220714: 10, 20220630: 10}
    assert spark.table("vp_test.olap_category_loyalty").count() == 3
    spark.sql("DROP DATABASE vp_test CASCADE")


def test_no_log_days(spark, scratch):
    import os

    os.makedirs(f"{scratch}/empty_s"), os.makedirs(f"{scratch}/empty_c")
    assert L.resolve_window(spark, f"{scratch}/empty_s", f"{scratch}/empty_c") is None
    assert run_snapshot(spark, f"{scratch}/empty_s", f"{scratch}/empty_c", f"{scratch}/none.csv", f"{scratch}/wh") is None
    assert L.read_content_log(spark, f"{scratch}/empty_c", "20220601", "20220714").count() == 0


def test_missing_roots_raise(spark, scratch):
    import pytest

    for read in (L.read_search_log, L.read_content_log):
        with pytest.raises(FileNotFoundError):
            read(spark, f"{scratch}/mistyped", "20220601", "20220714")
    with pytest.raises(FileNotFoundError):
        L.resolve_window(spark, f"{scratch}/mistyped", None)


def test_open_sided_ranges_in_both_layouts(spark, scratch):
    _write_daily_logs(spark, scratch)
    every = L.read_search_log(spark, f"{scratch}/search")
    every.write.partitionBy("log_date").parquet(f"{scratch}/hive")
    days = sorted(r[0] for r in every.select("log_date").distinct().collect())
    middle = days[len(days) // 2]
    for root, layout in ((f"{scratch}/search", "daily"), (f"{scratch}/hive", "hive")):
        seen = lambda **kw: {r[0] for r in L.read_search_log(spark, root, layout=layout, **kw).select("log_date").collect()}  # noqa: B023, E731
        assert seen(start=middle) == {d for d in days if d >= middle}
        assert seen(end=middle) == {d for d in days if d <= middle}
        assert L.resolve_window(spark, root, None, layout=layout)[1] == days[-1]


def test_refresh_adds_all_new_keywords(spark, scratch):
    from viewpulse.operators import keywords as K

    pairs = spark.createDataFrame([("a", "one", "two"), ("b", "three", "one"), ("c", "four", None)],
                                  "user_id string, most_searched_prev string, most_searched_curr string")
    known = spark.createDataFrame([("one", "Music")], "keyword string, category string")
    fresh = K.new_keywords(pairs, known)
    assert {r[0] for r in fresh.collect()} == {"two", "three", "four"}

    merged = K.merge_map(known, K.classify(fresh, rules=[("o", "Drama")]))
    assert {tuple(r) for r in merged.collect()} == {("one", "Music"), ("two", "Drama"), ("three", "Other"), ("four", "Drama")}
    assert K.new_keywords(pairs, merged).count() == 0


def test_replace_mode_keeps_one_snapshot(spark, scratch):
    _write_daily_logs(spark, scratch)
    args = (spark, f"{scratch}/search", f"{scratch}/content", f"{scratch}/map/mapping.csv", f"{scratch}/wh1")
    run_snapshot(*args, end="20220713", load_mode="replace")
    res = run_snapshot(*args, end="20220714", load_mode="replace")
    assert {r[0] for r in spark.read.parquet(res.tables["fact_customer_360"]).select("snapshot_date_key").distinct().collect()} == {20220714}
