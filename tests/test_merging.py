"""Deep pages, mergeable user sets, per-day partials that follow changed files, hot keywords."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from fixtures import END, START
from test_io_run import _write_daily_logs
from test_plans import _fact_of
from viewpulse import schemas as S
from viewpulse.operators import reports as R
from viewpulse.operators import search as Q
from viewpulse.operators import star as ST
from viewpulse.operators import user_sets as U
from viewpulse.operators.paging import page
from viewpulse.plans.daily_run import run_snapshot
from viewpulse.plans.partials import live_days, refresh_partials


def _rows(df):
    return sorted(map(str, df.collect()))


# --- pages -------------------------------------------------------------------------


def test_page_at_an_offset_in_the_millions(spark):
    df = spark.range(0, 2_500_000, 1, 8).select((-F.col("id") % 1000).alias("score"), F.col("id"))
    got = page(df, [F.desc("score"), F.asc("id")], 2_100_000, 5, rows_per_range=200_000)
    assert [r["_rank"] for r in got.orderBy("_rank").collect()] == list(range(2_100_000, 2_100_005))
    # scores are 0 to -999, 2,500 rows each, so rank 2,100,000 is the first row of score -840
    assert [(r.score, r.id) for r in got.orderBy("_rank").collect()] == [(-840, 840 + 1000 * i) for i in range(5)]
    # no range, and so no task, is much larger than asked for
    assert got.select(F.input_file_name().alias("f")).distinct().count() <= 8 * 2


def test_pages_at_the_edges(spark):
    df = spark.range(100).select("id")
    take = lambda o, n: [r.id for r in page(df, [F.asc("id")], o, n, rows_per_range=7).orderBy("_rank").collect()]
    assert take(0, 3) == [0, 1, 2] and take(6, 9) == list(range(6, 15)) and take(98, 10) == [98, 99] and take(100, 5) == [] and take(5, 0) == []
    assert page(df.limit(0), [F.asc("id")], 0, 5).collect() == []
    pairs = spark.createDataFrame([(f"u{i}", f"p{i % 50}", i % 9, f"c{i % 70}", 1) for i in range(400)],
                                  "user_id string, most_searched_prev string, count_prev long, most_searched_curr string, count_curr long")
    how = dict(limit_prev=10, offset_prev=20, limit_curr=60, offset_curr=200)
    assert _rows(Q.page_keywords(pairs, **how, shallow=16)) == _rows(Q.page_keywords(pairs, **how))


# --- user sets ---------------------------------------------------------------------


def test_numbers_are_dense_and_kept(spark):
    ids = lambda lo, hi: spark.range(lo, hi).select(F.concat(F.lit("p"), "id").alias("Profile_ID"))
    first = U.number_users(ids(0, 500).union(ids(0, 100)), slots=7)
    assert sorted(r.user_no for r in first.collect()) == list(range(1, 501))
    second = U.number_users(ids(400, 900), first)
    both = dict(map(tuple, second.collect()))
    assert sorted(both.values()) == list(range(1, 901)) and all(both[r[0]] == r[1] for r in first.collect())
    assert U.number_users(ids(0, 0)).collect() == [] and U.number_users(ids(0, 10), first).count() == 500


def test_reports_from_states_equal_reports_from_the_fact(spark, scratch):
    rows = []
    for key in (20220630, 20220714):
        for i in range(300):
            if (i + key) % 5:
                rows.append((f"p{i}", (S.SOURCE_CONTENT, S.SOURCE_SEARCH, S.SOURCE_BOTH)[i % 3], key, {
                    "service_key": 1 + i % 4 if i % 7 else None, "Active": ("High", "Low", None)[(i // 3 + key) % 3], "Taste": ("A", "A-B", "", None)[i // 5 % 4],
                    "category_prev": ("x", "y", None)[i // 2 % 3], "category_curr": ("y", "z")[i // 4 % 2], "Trending_Type": ("Changed", "Unchanged")[i // 6 % 2]}))
    fact, dim = _fact_of(spark, f"{scratch}/f", rows), ST.dim_service(spark)
    U.user_states(fact, U.number_users(fact)).write.parquet(f"{scratch}/states")
    states = spark.read.parquet(f"{scratch}/states")
    newest = [20220714]
    pairs = [(U.category_loyalty(states, dim, newest), R.category_loyalty(fact, dim)), (U.category_taste(states, dim, newest), R.category_taste(fact, dim)),
             (U.power_vs_casual(states, dim, newest), R.power_vs_casual(fact, dim)), (U.taste_diversity(states, newest), R.taste_diversity(fact)),
             (U.interest_migration(states, newest), R.interest_migration(fact))]
    for own, plain in pairs:
        assert plain.count() and _rows(own.select(*plain.columns)) == _rows(plain)
    # over both snapshots each user counts once
    both = U.count_users(states.where(F.col("data_source") == S.SOURCE_CONTENT), ["Active"])
    want = fact.where(F.col("data_source") == S.SOURCE_CONTENT).groupBy("Active").agg(F.count_distinct("Profile_ID").alias("TongUser"))
    assert _rows(both) == _rows(want)
    merged = U.merge_states(states, ["data_source"])
    assert _rows(U.count_users(merged, ["data_source"])) == _rows(fact.groupBy("data_source").agg(F.count_distinct("Profile_ID").alias("TongUser")))


def test_sets_of_many_users(spark):
    """Numbers beyond one bitmap's 32,768."""
    users = spark.range(100_000).select(F.col("id").cast("string").alias("Profile_ID"))
    fact = users.select("Profile_ID", F.lit(20220714).alias("snapshot_date_key"), *[F.lit("a").alias(c) if c != "service_key" else F.lit(1).alias(c) for c in U.CELL])
    states = U.user_states(fact, U.number_users(users))
    assert states.count() == 4 and U.count_users(states, ["Active"]).first()["TongUser"] == 100_000


# --- per-day partials --------------------------------------------------------------


def test_a_rewritten_day_gives_the_full_runs_answer(spark, scratch):
    _write_daily_logs(spark, scratch)
    run = lambda out, **kw: run_snapshot(spark, f"{scratch}/search", f"{scratch}/content", f"{scratch}/map/mapping.csv", f"{scratch}/{out}", end="20220714", **kw)
    days = dict(incremental_dir=f"{scratch}/inc", incremental_mode="days")
    same = lambda a, b: all(_rows(spark.read.parquet(a.tables[n])) == _rows(spark.read.parquet(b.tables[n])) for n in ("fact_customer_360", "olap_search_growth"))
    assert same(run("full1"), run("days1", **days))
    with open(f"{scratch}/content/20220602.json", "w") as f:  # a day is written anew, another vanishes
        f.write(json.dumps({"Contract": "NEW", "AppName": "VOD", "TotalDuration": 3}) + "\n")
    os.rename(f"{scratch}/content/20220603.json", f"{scratch}/moved.json")
    built = refresh_partials(spark, f"{scratch}/content", f"{scratch}/inc/content_days", "content", "daily", START, END)
    assert built == [dt.date(2022, 6, 2)] and dt.date(2022, 6, 3) not in live_days(spark, f"{scratch}/inc/content_days")
    assert refresh_partials(spark, f"{scratch}/content", f"{scratch}/inc/content_days", "content", "daily", START, END) == []
    os.rename(f"{scratch}/moved.json", f"{scratch}/content/20220603.json")  # and comes back, found by the run itself
    assert same(run("full2"), run("days2", **days))


# --- hot keywords ------------------------------------------------------------------


def test_a_hot_keyword_is_split(spark):
    n = 20_000
    pairs = spark.range(n).select(F.concat(F.lit("u"), "id").alias("user_id"),
                                  F.when(F.col("id") % 10 < 3, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("most_searched_prev"), F.lit(1).cast("long").alias("count_prev"),
                                  F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 499)).alias("most_searched_curr"), F.lit(2).cast("long").alias("count_curr"))
    kmap = spark.range(997).select(F.concat(F.lit("k"), "id").alias("keyword"), F.concat(F.lit("c"), F.col("id") % 7).alias("category")).union(spark.createDataFrame([("hot", "H"), ("hot", "Z")], "keyword string, category string"))
    hot = Q.hot_keywords(pairs, 1 / 64)
    assert hot == ["hot"]
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        split = Q.map_categories_split(pairs, kmap, hot, parts=64)
        assert _rows(split) == _rows(Q.map_categories(pairs, kmap))
        sides = Q._by_side(pairs).withColumn("part", F.when(F.col("keyword").isin(hot), F.pmod(F.xxhash64("user_id", "side"), F.lit(64)).cast("int")).otherwise(0))
        tasks = sorted(r["count"] for r in sides.where("keyword IS NOT NULL").repartition(8, "keyword", "part").groupBy(F.spark_partition_id()).count().collect())
        assert tasks[-1] <= 2 * tasks[len(tasks) // 2]
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert Q.hot_keywords(pairs.limit(0)) == [] and Q.map_categories_split(pairs.limit(0), kmap, []).count() == 0
