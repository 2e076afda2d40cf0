"""One callable per work item: ``(spark, sf_dir) -> DataFrame`` over the test tables.

Inputs are the adapters of ``sources.testdata`` (derived by Spark from the
given tables), with the snapshot window 2022-06-01 .. 2022-07-14.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewpulse import schemas as S
from viewpulse.functions.dates import in_window, month_before
from viewpulse.operators import content as C
from viewpulse.operators import keywords as K
from viewpulse.operators import reports as R
from viewpulse.operators import search as Q
from viewpulse.operators import star as ST
from viewpulse.operators import user_sets as U
from viewpulse.plans import dimensions as DIM
from viewpulse.plans import profiles as P
from viewpulse.plans.daily_run import run_snapshot
from viewpulse.plans.partials import live_days, refresh_partials
from viewpulse.plans.warehouse import load_table
from viewpulse.sources import checked as CH
from viewpulse.sources import dictionary as D
from viewpulse.sources import logs as L
from viewpulse.sources import testdata as TD
from viewpulse.streaming import content_profile_from_partials, search_profile_from_partials

END = TD.SNAPSHOT_END
START = TD.WINDOW_START
SNAPSHOT = ST.snapshot_key(END)
#: The newest day of another month's snapshot, and a later run whose window holds only July.
OLDER, LATER = _dt.date(2022, 6, 30), _dt.date(2022, 8, 15)

# Page parameters for the keyword page at test scale (64 distinct keywords).
DEEP_PAGE = dict(limit_prev=20, offset_prev=30, limit_curr=300, offset_curr=500, shallow=100)
PAGE = dict(limit_prev=20, offset_prev=5, limit_curr=40, offset_curr=5)


def _search_log(spark, sf):
    return TD.search_log(spark, sf).where(F.col("log_date").between(F.lit(START), F.lit(END)))


def _content_log(spark, sf):
    return TD.content_log(spark, sf).where(F.col("Date").between(F.lit(START), F.lit(END)))


def _clean(spark, sf):
    return Q.clean_search(_search_log(spark, sf))


def _counts(spark, sf):
    return Q.keyword_counts(Q.with_period(_clean(spark, sf), END))


def _pairs(spark, sf):
    return P.search_pairs(_search_log(spark, sf), END, START)


def _search_profile(spark, sf, with_device=False):
    return P.build_search_profile(_search_log(spark, sf), TD.keyword_map(spark, sf), END, START, with_device)


def _content_profile(spark, sf):
    return P.build_content_profile(_content_log(spark, sf), START, END)


def _obt(spark, sf):
    return ST.build_obt(_search_profile(spark, sf, with_device=True), _content_profile(spark, sf))


def _fact(spark, sf):
    return ST.build_fact(_obt(spark, sf), ST.dim_service(spark), SNAPSHOT)


def _page(spark, sf):
    return Q.page_keywords(_pairs(spark, sf), **PAGE)


# Rules that the test keywords hit, one keyword by two of them.
RULES = [("blue|gizmo", "Music"), ("old", "Drama"), ("ring$", "Sports")]


def _all_keywords(spark, sf):
    pairs = _pairs(spark, sf)
    return pairs.select(F.explode(F.array("most_searched_prev", "most_searched_curr")).alias("keyword")).distinct()


def _classified(spark, sf):
    return K.classify(_all_keywords(spark, sf), RULES)


def _two_snapshots(spark, sf):
    """A fact table with the snapshots of 20220630 and 20220714, each built from its own window and loaded."""
    path = f"{L.fresh_root(spark, 'two-snapshots')}/fact_customer_360"
    for end in (OLDER, END):
        start = month_before(end)
        search = in_window(TD.search_log(spark, sf), "log_date", start, end)
        content = in_window(TD.content_log(spark, sf), "Date", start, end)
        obt = ST.build_obt(P.build_search_profile(search, TD.keyword_map(spark, sf), end, start, True), P.build_content_profile(content, start, end))
        load_table(ST.build_fact(obt, ST.dim_service(spark), ST.snapshot_key(end)), path, "append")
    return spark.read.parquet(path)


def _daily_logs(spark, sf):
    """The raw search log in the daily layout, one folder of parquet a day, in the shared folder."""
    root = L.fresh_root(spark, "daily_search")
    TD.search_log(spark, sf).withColumn("day", F.date_format("log_date", "yyyyMMdd")).drop("log_date").write.partitionBy("day").parquet(f"{root}/by_day")
    for day in L.days_on_disk(spark, f"{root}/by_day", "search", "hive"):  # a few dozen days, each a copy of one partition
        spark.read.parquet(f"{root}/by_day/day={day:%Y%m%d}").write.parquet(f"{root}/days/{day:%Y%m%d}")
    return f"{root}/days"


def _drifted_logs(spark, sf):
    """The raw search log with days of three kinds: times as seconds since 1970, no device columns, and the usual columns."""
    root = L.fresh_root(spark, "drifted_search")
    log = TD.search_log(spark, sf)
    kind = F.dayofmonth("log_date") % 3
    seconds = F.unix_timestamp(F.col("log_date").cast("timestamp")) + F.length("keyword")
    log.where(kind == 0).withColumn("datetime", seconds).write.mode("append").partitionBy("log_date").parquet(root)
    log.where(kind == 1).drop("proxy_isp", "platform", "networkType").write.mode("append").partitionBy("log_date").parquet(root)
    log.where(kind == 2).write.mode("append").partitionBy("log_date").parquet(root)
    return root


def _damaged_content(spark, sf):
    """The raw content log as wrapped JSON lines with a field that no schema knows; some lines are cut off, some durations are words."""
    root = L.fresh_root(spark, "damaged_content")
    log = TD.content_log(spark, sf)
    duration = F.when(F.col("TotalDuration") % 89 == 0, F.lit("long")).otherwise(F.col("TotalDuration").cast("string"))
    inner = F.struct("Contract", "AppName", duration.alias("TotalDuration"), F.concat(F.lit("mac-"), "Contract").alias("Mac"))
    line = F.to_json(F.struct(F.lit("history").alias("_index"), inner.alias("_source")))
    cut = F.when(F.col("TotalDuration") % 97 == 0, F.substring(line, F.lit(1), F.length(line) - 3)).otherwise(line)
    log.select(cut.alias("value"), "Date").write.partitionBy("Date").text(root)
    return root


def _content_damage(spark, sf):
    """Per day: good records, quarantined lines by reason, and values of the unknown field."""
    root = _damaged_content(spark, sf)
    good = CH.read_content_envelope(spark, root, START, END, "hive")
    per_day = good.groupBy(F.col("Date").alias("day")).agg(
        F.count("*").alias("n_good"), F.sum("TotalDuration").alias("duration"),
        F.count_distinct(F.try_variant_get("doc", "$.Mac", "string")).alias("n_macs"))
    bad = CH.read_content_log_checked(spark, root, START, END, "hive").quarantine
    reasons = bad.groupBy("day").agg(*[F.count_if(F.col("reason") == r).alias(n) for r, n in (("not JSON", "n_cut"), ("TotalDuration is no whole number", "n_worded"))])
    return per_day.join(reasons, "day", "full_outer").select("day", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_good", "duration", "n_macs", "n_cut", "n_worded")])


def _window(spark, sf):
    logs = TD.search_log(spark, sf).select(F.col("log_date").alias("d")).unionByName(
        TD.content_log(spark, sf).select(F.col("Date").alias("d"))
    )
    return L.latest_date(logs, "d")


def _loaded_fact(spark, sf):
    """W-30: load the fact twice under the same snapshot (a rerun) and read the table back.

    As in the daily run, either load builds the fact from the written profiles.
    """
    root = L.fresh_root(spark, "loaded")
    path = f"{root}/fact_customer_360"
    _search_profile(spark, sf, with_device=True).write.parquet(f"{root}/search_profile")
    _content_profile(spark, sf).write.parquet(f"{root}/content_profile")
    for _ in range(2):
        search, content = (spark.read.parquet(f"{root}/{n}_profile") for n in ("search", "content"))
        fact = ST.build_fact(ST.build_obt(search, content), ST.dim_service(spark), SNAPSHOT)
        load_table(fact, path, "append")
    return spark.read.parquet(path).select(*fact.columns)


def _daily_runs(spark, sf, *ends):
    """W-38: a whole daily run over the staged raw logs for each date, into a warehouse of its own; its tables after the last run."""
    root, own = L.stage_logs(spark, sf), L.fresh_root(spark, "daily-run")
    D.write_keyword_map(TD.keyword_map(spark, sf), f"{own}/mapping")
    for end in ends:
        tables = run_snapshot(spark, f"{root}/log_search", f"{root}/log_content", f"{own}/mapping", f"{own}/warehouse", end=end, layout="hive", resume=False).tables
    return tables


def _daily_run_table(name, *ends):
    def run(spark, sf):
        path = _daily_runs(spark, sf, *(ends or (END,)))[name]
        return DIM.read_dimension(spark, path) if name in ("dim_user", "dim_cust", "dim_date") else spark.read.parquet(path)

    return run


def _user_states(spark, sf, fact):
    """The states of a fact's users, written and read back: the reports see nothing else."""
    path = L.fresh_root(spark, "user-states")
    U.user_states(fact, U.number_users(fact)).write.parquet(path)
    return spark.read.parquet(path)


def _by_days(spark, sf, kind):
    """A profile from per-day partials, after a later state of the log replaced some of its days."""
    root, own = L.fresh_root(spark, f"changing_{kind}"), L.fresh_root(spark, f"days_{kind}")
    log, day = (TD.search_log(spark, sf), "log_date") if kind == "search" else (TD.content_log(spark, sf), "Date")
    write = lambda df: getattr(df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day), "parquet" if kind == "search" else "json")(root)
    repeated = log.where(F.dayofmonth(day) % 4 == 0)
    write(log.unionByName(repeated))  # first some days have their rows twice, and are then replaced
    refresh_partials(spark, root, own, kind, "hive", START, END)
    write(repeated)
    refresh_partials(spark, root, own, kind, "hive", START, END)
    days = live_days(spark, own)
    if kind == "search":
        return search_profile_from_partials(spark, f"{own}/rows", TD.keyword_map(spark, sf), END, START, with_device=False, days=days)
    return content_profile_from_partials(spark, f"{own}/rows", START, END, days=days)


def _coverage(spark, sf):
    """After runs for two dates: fact rows of each snapshot and source, and how many find their user, customer and day."""
    tables = _daily_runs(spark, sf, END, LATER)
    fact = spark.read.parquet(tables["fact_customer_360"]).select("Profile_ID", "data_source", "snapshot_date_key")
    users, custs, days = (DIM.read_dimension(spark, tables[n]) for n in ("dim_user", "dim_cust", "dim_date"))
    found = (fact.join(users.select("Profile_ID", F.lit(1).alias("user")), "Profile_ID", "left")
             .join(custs.select("Profile_ID", F.lit(1).alias("cust")), "Profile_ID", "left")
             .join(days.select(F.col("date_key").alias("snapshot_date_key"), F.lit(1).alias("day")), "snapshot_date_key", "left"))
    return found.groupBy("snapshot_date_key", "data_source").agg(
        F.count("*").alias("n_rows"), *[F.count(c).alias(f"n_{c}s") for c in ("user", "cust", "day")])


def build() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    q["scan_search_log"] = lambda s, sf: L.staged_search_log(s, sf, START, END)
    q["scan_content_log"] = lambda s, sf: L.staged_content_log(s, sf, START, END)
    q["latest_log_date"] = _window
    q["clean_search_log"] = lambda s, sf: _clean(s, sf).select("user_id", "keyword", "log_date", "month")
    q["split_months"] = lambda s, sf: Q.with_period(_clean(s, sf), END).select("user_id", "keyword", "month", "period")
    q["user_keyword_counts"] = _counts
    q["top_keyword_per_user"] = lambda s, sf: Q.top_keywords(_counts(s, sf))
    q["prev_curr_keywords"] = lambda s, sf: Q.pair_periods(Q.top_keywords(_counts(s, sf)))
    q["keyword_popularity"] = lambda s, sf: Q.keyword_popularity(_pairs(s, sf))
    q["keyword_page"] = _page
    q["classify_keywords"] = lambda s, sf: _classified(s, sf)
    q["merge_keyword_map"] = lambda s, sf: K.merge_map(TD.keyword_map(s, sf), _classified(s, sf))
    q["map_categories"] = lambda s, sf: Q.map_categories(_pairs(s, sf), TD.keyword_map(s, sf))
    q["category_shift"] = lambda s, sf: Q.category_shift(Q.map_categories(_pairs(s, sf), TD.keyword_map(s, sf)))
    q["search_profile"] = _search_profile
    q["app_to_type"] = lambda s, sf: C.with_type(_content_log(s, sf))
    q["content_daily_pivot"] = lambda s, sf: C.daily_pivot(C.with_type(_content_log(s, sf)))
    q["most_watched_type"] = lambda s, sf: C.with_most_watch(C.daily_pivot(C.with_type(_content_log(s, sf))))
    q["customer_taste"] = lambda s, sf: C.daily_profile(_content_log(s, sf))
    q["active_days"] = lambda s, sf: C.with_activity(C.daily_profile(_content_log(s, sf)))
    q["content_profile"] = _content_profile
    q["user_device"] = lambda s, sf: Q.user_device(_search_log(s, sf))
    q["obt_full_outer"] = _obt
    q["dim_user"] = lambda s, sf: ST.dim_user(_search_profile(s, sf, with_device=True))
    q["dim_cust"] = lambda s, sf: ST.dim_cust(_content_profile(s, sf))
    q["dim_date"] = lambda s, sf: ST.dim_date_for_window(_window(s, sf))
    q["fact"] = _fact
    q["load_snapshot"] = _loaded_fact
    q["report_window"] = lambda s, sf: R.report_window(_two_snapshots(s, sf), S.SOURCE_CONTENT)
    q["olap_category_loyalty"] = lambda s, sf: R.category_loyalty(_fact(s, sf), ST.dim_service(s), newest=SNAPSHOT)
    q["olap_category_taste"] = lambda s, sf: R.category_taste(_fact(s, sf), ST.dim_service(s), newest=SNAPSHOT)
    q["olap_power_vs_casual"] = lambda s, sf: R.power_vs_casual(_fact(s, sf), ST.dim_service(s), newest=SNAPSHOT)
    q["olap_taste_diversity"] = lambda s, sf: R.taste_diversity(_fact(s, sf), newest=SNAPSHOT)
    q["olap_search_growth"] = lambda s, sf: R.search_growth(_fact(s, sf), newest=SNAPSHOT)
    q["olap_interest_migration"] = lambda s, sf: R.interest_migration(_fact(s, sf), newest=SNAPSHOT)
    q["category_loyalty_two_snapshots"] = lambda s, sf: R.category_loyalty(_two_snapshots(s, sf), ST.dim_service(s))
    q["power_vs_casual_two_snapshots"] = lambda s, sf: R.power_vs_casual(_two_snapshots(s, sf), ST.dim_service(s))
    q["taste_diversity_two_snapshots"] = lambda s, sf: R.taste_diversity(_two_snapshots(s, sf))
    q["search_growth_two_snapshots"] = lambda s, sf: R.search_growth(_two_snapshots(s, sf))
    q["interest_migration_two_snapshots"] = lambda s, sf: R.interest_migration(_two_snapshots(s, sf))
    q["scan_search_log_daily"] = lambda s, sf: L.read_search_log(s, _daily_logs(s, sf), start=START)
    q["scan_search_log_drifted"] = lambda s, sf: CH.read_search_log_checked(s, _drifted_logs(s, sf), START, END, "hive").rows
    q["scan_content_log_damaged"] = _content_damage
    q["map_categories_split"] = lambda s, sf: Q.map_categories_split(_pairs(s, sf), TD.keyword_map(s, sf), Q.hot_keywords(_pairs(s, sf), 1 / 32))
    q["keyword_page_deep"] = lambda s, sf: Q.page_keywords(_pairs(s, sf), **DEEP_PAGE)
    q["user_sets_loyalty"] = lambda s, sf: U.category_loyalty(_user_states(s, sf, _fact(s, sf)), ST.dim_service(s), [SNAPSHOT])
    q["user_sets_migration"] = lambda s, sf: U.interest_migration(_user_states(s, sf, _fact(s, sf)), [SNAPSHOT])
    q["user_sets_over_snapshots"] = lambda s, sf: U.category_taste(
        _user_states(s, sf, _two_snapshots(s, sf)), ST.dim_service(s), [ST.snapshot_key(OLDER), SNAPSHOT])
    q["search_profile_by_days"] = lambda s, sf: _by_days(s, sf, "search")
    q["content_profile_by_days"] = lambda s, sf: _by_days(s, sf, "content")
    q["daily_run"] = _daily_run_table("olap_category_loyalty")
    for name in ("fact_customer_360", "dim_user", "dim_cust", "dim_date", "olap_category_taste", "olap_power_vs_casual", "olap_taste_diversity",
                 "olap_search_growth", "olap_interest_migration"):
        q[f"daily_run_{name}"] = _daily_run_table(name)
    for name in ("dim_user", "dim_cust", "dim_date"):
        q[f"{name}_after_two_runs"] = _daily_run_table(name, END, LATER)
    q["fact_coverage_after_two_runs"] = _coverage
    return q
