"""Adapters that derive the two raw logs and a keyword dictionary from the
generated test tables (``events``, ``orders``, ``lineitem``, ``part``,
``customer``, ``nation``).  All three are plain Spark plans over the given
parquet files, so their size grows with the scale factor.

A-1 content log from ``events``; A-2 search log from orders x lineitem x part
(customer, nation for the device columns); A-3 keyword map from ``part``.
The comparison window they produce is 2022-06-01 .. 2022-07-14.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_END = _dt.date(2022, 7, 14)
WINDOW_START = _dt.date(2022, 6, 1)
#: The tables that the adapters read.
TABLES = ["events", "orders", "lineitem", "part", "customer", "nation"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _profile_id(key: Column) -> Column:
    s = key.cast("string")
    return F.when(key % 3 == 0, F.concat(F.lit("TV"), s)).otherwise(F.concat(F.lit("DG"), s))


def content_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-1: ``Contract, AppName, TotalDuration, Date`` from ``events``."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    cid = F.col("user_id") * 11 + F.least(F.col("event_id") % 37, F.lit(10))
    contract = F.when(cid % 5 == 0, F.lit("0")).otherwise(_profile_id(cid))
    even = F.col("event_id") % 2 == 0
    et = F.col("event_type")
    app = (
        F.when(F.col("event_id") % 23 == 0, F.lit("UNKNOWN"))
        .when(et == "click", F.lit("CHANNEL"))
        .when(et == "error", F.lit("RELAX"))
        .when(et == "signup", F.lit("CHILD"))
        .when(et == "view", F.when(even, F.lit("VOD")).otherwise(F.lit("FIMS")))
        .when(et == "purchase", F.when(even, F.lit("SPORT")).otherwise(F.lit("KPLUS")))
    )
    return ev.select(
        contract.alias("Contract"),
        app.alias("AppName"),
        F.round(F.col("value") * 100).cast("long").alias("TotalDuration"),
        F.date_add(F.lit(_dt.date(2022, 6, 15)), F.dayofmonth("ts") - 1).alias("Date"),
    )


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-2: ``user_id, keyword, datetime, proxy_isp, platform, networkType, log_date``."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # the customer's columns meet the orders, not their many more lines
    o = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    ck = F.col("o_custkey")
    user = F.when(ck % 4 == 0, F.lit(None).cast("string")).otherwise(_profile_id(ck))
    ln = F.col("l_linenumber")
    keyword = F.when(ln % 2 == 0, F.concat(F.upper("p_name"), F.lit("!"))).otherwise(F.col("p_name"))
    log_date = F.date_add(
        F.lit(WINDOW_START), F.datediff(F.to_date("o_orderdate"), F.lit(_dt.date(1995, 1, 1))) % 44
    )
    h = F.col("l_orderkey") % 24
    mm = _pad(F.col("l_partkey") % 60, 2)
    ss = _pad(F.col("l_suppkey") % 60, 2)
    ms = _pad((F.col("l_orderkey") * 7 + ln) % 1000, 3)
    day = F.date_format(log_date, "yyyy-MM-dd")
    fmt = ln % 4
    clock = (
        F.when(fmt == 0, F.concat_ws(":", _pad(h, 2), mm, F.concat(ss, F.lit("."), ms)))
        .when(fmt == 1, F.concat_ws(":", h.cast("string"), mm, F.concat(ss, F.lit("."), ms)))
        .when(fmt == 2, F.concat_ws(":", _pad(h, 2), mm, ss))
        .otherwise(F.concat_ws(":", h.cast("string"), mm, ss))
    )
    suffix = F.when(ln % 3 == 0, F.when(h >= 12, F.lit(" CH")).otherwise(F.lit(" SA"))).otherwise(F.lit(""))
    return j.select(
        user.alias("user_id"),
        keyword.alias("keyword"),
        F.concat(day, F.lit(" "), clock, suffix).alias("datetime"),
        F.col("n_name").alias("proxy_isp"),
        F.col("c_mktsegment").alias("platform"),
        F.col("l_returnflag").alias("networkType"),
        log_date.alias("log_date"),
    )


# A-3 category by length(p_name) % 6; 5 -> left out (unmapped keyword).
_MAP_BY_LENGTH = ["Action", "Romance", "Drama", "Sports", "Other"]


def keyword_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-3: ``keyword, category`` over the distinct part names."""
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("keyword")).distinct()
    r = F.length("keyword") % 6
    cat = None
    for i, label in enumerate(_MAP_BY_LENGTH):
        cat = F.when(r == i, F.lit(label)) if cat is None else cat.when(r == i, F.lit(label))
    return names.select("keyword", cat.alias("category")).where(F.col("category").isNotNull())
