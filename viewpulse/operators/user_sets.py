"""Distinct users of the reports as mergeable sets.

Users get dense numbers, and the users of each cell of a snapshot (source, service, activity, taste, categories)
are kept as bitmaps of 32,768 numbers each.  Any report's distinct users are unions of cells, so the
states answer them without the fact; and, unlike counts, states of several snapshots can be united: a user seen in two
of them counts once.

A state has a row for each cell and bitmap; its size goes with the cells, not with the searches or views.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewpulse import schemas as S
from viewpulse.operators import reports as R
from viewpulse.session import shared_dir

CELL = ["data_source", "service_key", "Active", "Taste", "category_prev", "category_curr", "Trending_Type"]
NUMBERS_SCHEMA = "Profile_ID string, user_no long"


def number_users(profiles: DataFrame, known: DataFrame | None = None, slots: int = 64) -> DataFrame:
    """``Profile_ID, user_no``: the known numbers and new ones for new users, from the largest known on (at first from 1), without gaps.

    New users are dealt into ``slots`` parts by a hash; a part's numbers follow those of the parts before it.
    """
    users = profiles.select("Profile_ID").where("Profile_ID IS NOT NULL").distinct()
    first = 1
    if known is not None:
        users = users.join(known.select("Profile_ID"), "Profile_ID", "left_anti")
        first = known.agg(F.coalesce(F.max("user_no") + 1, F.lit(1))).first()[0]
    slot = F.pmod(F.xxhash64("Profile_ID"), F.lit(slots)).cast("int")
    path = f"{shared_dir(profiles.sparkSession).rstrip('/')}/viewpulse-stage/new-users-{uuid.uuid4().hex}"
    users.select("Profile_ID", slot.alias("slot")).write.parquet(path)
    new = profiles.sparkSession.read.schema("Profile_ID string, slot int").parquet(path)
    sizes = new.groupBy("slot").agg(F.count("*").alias("n"))  # at most ``slots`` rows
    before = sizes.select("slot", (F.sum("n").over(Window.orderBy("slot")) - F.col("n") + F.lit(first)).alias("before"))
    place = F.row_number().over(Window.partitionBy("slot").orderBy("Profile_ID")) - 1
    numbered = new.withColumn("place", place).join(F.broadcast(before), "slot").select("Profile_ID", (F.col("before") + F.col("place")).cast("long").alias("user_no"))
    return numbered if known is None else known.select("Profile_ID", "user_no").unionByName(numbered)


def user_states(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    """``snapshot_date_key``, the cell, ``bucket`` and ``users``: a bitmap of the cell's users in each bucket of numbers."""
    numbered = fact.join(numbers, "Profile_ID")
    return numbered.groupBy("snapshot_date_key", *CELL, F.bitmap_bucket_number("user_no").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_no")).alias("users"))


def merge_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """States with the cells and snapshots of equal ``keys`` united."""
    return states.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def count_users(states: DataFrame, keys: list[str], flags: dict[str, Column] | None = None) -> DataFrame:
    """Distinct users per ``keys`` (and of the cells that satisfy each flag)."""
    sets = {"TongUser": F.lit(True)} | (flags or {})
    united = states.groupBy(*keys, "bucket").agg(*[F.bitmap_or_agg(F.when(c, F.col("users"))).alias(n) for n, c in sets.items()])
    return united.groupBy(*keys).agg(*[F.sum(F.coalesce(F.bitmap_count(n), F.lit(0))).cast("long").alias(n) for n in sets])


def _own(states: DataFrame, source: str, snapshots: list[int]) -> DataFrame:
    return states.where((F.col("data_source") == source) & F.col("snapshot_date_key").isin(snapshots))



def category_loyalty(states: DataFrame, dim: DataFrame, snapshots: list[int], source: str = S.SOURCE_CONTENT) -> DataFrame:
    """W-32 from states; over several snapshots a user counts once in each column."""
    own = R.with_service(_own(states, source, snapshots), dim)
    agg = count_users(own, ["CategoryGroup", "Category"], {"UserTrungThanh": F.col("Active") == "High", "UserNguyCo": F.col("Active") == "Low"})
    return agg.withColumn("TiLe_TrungThanh", R.pct(F.col("UserTrungThanh"), F.col("TongUser")))


def category_taste(states: DataFrame, dim: DataFrame, snapshots: list[int], source: str = S.SOURCE_CONTENT) -> DataFrame:
    """W-33 from states."""
    own = R.with_service(_own(states, source, snapshots).where("Taste IS NOT NULL"), dim)
    agg = count_users(own, ["CategoryGroup", "Category", "Taste"])
    return agg.withColumn("PhanTram_TrongCategory", R.pct(F.col("TongUser"), F.sum("TongUser").over(Window.partitionBy("Category"))))


def power_vs_casual(states: DataFrame, dim: DataFrame, snapshots: list[int], source: str = S.SOURCE_CONTENT) -> DataFrame:
    """W-34 from states."""
    own = R.with_service(_own(states, source, snapshots), dim).withColumnRenamed("Active", "UserType")
    agg = count_users(own, ["UserType", "CategoryGroup", "Category"])
    return agg.withColumn("PhanTram_TrongNhom", R.pct(F.col("TongUser"), F.sum("TongUser").over(Window.partitionBy("UserType"))))


def taste_diversity(states: DataFrame, snapshots: list[int], source: str = S.SOURCE_CONTENT) -> DataFrame:
    """W-35 from states."""
    own = _own(states, source, snapshots).where("Taste IS NOT NULL").withColumn("SoTheLoaiXem", R.genre_bucket(F.col("Taste")))
    agg = count_users(own, ["SoTheLoaiXem", "Active"])
    return agg.withColumn("PhanTram", R.pct(F.col("TongUser"), F.sum("TongUser").over(Window.partitionBy())))


def interest_migration(states: DataFrame, snapshots: list[int], source: str = S.SOURCE_SEARCH) -> DataFrame:
    """W-37 from states."""
    moved = (F.col("Trending_Type") == "Changed") & F.col("category_prev").isNotNull() & F.col("category_curr").isNotNull()
    own = _own(states, source, snapshots).where(moved).withColumnsRenamed({"category_prev": "RoiKhoi", "category_curr": "ChuyenSang"})
    agg = count_users(own, ["RoiKhoi", "ChuyenSang"])
    return agg.withColumn("PhanTram_RoiKhoi", R.pct(F.col("TongUser"), F.sum("TongUser").over(Window.partitionBy("RoiKhoi"))))
