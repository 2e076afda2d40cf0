"""Search-log operators.

The per-user steps are aggregates (``min`` over a ``(-count, keyword)``
struct) rather than windows: they combine map-side, so a user or keyword that
holds a large share of the rows is reduced before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse import schemas as S
from viewpulse.functions.dates import as_date, month_before
from viewpulse.functions.text import clean_keyword, search_month, with_computed
from viewpulse.operators.paging import page

PREV = "prev"
CURR = "curr"


def comparison_months(end_date) -> tuple[int, int]:
    """(previous month, current month) numbers for a snapshot end date."""
    end = as_date(end_date)
    return month_before(end).month, end.month


def clean_search(df: DataFrame, min_len: int = S.MIN_KEYWORD_LENGTH) -> DataFrame:
    """W-04: parse the month of ``datetime``, normalise ``keyword``, drop junk.

    Rows without user or keyword, or whose cleaned keyword is shorter than
    ``min_len``, are dropped.  Adds ``month`` (NULL when the time is unparseable).
    """
    known = df.where(F.col("user_id").isNotNull() & F.col("keyword").isNotNull())
    cleaned = with_computed(known, keyword=clean_keyword("keyword"), month=search_month("datetime"))
    return cleaned.where(F.length("keyword") >= F.lit(min_len))


def period_of(month: Column, end_date) -> Column:
    prev_m, curr_m = comparison_months(end_date)
    return F.when(month == F.lit(prev_m), F.lit(PREV)).when(month == F.lit(curr_m), F.lit(CURR))


def with_period(df: DataFrame, end_date) -> DataFrame:
    """W-05: tag rows ``prev``/``curr`` by month number; other months are dropped."""
    return df.withColumn("period", period_of(F.col("month"), end_date)).where(F.col("period").isNotNull())


def keyword_counts(df: DataFrame) -> DataFrame:
    """W-06: searches per ``(user_id, period, keyword)`` -> ``search_count``."""
    return df.groupBy("user_id", "period", "keyword").agg(F.count(F.lit(1)).alias("search_count"))


def rank_key(n: Column, kw: Column) -> Column:
    # min over (-count, keyword): largest count, ties to the smallest keyword.
    return F.struct((-n).alias("neg_n"), kw.alias("kw"))


def top_keywords(counts: DataFrame) -> DataFrame:
    """W-07: most searched keyword of each user in each period (ties -> smallest keyword).

    Output: ``user_id, period, keyword, search_count``.
    """
    best = F.min(rank_key(F.col("search_count"), F.col("keyword"))).alias("best")
    return counts.groupBy("user_id", "period").agg(best).select(
        "user_id",
        "period",
        F.col("best.kw").alias("keyword"),
        (-F.col("best.neg_n")).alias("search_count"),
    )


def pair_columns(best_prev: Column, best_curr: Column) -> list[Column]:
    return [
        best_prev.getField("kw").alias("most_searched_prev"),
        (-best_prev.getField("neg_n")).alias("count_prev"),
        best_curr.getField("kw").alias("most_searched_curr"),
        (-best_curr.getField("neg_n")).alias("count_curr"),
    ]


def pair_periods(top: DataFrame) -> DataFrame:
    """W-08: users with a top keyword in both periods.

    Output: ``user_id, most_searched_prev, count_prev, most_searched_curr, count_curr``.
    Same rows as a full outer join + both-not-null filter (an inner join),
    done as one conditional aggregate.
    """
    key = rank_key(F.col("search_count"), F.col("keyword"))
    agg = top.groupBy("user_id").agg(
        F.min(F.when(F.col("period") == PREV, key)).alias("bp"),
        F.min(F.when(F.col("period") == CURR, key)).alias("bc"),
    )
    return agg.where(F.col("bp").isNotNull() & F.col("bc").isNotNull()).select(
        "user_id", *pair_columns(F.col("bp"), F.col("bc"))
    )


def keyword_popularity(pairs: DataFrame) -> DataFrame:
    """W-09: total ``count_prev`` per previous-month top keyword -> ``most_searched_prev, total``."""
    return pairs.groupBy("most_searched_prev").agg(F.sum("count_prev").alias("total"))


def page_keywords(
    pairs: DataFrame,
    limit_prev: int = 10000,
    offset_prev: int = 0,
    limit_curr: int = 10000,
    offset_curr: int = 0,
    shallow: int = 1_000_000,
) -> DataFrame:
    """W-10: a page of popular previous keywords plus a page of current keyword rows.

    Previous side pages distinct keywords by ``total desc, keyword``; current
    side pages pair *rows* by ``count_prev desc, user_id``.  Union, distinct.
    The page is the feature here; ``orderBy().offset().limit()`` plans as a
    per-partition top-k (``TakeOrderedAndProject``), never a one-task sort.  A page that ends beyond ``shallow`` rows
    is cut from written ranges of the order instead (``operators.paging``), with the same rows.
    """
    def cut(rows: DataFrame, order: list[Column], offset: int, limit: int) -> DataFrame:
        if offset + limit > shallow:
            return page(rows, order, offset, limit, shallow)
        return rows.orderBy(*order).offset(offset).limit(limit)

    prev_page = cut(keyword_popularity(pairs), [F.desc("total"), F.asc("most_searched_prev")], offset_prev, limit_prev)
    curr_page = cut(pairs, [F.desc("count_prev"), F.asc("user_id")], offset_curr, limit_curr)
    words = [prev_page.select(F.col("most_searched_prev").alias("keyword")), curr_page.select(F.col("most_searched_curr").alias("keyword"))]
    return words[0].union(words[1]).distinct()


def _dictionary(kmap: DataFrame) -> DataFrame:
    """One category a keyword: a repeated keyword is collapsed to its smallest category."""
    return kmap.groupBy("keyword").agg(F.min("category").alias("category"))


def _by_side(pairs: DataFrame) -> DataFrame:
    """Both keywords of a user as rows ``side, keyword``, so that they meet the dictionary in one join."""
    sides = F.array(
        F.struct(F.lit(PREV).alias("side"), F.col("most_searched_prev").alias("keyword")),
        F.struct(F.lit(CURR).alias("side"), F.col("most_searched_curr").alias("keyword")),
    )
    return pairs.select("*", F.inline(sides))


def _folded(joined: DataFrame, columns: list[str]) -> DataFrame:
    """One row a user again.  Grouped by the user alone, so that a partitioning by user serves the joins to come."""
    of_side = lambda side: F.max(F.when(F.col("side") == side, F.col("category")))
    rest = [F.any_value(c).alias(c) for c in columns if c != "user_id"]
    folded = joined.groupBy("user_id").agg(*rest, of_side(PREV).alias("category_prev"), of_side(CURR).alias("category_curr"))
    return folded.select(*columns, "category_prev", "category_curr")


def map_categories(pairs: DataFrame, kmap: DataFrame) -> DataFrame:
    """W-13: attach ``category_prev``/``category_curr`` by exact keyword match (NULL if unmapped) to one row a user.

    No broadcast hint: the dictionary grows with the keyword space, so the
    join strategy is left to the size estimate and AQE's runtime conversion.
    For a dictionary too large to broadcast and keywords that many users share, see ``map_categories_split``.
    """
    return _folded(_by_side(pairs).join(_dictionary(kmap), "keyword", "left"), pairs.columns)


def hot_keywords(pairs: DataFrame, share: float = 1 / 256) -> list[str]:
    """The keywords that hold more than about ``share`` of the users' keywords, at most ``2 / share`` of them.

    From a sketch of bounded size (``approx_top_k``), in one pass; a keyword missed or named in vain costs time, never rows.
    """
    k = int(2 / share)
    words = pairs.select(F.explode(F.array("most_searched_prev", "most_searched_curr")).alias("keyword")).where("keyword IS NOT NULL")
    found = words.agg(F.expr(f"approx_top_k(keyword, {k}, {min(1_000_000, 16 * k)})").alias("top"), F.count("*").alias("n")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] > share * found["n"]]


def map_categories_split(pairs: DataFrame, kmap: DataFrame, hot: list[str], parts: int = 64) -> DataFrame:
    """W-13 as ``map_categories``, with the users of each hot keyword dealt into ``parts`` and its dictionary row repeated for each.

    The join's shuffle is by keyword and part, so that no task gets a hot keyword whole, whether or not the dictionary is broadcast.
    """
    is_hot = F.col("keyword").isin(hot) if hot else F.lit(False)
    part = F.when(is_hot, F.pmod(F.xxhash64("user_id", "side"), F.lit(parts)).cast("int")).otherwise(0)
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    d = _dictionary(kmap).select("keyword", "category", F.explode(every).alias("part"))
    return _folded(_by_side(pairs).withColumn("part", part).join(d, ["keyword", "part"], "left"), pairs.columns)


def category_shift(df: DataFrame) -> DataFrame:
    """W-14: ``Trending_Type`` Unchanged/Changed and ``Previous`` (Unchanged or 'prev-curr').

    A NULL category never equals anything: the row is Changed and ``Previous``
    holds the non-NULL side (or '').
    """
    moved = ~F.coalesce(F.col("category_prev") == F.col("category_curr"), F.lit(False))
    path = F.concat_ws("-", "category_prev", "category_curr")
    return df.select(
        "*", F.when(moved, "Changed").otherwise("Unchanged").alias("Trending_Type"),
        F.when(moved, path).otherwise("Unchanged").alias("Previous"),
    )


def user_device(log: DataFrame) -> DataFrame:
    """W-22: one device row per user: the latest day's, ties to the largest
    ``(proxy_isp, platform, networkType)``.  Output ``user_id, proxy_isp, platform, networkType``.
    """
    # distinct first, by a hash aggregate: a maximum of strings would sort every raw row
    device = ["log_date", "proxy_isp", "platform", "networkType"]
    days = log.where(F.col("user_id").isNotNull()).select("user_id", *device).distinct()
    latest = days.groupBy("user_id").agg(F.max(F.struct(*device)).alias("dev"))
    return latest.select("user_id", *[F.col("dev")[c].alias(c) for c in device[1:]])
