"""Keyword dictionary maintenance: classify new keywords by rules (W-11), merge (W-12).

Classification is a rule table evaluated as one ``CASE`` expression on the
executors.  Keywords that no rule matches may be put to a classifier outside of Spark: see ``plans.classifier``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse import schemas as S

def rule_category(keyword: Column, rules: Sequence[tuple[str, str]] = S.KEYWORD_RULES) -> Column:
    """First matching rule's category (``rlike`` on the lower-cased keyword), else NULL."""
    kw = F.lower(keyword)
    expr = None
    for pattern, category in rules:
        cond = kw.rlike(pattern)
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    return expr if expr is not None else F.lit(None).cast("string")


def classify(keywords: DataFrame, rules: Sequence[tuple[str, str]] = S.KEYWORD_RULES, fallback: str | None = S.FALLBACK_CATEGORY) -> DataFrame:
    """W-11: ``keyword -> category`` for a DataFrame with a ``keyword`` column; ``fallback`` where no rule matches (None: NULL)."""
    category = rule_category(F.col("keyword"), rules)
    return keywords.select("keyword", (category if fallback is None else F.coalesce(category, F.lit(fallback))).alias("category"))


def merge_map(old: DataFrame, new: DataFrame) -> DataFrame:
    """W-12: keep every existing entry, add only keywords the dictionary lacks.

    Anti-join on keyword; the join strategy follows the dictionary's size
    (AQE turns it into a broadcast when the runtime side is small).
    """
    base = old.select("keyword", "category")
    fresh = new.groupBy("keyword").agg(F.min("category").alias("category"))
    return base.unionByName(fresh.join(base.select("keyword"), "keyword", "left_anti"))


def new_keywords(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """All distinct keywords of both periods that the dictionary lacks."""
    both = pairs.select(F.explode(F.array("most_searched_prev", "most_searched_curr")).alias("keyword"))
    return both.where(F.col("keyword").isNotNull()).distinct().join(known.select("keyword"), "keyword", "left_anti")
