"""Column-level building blocks (pure ``Column`` expressions, JVM-side)."""

from viewpulse.functions.content import app_type, most_watched, taste
from viewpulse.functions.dates import date_key, month_start_before, yyyymmdd_to_date
from viewpulse.functions.text import clean_keyword, search_month, strip_ampm, with_computed

__all__ = [
    "app_type",
    "clean_keyword",
    "date_key",
    "month_start_before",
    "most_watched",
    "search_month",
    "strip_ampm",
    "taste",
    "with_computed",
    "yyyymmdd_to_date",
]
