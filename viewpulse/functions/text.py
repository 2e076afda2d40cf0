"""Search-log text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewpulse import schemas as S


def strip_ampm(col: Column | str) -> Column:
    """Drop a trailing ``CH``/``SA`` (PM/AM) marker and surrounding blanks.

    The hour is *not* shifted to 24h; only the date part is used downstream.
    """
    return F.trim(F.regexp_replace(F.col(col) if isinstance(col, str) else col, S.AMPM_SUFFIX, ""))


def search_time_any(col: Column | str) -> Column:
    """Plain form: first of the accepted formats that parses (NULL if none fits)."""
    clean = strip_ampm(col)
    return F.coalesce(*[F.try_to_timestamp(clean, F.lit(fmt)) for fmt in S.TIMESTAMP_FORMATS])


def search_time(col: Column | str) -> Column:
    """Parse a search timestamp in any of the accepted formats (NULL if none fits).

    Same value as ``search_time_any`` with one parse per row instead of up to
    four (a failed parse is the expensive path): the one-letter hour patterns
    accept every string the two-letter ones do, with the same value, and only
    the fractional pattern can match a string that contains a '.'.
    """
    clean = strip_ampm(col)
    with_fraction = [f for f in S.TIMESTAMP_FORMATS if "." in f and " H:" in f][0]
    without_fraction = [f for f in S.TIMESTAMP_FORMATS if "." not in f and " H:" in f][0]
    return F.when(F.instr(clean, ".") > 0, F.try_to_timestamp(clean, F.lit(with_fraction))).otherwise(
        F.try_to_timestamp(clean, F.lit(without_fraction))
    )


def search_month(col: Column | str) -> Column:
    """Month number (1-12) of a search timestamp string, NULL when unparseable."""
    return F.month(search_time(col))


def clean_keyword(col: Column | str) -> Column:
    """Lower-case, remove everything but letters, digits and blanks, trim."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(F.regexp_replace(F.lower(c), S.KEYWORD_JUNK, ""))


def with_computed(df: DataFrame, **cols: Column) -> DataFrame:
    """Add (or replace) columns whose expressions are expensive, evaluated once per row.

    A later filter on a plain derived column is pushed below its projection
    with the expression inlined, so a regex or a timestamp parse would run
    once in the filter and again in the projection.  Producing the columns
    with a one-row generator (``inline`` of a one-element array) keeps every
    filter on them above it: each expression is evaluated exactly once.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c not in cols]
    row = F.struct(*[expr.alias(name) for name, expr in cols.items()])
    return df.select(*keep, F.inline(F.array(row)))
