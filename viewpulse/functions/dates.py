"""Date and date-key expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_date(d) -> _dt.date:
    """A date from a ``date``/``datetime``, ``'YYYYMMDD'``, ``'YYYY-MM-DD'`` or ``YYYYMMDD`` int."""
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    s = str(d)
    return _dt.datetime.strptime(s, "%Y%m%d" if len(s) == 8 else "%Y-%m-%d").date()


def in_window(df: DataFrame, date_col: str, start=None, end=None) -> DataFrame:
    """Rows with ``start <= date_col <= end`` (an open side when None); prunes date partitions."""
    if start is not None:
        df = df.where(F.col(date_col) >= F.lit(as_date(start)))
    if end is not None:
        df = df.where(F.col(date_col) <= F.lit(as_date(end)))
    return df


def month_before(day: _dt.date) -> _dt.date:
    """First day of the month before the month of ``day``."""
    return (day.replace(day=1) - _dt.timedelta(days=1)).replace(day=1)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(col: Column | str) -> Column:
    """DATE -> integer key ``yyyyMMdd``."""
    return F.date_format(_c(col), "yyyyMMdd").cast("int")


def yyyymmdd_to_date(col: Column | str) -> Column:
    """Integer or string ``yyyyMMdd`` -> DATE."""
    return F.try_to_date(_c(col).cast("string"), "yyyyMMdd")


def month_start_before(col: Column | str) -> Column:
    """First day of the month before the month of ``col`` (comparison window start)."""
    return F.trunc(F.add_months(_c(col), -1), "MM")
