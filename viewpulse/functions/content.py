"""Viewing-log expressions: AppName -> Type, most watched Type, Taste."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewpulse import schemas as S


def app_type(app_col: Column | str = "AppName") -> Column:
    """Map an AppName to its viewing Type; NULL for unknown apps (case-sensitive)."""
    app = F.col(app_col) if isinstance(app_col, str) else app_col
    expr = None
    for app_name, type_name in S.APP_TYPE.items():
        cond = app == F.lit(app_name)
        expr = F.when(cond, F.lit(type_name)) if expr is None else expr.when(cond, F.lit(type_name))
    return expr


def most_watched(cols: dict[str, Column] | None = None) -> Column:
    """Type with the largest duration among the five Type columns.

    Missing Types count as 0 for the maximum, but only a present Type can be
    chosen; ties go by ``MOST_WATCH_PRIORITY``.  All-NULL or all-negative rows
    give NULL, a real 0 can win.
    """
    cols = cols or {t: F.col(f"`{t}`") for t in S.TYPES}
    top = F.greatest(*[F.coalesce(cols[t], F.lit(0)) for t in S.TYPES])
    expr = None
    for t in S.MOST_WATCH_PRIORITY:
        cond = top == cols[t]
        expr = F.when(cond, F.lit(t)) if expr is None else expr.when(cond, F.lit(t))
    return expr


def taste(cols: dict[str, Column] | None = None) -> Column:
    """'-'-joined list of the Types present (non-NULL), in ``TYPES`` order; '' if none."""
    cols = cols or {t: F.col(f"`{t}`") for t in S.TYPES}
    return F.concat_ws("-", *[F.when(cols[t].isNotNull(), F.lit(t)) for t in S.TYPES])


#: A day's answer in one number: the place of its most watched Type in ``MOST_WATCH_PRIORITY`` (from 1; 0 for none), and a bit for each Type present.
MASK_BITS = len(S.TYPES)


def day_code(cols: dict[str, Column] | None = None) -> Column:
    """Most watched Type and Types present of a day as a whole number, which a hash aggregate can keep."""
    cols = cols or {t: F.col(f"`{t}`") for t in S.TYPES}
    best = F.coalesce(F.array_position(F.array(*[F.lit(t) for t in S.MOST_WATCH_PRIORITY]), most_watched(cols)), F.lit(0))
    mask = sum((F.when(cols[t].isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, t in enumerate(S.TYPES)), F.lit(0))
    return F.shiftleft(best, MASK_BITS) + mask


def most_watched_of(code: Column) -> Column:
    place = F.shiftright(code, MASK_BITS).cast("int")
    return F.when(place > 0, F.try_element_at(F.array(*[F.lit(t) for t in S.MOST_WATCH_PRIORITY]), place))


def taste_of(code: Column) -> Column:
    present = F.concat_ws("-", *[F.when(code.bitwiseAND(1 << i) != 0, F.lit(t)) for i, t in enumerate(S.TYPES)])
    return F.when(code.isNotNull(), present)
