"""Date helpers.  Every relative-date filter takes an explicit ``as_of``.

With a literal ``as_of`` the window start folds to a constant, so the filter
reaches the Parquet scan as a pushed predicate.  ``as_of=None`` means the
session's ``current_date()``, which is what a scheduled run uses.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_date(as_of=None) -> Column:
    """``as_of`` as a DATE column: literal date, ISO string, column or today."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, _dt.datetime):
        return F.lit(as_of.date())
    if isinstance(as_of, _dt.date):
        return F.lit(as_of)
    if isinstance(as_of, str):
        return F.lit(_dt.date.fromisoformat(as_of))
    raise TypeError(f"unsupported as_of: {as_of!r}")


def window_start(as_of, days: int) -> Column:
    """First day of a window of ``days`` days ending at ``as_of``."""
    return F.date_sub(as_of_date(as_of), days)


def on_or_after(col: Column | str, as_of, days: int) -> Column:
    """``col >= as_of - days``: inclusive lower bound, no upper bound."""
    c = F.col(col) if isinstance(col, str) else col
    return c >= window_start(as_of, days)


def days_since(col: Column | str, as_of) -> Column:
    """Whole calendar days from ``col`` to ``as_of`` (time of day ignored)."""
    return F.datediff(as_of_date(as_of), F.col(col) if isinstance(col, str) else col)


def year_month_label(year: Column | str, month: Column | str) -> Column:
    """'yyyy-MM' text of a (year, month) pair, equal to
    ``date_format(ts, 'yyyy-MM')`` for the timestamp's year and month.

    Grouping by the two integers and labelling afterwards formats one value
    per group instead of one per row, and shuffles two ints, not a string.
    A NULL year or month gives NULL.
    """
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return F.when(y.isNotNull() & m.isNotNull(), F.format_string("%04d-%02d", y, m))
