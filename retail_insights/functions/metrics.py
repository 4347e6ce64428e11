"""Ratios and percentages.

Percentages are divided as DOUBLE.  Spark's decimal division keeps six
digits and a second ``round(..., 2)`` then rounds the rounded value, which
moves the last digit in about one row in 10^4; dividing as double gives the
correctly rounded quotient that other engines produce too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num, den) -> Column:
    """``num / den`` as double; NULL when ``den`` is 0 or NULL."""
    return _c(num).cast("double") / F.nullif(_c(den), F.lit(0)).cast("double")


def pct_change(cur, prev, digits: int = 2) -> Column:
    """``round(100 * (cur - prev) / nullif(prev, 0), digits)``.

    The difference is taken exactly (decimal), the division as double.
    """
    cur, prev = _c(cur), _c(prev)
    return F.round(ratio(F.lit(100) * (cur - prev), prev), digits)


def relative_change_pct(cur, prev, digits: int = 2) -> Column:
    """``round(((cur - prev) / prev) * 100, digits)``, NULL for a NULL or zero ``prev``."""
    cur, prev = _c(cur), _c(prev)
    return F.round(ratio(cur - prev, prev) * F.lit(100.0), digits)


def pct_of(part, whole, digits: int = 2) -> Column:
    """``round(100 * part / nullif(whole, 0), digits)``."""
    return F.round(ratio(F.lit(100) * _c(part), whole), digits)
