"""Reusable column expressions (all built-in Spark functions, JVM-side)."""

from retail_insights.functions.dates import (
    as_of_date,
    days_since,
    on_or_after,
    window_start,
    year_month_label,
)
from retail_insights.functions.metrics import (
    pct_change,
    pct_of,
    ratio,
    relative_change_pct,
)

__all__ = [
    "as_of_date",
    "days_since",
    "on_or_after",
    "pct_change",
    "pct_of",
    "ratio",
    "relative_change_pct",
    "window_start",
    "year_month_label",
]
