"""Sinks for files and catalog tables."""

from retail_insights.sinks.files import publish_table, write_files
from retail_insights.sinks.publish import (
    CheckFailed,
    at_least,
    not_null,
    publish_checked,
    unique_key,
    write_checked,
)

__all__ = ["CheckFailed", "at_least", "not_null", "publish_checked", "publish_table", "unique_key", "write_checked",
           "write_files"]
