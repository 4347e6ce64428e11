"""Sources: JDBC tables, document exports, files, and the binding of the
driver's test tables (:mod:`retail_insights.sources.fixture`)."""

from retail_insights.sources.quarantine import Landed, land, marked, marked_typed
from retail_insights.sources.readers import (
    read_csv,
    read_documents,
    read_files,
    read_jdbc,
    read_typed_documents,
)
from retail_insights.sources.splits import plan_splits, read_balanced

__all__ = ["Landed", "land", "marked", "marked_typed", "plan_splits", "read_balanced", "read_csv", "read_documents",
           "read_files", "read_jdbc", "read_typed_documents"]
