"""Incremental ingestion with Structured Streaming (job-bookmark semantics).

The source pipeline has no streaming operators, watermarks or state; its
jobs only process new input on each run.  That is what lives here.
"""

from retail_insights.streaming.incremental import incremental_files

__all__ = ["incremental_files"]
