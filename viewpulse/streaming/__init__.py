"""Incremental ingest of the raw logs with Structured Streaming.

The source system is a daily batch that re-reads two months of raw logs on
every run.  Here each new raw file is read once: a file-source stream
(``availableNow``) turns every micro-batch into additive per-day partial
aggregates, and the profiles are rebuilt from those partials.  Sums, counts
and max-of-struct merge across batches, so the profiles equal the batch
build over the same files.
"""

from viewpulse.streaming.ingest import (
    content_profile_from_partials,
    ingest_content,
    ingest_search,
    search_profile_from_partials,
)

__all__ = ["content_profile_from_partials", "ingest_content", "ingest_search", "search_profile_from_partials"]
