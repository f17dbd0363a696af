"""Lake writers: event-date and run-date layouts, append, overwrite and merge."""

from tidemark.sinks.lake import (
    append_posts,
    merge_posts,
    overwrite_days,
    write_event_date,
    write_run_date,
    write_summary,
    write_with_receipt,
)

__all__ = [
    "append_posts",
    "merge_posts",
    "overwrite_days",
    "write_event_date",
    "write_run_date",
    "write_summary",
    "write_with_receipt",
]
