"""Structured Streaming jobs over post files."""

from tidemark.streaming.arrivals import ARRIVALS, arrivals
from tidemark.streaming.ingest import (
    dedupe_stream,
    dropped_rows,
    enrich_stream,
    land_stream,
    merge_stream,
    run_available,
    sliding_stream,
    timed,
    tumbling_summary,
    untimed,
)

__all__ = [
    "ARRIVALS",
    "arrivals",
    "dedupe_stream",
    "dropped_rows",
    "enrich_stream",
    "land_stream",
    "merge_stream",
    "run_available",
    "sliding_stream",
    "timed",
    "tumbling_summary",
    "untimed",
]
