"""Readers for posts, lakes and reference tables."""

from tidemark.sources.lake import (
    file_schemas,
    object_inventory,
    object_rows,
    read_lake,
    read_lake_flat,
    read_probe,
)
from tidemark.sources.posts import cap_posts, read_posts, read_raw, stream_raw
from tidemark.sources.reference import prices, size_points

__all__ = [
    "cap_posts",
    "file_schemas",
    "object_inventory",
    "object_rows",
    "prices",
    "read_lake",
    "read_lake_flat",
    "read_posts",
    "read_probe",
    "read_raw",
    "size_points",
    "stream_raw",
]
