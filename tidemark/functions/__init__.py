"""Column functions: text, numbers and dates."""

from tidemark.functions.dates import (
    event_day,
    event_partition_path,
    path_date,
    posts_partition_path,
    run_stamp,
    summary_partition_path,
    utc_date,
    utc_instant,
)
from tidemark.functions.numbers import round_half_even, round_half_up
from tidemark.functions.text import clean_word, tokens, words

__all__ = [
    "clean_word",
    "event_day",
    "event_partition_path",
    "path_date",
    "posts_partition_path",
    "round_half_even",
    "round_half_up",
    "run_stamp",
    "summary_partition_path",
    "tokens",
    "utc_date",
    "utc_instant",
    "words",
]
