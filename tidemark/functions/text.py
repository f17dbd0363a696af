"""Tokenising, as column expressions that stay in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that separate words. U+001C to U+001F and U+0085 separate,
# U+FEFF does not, so the regex class \s would be wrong.
WORD_SEPARATORS = (
    r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# Fixed value: the punctuation taken off both ends of a word before lexicon lookup.
EDGE_PUNCTUATION = ".,!?;:\"'"

SPLIT_PATTERN = f"[{WORD_SEPARATORS}]++"


def words(text: Column) -> Column:
    """Raw words: split on separator runs, empties dropped; null text has no words."""
    parts = F.split(text, SPLIT_PATTERN)
    return F.coalesce(F.filter(parts, lambda w: w != ""), F.array().cast("array<string>"))


def clean_word(raw: Column) -> Column:
    """The lookup form of a word: edge punctuation off, lower case. May be empty."""
    return F.lower(F.btrim(raw, F.lit(EDGE_PUNCTUATION)))


def tokens(text: Column) -> Column:
    return F.transform(words(text), clean_word)


def any_of(patterns: list[str]) -> str:
    """A regex alternation of literal strings."""
    return "(?:" + "|".join(re.escape(p) for p in patterns) + ")"
