"""Importing this module registers every query of the folder."""

from tidemark.llm import ann, chat, exact_search, extract, language, near_dedup, packing, periodic, pieces, quality, substrings, warc, whitening  # noqa: F401
from tidemark.llm.registry import QUERIES, SQL  # noqa: F401
