"""Social-post analytics on Spark: enrichment, idempotent lake writes, and lake audits."""

from tidemark.operators.enrich import LEXICON_SCORER, Scorer, column_scorer, enrich
from tidemark.operators.normalize import normalize
from tidemark.operators.summary import daily_summary
from tidemark.plans.etl import run_etl
from tidemark.session import build_session

__all__ = [
    "LEXICON_SCORER",
    "Scorer",
    "build_session",
    "column_scorer",
    "daily_summary",
    "enrich",
    "normalize",
    "run_etl",
]
