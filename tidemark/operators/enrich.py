"""Engagement, sentiment and day columns, with a pluggable scorer whose name is kept."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import event_day, utc_date, utc_instant
from tidemark.functions.numbers import round_half_even
from tidemark.operators.lexicon import lexicon_score
from tidemark.schema import COUNT_COLUMNS

# Fixed value: the label cuts, inclusive on both sides, applied to the rounded score.
LABEL_CUT = 0.05


@dataclass(frozen=True)
class Scorer:
    """Adds a ``raw_score`` double column to a frame that has ``text``.

    ``name`` and ``version`` go into every row: two scorers may write to one lake, and the rows
    must say which one wrote them. There is no silent fallback from one scorer to another.
    """

    name: str
    version: str
    apply: Callable[[DataFrame], DataFrame]


def column_scorer(name: str, version: str, score: Callable[[Column], Column]) -> Scorer:
    """A scorer from ``text -> double``: a built-in expression or a ``pandas_udf`` model."""
    return Scorer(name, version, lambda df: df.withColumn("raw_score", score(F.col("text"))))


LEXICON_SCORER = column_scorer("lexicon", "28-words", lexicon_score)


def engagement_total() -> Column:
    first, *rest = [F.col(c) for c in COUNT_COLUMNS]
    for column in rest:
        first = first + column
    return first


def sentiment_label(score: Column) -> Column:
    return (
        F.when(score >= LABEL_CUT, "positive").when(score <= -LABEL_CUT, "negative").otherwise("neutral")
    )


def label_scored(scored: DataFrame, scorer: Scorer) -> DataFrame:
    """Derived columns for a frame that already carries ``raw_score``; all inputs are kept."""
    score = round_half_even(F.coalesce(F.col("raw_score"), F.lit(0.0)))
    day = event_day(F.col("created_at"))
    return (
        scored.withColumns(
            {"engagement_total": engagement_total(), "sentiment_score": score, "event_day": day}
        )
        .withColumns(
            {
                "sentiment_label": sentiment_label(F.col("sentiment_score")),
                "scorer": F.lit(scorer.name),
                "scorer_version": F.lit(scorer.version),
                "event_date": utc_date(utc_instant(F.col("created_at"))),
            }
        )
        .drop("raw_score")
    )


def enrich(posts: DataFrame, scorer: Scorer = LEXICON_SCORER) -> DataFrame:
    """Every input column plus engagement, score, label, day, date and the scorer's identity."""
    return label_scored(scorer.apply(posts), scorer)
