"""Daily roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import round_half_even


def score_units(score: Column) -> Column:
    """A four-place score as a whole number of 1/10000, so sums do not depend on their order."""
    return F.rint(score * 10000).cast("bigint")


def summary_totals(enriched: DataFrame, day: str = "event_day") -> DataFrame:
    """Exact integer totals per day. Partial sums keep a day with most of the rows cheap."""
    label = F.col("sentiment_label")
    return enriched.groupBy(day).agg(
        F.count(F.lit(1)).alias("post_count"),
        F.sum("engagement_total").alias("total_engagement"),
        F.sum(score_units(F.col("sentiment_score"))).alias("sentiment_sum_e4"),
        F.count_if(label == "positive").alias("positive"),
        F.count_if(label == "neutral").alias("neutral"),
        F.count_if(label == "negative").alias("negative"),
    )


def mean_score(sum_e4: Column, count: Column) -> Column:
    return round_half_even((sum_e4 / 10000) / count)


def daily_summary(enriched: DataFrame) -> DataFrame:
    """One row per day, in lexicographic day order."""
    totals = summary_totals(enriched)
    return totals.select(
        "event_day",
        "post_count",
        "total_engagement",
        mean_score(F.col("sentiment_sum_e4"), F.col("post_count")).alias("avg_sentiment"),
        "positive",
        "neutral",
        "negative",
    ).orderBy("event_day")


def scorer_agreement(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Label matrix of two scorers that wrote to different lakes, joined by ``key``.

    Where both scores can be had from one row, ``agreement_matrix`` needs no join.
    """
    a = left.select(key, F.col("sentiment_label").alias("label_a"), F.col("sentiment_score").alias("a"))
    b = right.select(key, F.col("sentiment_label").alias("label_b"), F.col("sentiment_score").alias("b"))
    return agreement_matrix(a.join(b, key))


def agreement_matrix(pairs: DataFrame) -> DataFrame:
    """For each ``label_a``: counts by ``label_b``, disagreements, sum and mean of the gaps of ``a`` and ``b``."""
    gap = F.abs(score_units(F.col("a")) - score_units(F.col("b")))
    other = F.col("label_b")
    return pairs.groupBy("label_a").agg(
        F.count_if(other == "negative").alias("negative"),
        F.count_if(other == "neutral").alias("neutral"),
        F.count_if(other == "positive").alias("positive"),
        F.count_if(other != F.col("label_a")).alias("disagreements"),
        F.sum(gap).alias("gap_sum_e4"),
        mean_score(F.sum(gap), F.count(F.lit(1))).alias("mean_gap"),
    )
