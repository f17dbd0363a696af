"""Declared schemas. Nothing in this package infers a schema from a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

COUNT_COLUMNS = ["like_count", "retweet_count", "reply_count", "quote_count"]

NORMALIZED = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("text", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in COUNT_COLUMNS],
        T.StructField("source", T.StringType()),
    ]
)

ENRICHED = T.StructType(
    [
        *NORMALIZED.fields,
        T.StructField("engagement_total", T.LongType()),
        T.StructField("sentiment_score", T.DoubleType()),
        T.StructField("sentiment_label", T.StringType()),
        T.StructField("event_day", T.StringType()),
        T.StructField("scorer", T.StringType()),
        T.StructField("scorer_version", T.StringType()),
        T.StructField("event_date", T.DateType()),
    ]
)

DAILY_SUMMARY = T.StructType(
    [
        T.StructField("event_day", T.StringType()),
        T.StructField("post_count", T.LongType()),
        T.StructField("total_engagement", T.LongType()),
        T.StructField("avg_sentiment", T.DoubleType()),
        T.StructField("positive", T.LongType()),
        T.StructField("neutral", T.LongType()),
        T.StructField("negative", T.LongType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType, extra: tuple[str, ...] = ()) -> DataFrame:
    """Cast ``df`` to ``schema`` by name, refusing unknown or missing columns.

    ``extra`` names columns that pass through unchanged after the declared ones.
    """
    declared = set(schema.fieldNames()) | set(extra)
    unknown = sorted(set(df.columns) - declared)
    missing = sorted(declared - set(df.columns))
    if unknown or missing:
        raise ValueError(f"schema mismatch: unknown columns {unknown}, missing columns {missing}")
    cast = [df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cast, *[df[c] for c in extra])
