"""Streaming ingest: enrich, dedupe by id, daily summary, and idempotent merge.

Offsets advance only when a batch commits, so a failed run is read again; replaying is safe because
the sinks are idempotent by id or deduplicated within the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.dates import from_event_time, to_event_time, utc_instant
from tidemark.operators.enrich import LEXICON_SCORER, Scorer, enrich
from tidemark.operators.normalize import normalize
from tidemark.operators.summary import score_units
from tidemark.operators.windows import LOOKBACK_DAYS
from tidemark.session import TIDY, settings
from tidemark.sinks.lake import COMPACT, MANY_OPEN, has_id, merge_posts
from tidemark.streaming.arrivals import ROCKSDB, STATE_STORE, arrivals

# Ids stay known for as long as overlapping reads can bring them back.
ID_DELAY = f"{LOOKBACK_DAYS} days"


def enrich_stream(raw: DataFrame, scorer: Scorer = LEXICON_SCORER) -> DataFrame:
    """Normalised, enriched posts of a stream, with ``created_ts`` for watermarks."""
    posts = normalize(raw).drop("quality_flags")
    return enrich(posts, scorer).withColumn("created_ts", utc_instant(F.col("created_at")))


def timed(posts: DataFrame) -> DataFrame:
    """Posts whose time can be read, with ``event_time`` for watermarks."""
    return posts.filter(F.col("created_ts").isNotNull()).withColumn("event_time", to_event_time(F.col("created_ts")))


def untimed(posts: DataFrame) -> DataFrame:
    """Posts without a usable time. No watermark can place them, so they go to a sink of their own."""
    return posts.filter(F.col("created_ts").isNull())


def sliding_stream(posts: DataFrame, lookback_days: int = LOOKBACK_DAYS, delay: str = ID_DELAY) -> DataFrame:
    """Posts per window of ``lookback_days`` advancing daily, ``[start, end)``; the stream of ``sliding_counts``.

    A window comes out once the watermark has passed its end, and its state goes then. Posts without a
    time are in no window.
    """
    late_bounded = posts if "event_time" in posts.columns else timed(posts).withWatermark("event_time", delay)
    counted = late_bounded.groupBy(F.window("event_time", f"{lookback_days} days", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("post_count"))
    return counted.select(from_event_time(F.col("w.start")).alias("window_start"), from_event_time(F.col("w.end")).alias("window_end"), "post_count")


def dedupe_stream(posts: DataFrame, delay: str = ID_DELAY) -> DataFrame:
    """First row of each id within the watermark; ``delay`` must cover the lookback.

    A post without an id is known by its whole row. Posts without a time are not in the result, nor
    are those that come too late: ``land_stream`` keeps both.
    """
    columns = [c for c in posts.columns if c != "created_ts"]
    known = F.when(has_id(), F.concat(F.lit("i"), "id")).otherwise(F.sha2(F.to_json(F.struct(*columns)), 256))
    late_bounded = timed(posts).withColumn("known_by", known).withWatermark("event_time", delay)
    return late_bounded.dropDuplicatesWithinWatermark(["known_by"]).drop("known_by")


def tumbling_summary(posts: DataFrame, delay: str = ID_DELAY) -> DataFrame:
    """Daily totals, each day emitted once the watermark has passed its end.

    Posts that already went through ``dedupe_stream`` keep the watermark set there. Posts without a
    time belong to no day; the batch summary of what ``land_stream`` lands lists them under an empty day.
    """
    late_bounded = posts if "event_time" in posts.columns else timed(posts).withWatermark("event_time", delay)
    label = F.col("sentiment_label")
    return (
        late_bounded.groupBy(F.window("event_time", "1 day").alias("w"))
        .agg(
            F.count(F.lit(1)).alias("post_count"),
            F.sum("engagement_total").alias("total_engagement"),
            F.sum(score_units(F.col("sentiment_score"))).alias("sentiment_sum_e4"),
            F.count_if(label == "positive").alias("positive"),
            F.count_if(label == "neutral").alias("neutral"),
            F.count_if(label == "negative").alias("negative"),
        )
        .select(from_event_time(F.col("w.start")).cast("date").cast("string").alias("event_day"), F.expr("* except (w)"))
    )


def _finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for the end, gathering ``rows_dropped`` from all progress: a query keeps only its last reports."""
    dropped = {}
    while True:
        ended = query.awaitTermination(1)
        for p in query.recentProgress:
            dropped[p["batchId"], p["timestamp"]] = sum(int(op["numRowsDroppedByWatermark"]) for op in p["stateOperators"])
        if ended:
            query.rows_dropped = sum(dropped.values())
            return query


def run_available(stream: DataFrame, path: str, checkpoint: str, partition_by: str | list[str] | None = None) -> StreamingQuery:
    """Append everything now available to Parquet, in as many batches as the source asks for."""
    writer = stream.writeStream.format("parquet").options(**COMPACT).option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with settings(stream.sparkSession, MANY_OPEN):  # a query takes the settings it starts with
        query = writer.outputMode("append").trigger(availableNow=True).start()
    return _finish(query)


def land_stream(posts: DataFrame, root: str, checkpoint: str, delay_days: int = LOOKBACK_DAYS) -> StreamingQuery:
    """Every row to ``root``, partitioned by its ``arrival`` and ``event_date``; none lost, none twice.

    ``root`` filtered to ``post`` and ``untimed`` holds each post once; ``repeat`` and ``late`` are what a
    plain watermark turns away, kept to be looked at or merged by a backfill.
    """
    with settings(posts.sparkSession, {STATE_STORE: ROCKSDB}):
        return run_available(arrivals(posts, delay_days), root, checkpoint, ["arrival", "event_date"])


def merge_stream(enriched: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Merge each batch into the lake by id, so a batch that is run again replaces its own rows."""

    def merge(batch: DataFrame, _epoch: int) -> None:
        merge_posts(batch.drop("created_ts", "event_time"), root)

    with settings(enriched.sparkSession, TIDY):
        query = enriched.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    return _finish(query)


def dropped_rows(query: StreamingQuery) -> int:
    """Rows the watermark turned away in all batches of a finished run."""
    return query.rows_dropped
