"""Streaming jobs over the given tables as file streams, run until everything available is read.

Posts carry whole document texts and their scores. The single-file tables are landed day by day
where a query is about batches, so that watermarks move and state outlives a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.enrich import label_scored
from tidemark.plans import views as v
from tidemark.plans.queries.enrichment import FREQUENT
from tidemark.plans.registry import query
from tidemark.schema import ENRICHED
from tidemark.session import scratch_path, settings, settle
from tidemark.sinks.lake import COMPACT, MANY_OPEN
from tidemark.sources.lake import listing
from tidemark.streaming import dropped_rows, enrich_stream, land_stream, merge_stream, run_available, sliding_stream, tumbling_summary
from tidemark.sources.posts import stream_raw

LANDED = T.StructType([*ENRICHED, T.StructField("arrival", T.StringType())])


def event_stream(spark: SparkSession, sf: str, text: bool = True) -> DataFrame:
    """Enriched posts of the events file, as a stream; documents are scored once, not in each batch."""
    schema = v.table(spark, sf, "events").schema
    # A file stream names a pattern; this one matches the events table only.
    events = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")
    scored = FREQUENT.apply(v.texts(spark, sf)).select("doc_id", *(["text"] if text else []), "raw_score")
    docs = settle(scored, "stream-docs")
    return label_scored(_posts(events, docs), FREQUENT)


def _posts(events: DataFrame, docs: DataFrame) -> DataFrame:
    """Posts of events, each with the text and score of its document (a stream joined to a table)."""
    n_docs = docs.agg(F.count(F.lit(1))).first()[0]
    return events.withColumn("doc_id", F.col("event_id") % n_docs).join(docs, "doc_id").select(
        F.col("event_id").cast("string").alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("created_at"),
        *(["text"] if "text" in docs.columns else []),
        "raw_score",
        F.floor(F.col("value") * 100).cast("bigint").alias("like_count"),
        F.get_json_object("props", "$.k").cast("bigint").alias("retweet_count"),
        F.col("user_id").alias("reply_count"),
        F.lit(0).cast("bigint").alias("quote_count"),
        F.col("event_type").alias("source"),
        F.col("ts").cast("timestamp_ntz").alias("created_ts"),
    )


# Stored bytes of a day that make one landed file (about 100 MB of lines), and how many
# days a batch of the stream holds.
FILE_BYTES, BATCH_DAYS = 32 * 1024 * 1024, 4


def _landed(spark: SparkSession, posts: DataFrame, name: str) -> tuple[str, int]:
    """Posts as JSON lines, a folder per day, landed in order of days so that they arrive in order.

    Returns the pattern of the folders and how many files a batch may take so that it holds no more
    than ``BATCH_DAYS`` days. A big day is several files; every file reads only its own day.
    """
    folder, held = scratch_path(spark, name), scratch_path(spark, f"{name}-held")
    metrics = F.struct("like_count").alias("public_metrics")
    lines = posts.select("batch", F.to_json(F.struct("id", "created_at", "text", "source", metrics)).alias("value"))
    with settings(spark, MANY_OPEN):
        lines.write.options(**COMPACT).partitionBy("batch").parquet(held)
    stored = spark.read.schema(lines.schema).parquet(held)
    days = [day for (day,) in stored.select("batch").distinct().orderBy("batch").collect()]  # small, and the order is the point
    size = listing(spark, held).agg(F.sum("bytes")).first()[0] or 0
    files = 1 + size // (FILE_BYTES * max(len(days), 1))
    for i, day in enumerate(days):
        stored.filter(F.col("batch").eqNullSafe(F.lit(day))).select("value").coalesce(files).write.text(f"{folder}/{i:05d}")
    if not days:
        stored.select("value").write.text(f"{folder}/{0:05d}")
    of_day = listing(spark, folder, "*.txt").groupBy(F.regexp_extract("key", r"/(\d+)/[^/]*$", 1)).agg(F.count(F.lit(1)).alias("n"))
    return f"{folder}/*", BATCH_DAYS * (of_day.agg(F.min("n")).first()[0] or 1)


_SUMMARY_SQL = v.with_ctes(v.SQL_FACTS, v.SQL_WORDS, v.SQL_LEXICON, v.SQL_NET, v.SQL_SCORED, body="""
SELECT event_day, count(*) AS post_count, CAST(sum(engagement_total) AS BIGINT) AS total_engagement,
       CAST(sum(CAST(round(sentiment_score * 10000) AS BIGINT)) AS BIGINT) AS sentiment_sum_e4,
       count(*) FILTER (sentiment_label = 'positive') AS positive, count(*) FILTER (sentiment_label = 'neutral') AS neutral,
       count(*) FILTER (sentiment_label = 'negative') AS negative
FROM scored GROUP BY 1""")


@query(
    "stream_daily_summary",
    f"SELECT * FROM ({_SUMMARY_SQL}) WHERE CAST(event_day AS DATE) + 1 <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)",
)
def q_stream_daily_summary(spark, sf):
    """Days whose end the watermark has passed; the last days stay open."""
    out, state = scratch_path(spark, "stream-summary"), scratch_path(spark, "stream-state")
    summary = tumbling_summary(event_stream(spark, sf, text=False), delay="1 day")
    run_available(summary, out, state)
    return spark.read.schema(summary.schema).parquet(out)


@query("stream_ingest", "SELECT event_type AS source, count(*) AS post_count FROM events GROUP BY 1")
def q_stream_ingest(spark, sf):
    """Posts land in the event-date layout; a second start finds nothing new."""
    out, state = scratch_path(spark, "stream-posts"), scratch_path(spark, "stream-state")
    for _ in range(2):
        run_available(event_stream(spark, sf).drop("created_ts"), out, state, partition_by="event_date")
    return spark.read.schema(ENRICHED).parquet(out).groupBy("source").agg(F.count(F.lit(1)).alias("post_count"))


def _day_posts(spark: SparkSession, sf: str) -> DataFrame:
    """One post per document, spread over 28 days; every seventh has no id, every eleventh no time."""
    docs = v.table(spark, sf, "documents")
    day = F.lit(1) + F.expr("doc_id div 30") % 28
    return docs.select(
        day.cast("int").alias("batch"),
        F.when(F.col("doc_id") % 7 != 0, F.col("doc_id").cast("string")).alias("id"),
        F.when(F.col("doc_id") % 11 != 0, F.format_string("2024-01-%02dT09:00:00.000Z", day)).otherwise("some day").alias("created_at"),
        "text",
        "source",
        F.col("doc_id").alias("like_count"),
    )


@query(
    "stream_dedupe",
    """
SELECT count(*) AS post_count, count(*) FILTER (doc_id % 11 = 0) AS without_time, count(*) FILTER (doc_id % 7 = 0) AS without_id,
       CAST(sum(doc_id) AS BIGINT) AS likes FROM documents""",
)
def q_stream_dedupe(spark, sf):
    """Every post arrives on its day and again two days later, over many batches and a restart.

    The delay is shorter than the data, so state is dropped on the way; posts without an id or a
    time are all there in the end, once.
    """
    posts = _day_posts(spark, sf)
    folder, files = _landed(spark, posts.union(posts.withColumn("batch", F.col("batch") + 2)), "stream-days")
    out, state = scratch_path(spark, "stream-dedupe"), scratch_path(spark, "stream-state")
    for _ in range(2):
        raw = stream_raw(spark, folder, files_per_batch=files)
        land_stream(enrich_stream(raw, FREQUENT), out, state, delay_days=8)
    landed = spark.read.schema(LANDED).parquet(out)
    return landed.filter(F.col("arrival").isin("post", "untimed")).agg(
        F.count(F.lit(1)).alias("post_count"),
        F.count_if(F.col("created_at") == "some day").alias("without_time"),
        F.count_if(F.col("id") == "").alias("without_id"),
        F.sum("like_count").alias("likes"),
    )


@query(
    "stream_arrivals",
    """
WITH p AS (SELECT doc_id, CAST(1 + doc_id // 30 % 28 AS INTEGER) AS d FROM documents),
m AS (SELECT max(d) AS m FROM p),
c AS (SELECT doc_id, doc_id % 11 = 0 AS untimed, doc_id % 11 <> 0 AND doc_id % 5 = 0 AND d <= m - 18 AS late FROM p, m),
a AS (
  SELECT doc_id, CASE WHEN untimed THEN 'untimed' WHEN late THEN 'late' ELSE 'post' END AS arrival FROM c
  UNION ALL SELECT doc_id, 'repeat' FROM c WHERE NOT late)
SELECT arrival, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS likes, (SELECT count(*) FROM a) AS rows_in FROM a GROUP BY 1""",
)
def q_stream_arrivals(spark, sf):
    """Posts, repeats, late and untimed rows add up to all that came in, over many batches and a restart.

    Every post comes on its day and again two days later, but a fifth of the early ones only after
    all others; every eleventh has no time.
    """
    posts = _day_posts(spark, sf)
    last = posts.agg(F.max("batch")).first()[0] or 0
    late = (F.col("batch") <= last - 18) & (F.col("like_count") % 5 == 0) & (F.col("created_at") != "some day")
    again = posts.filter(~late).withColumn("batch", F.col("batch") + 2)
    sent = posts.withColumn("batch", F.when(late, F.lit(last + 3)).otherwise(F.col("batch"))).union(again)
    folder, files = _landed(spark, sent, "stream-arrivals")
    out, state = scratch_path(spark, "stream-arrivals"), scratch_path(spark, "stream-state")
    for _ in range(2):
        land_stream(enrich_stream(stream_raw(spark, folder, files_per_batch=files), FREQUENT), out, state, delay_days=8)
    rows_in = spark.read.text(folder).agg(F.count(F.lit(1))).scalar()
    return spark.read.schema(LANDED).parquet(out).groupBy("arrival").agg(
        F.count(F.lit(1)).alias("n"), F.sum("like_count").alias("likes")
    ).withColumn("rows_in", rows_in)


@query(
    "stream_sliding_counts",
    """
WITH starts AS (
  SELECT unnest(generate_series((SELECT CAST(min(ts) AS DATE) - 6 FROM events)::TIMESTAMP,
                                (SELECT CAST(max(ts) AS DATE) FROM events)::TIMESTAMP, INTERVAL 1 DAY)) AS s)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(s + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
       count(*) AS post_count
FROM starts JOIN events ON ts >= s AND ts < s + INTERVAL 7 DAY
WHERE s + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL 2 DAY FROM events) GROUP BY s""",
)
def q_stream_sliding_counts(spark, sf):
    """Overlapping weeks as a stream: a window comes out when the watermark, two days behind, has passed its end."""
    out, state = scratch_path(spark, "stream-sliding"), scratch_path(spark, "stream-state")
    events = spark.readStream.schema(v.table(spark, sf, "events").schema).parquet(f"{sf}/events.parque[t]")
    posts = events.select(F.col("event_id").cast("string").alias("id"), F.col("ts").cast("timestamp_ntz").alias("created_ts"))
    counts = sliding_stream(posts, delay="2 days")
    run_available(counts, out, state)
    stamp = lambda name: F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
    return spark.read.schema(counts.schema).parquet(out).select(stamp("window_start"), stamp("window_end"), "post_count")


@query(
    "stream_late_rows",
    """
WITH p AS (SELECT doc_id, CAST(1 + doc_id // 30 % 28 AS INTEGER) AS d FROM documents WHERE doc_id % 11 <> 0),
m AS (SELECT max(d) AS m FROM p), late AS (SELECT doc_id FROM p, m WHERE d <= m - 18 AND doc_id % 5 = 0)
SELECT strftime(DATE '2023-12-31' + d, '%Y-%m-%d') AS event_day, count(*) AS post_count, CAST(sum(doc_id) AS BIGINT) AS total_engagement,
       (SELECT count(*) > 0 FROM late) AS turned_away
FROM p, m WHERE d <= m - 5 AND doc_id NOT IN (SELECT doc_id FROM late) GROUP BY 1""",
)
def q_stream_late_rows(spark, sf):
    """A fifth of the early posts arrives after all others: too late, and turned away.

    Days come out once the watermark, four days behind, has passed their end; the last stay open.
    """
    posts = _day_posts(spark, sf).filter("created_at <> 'some day'")
    last = posts.agg(F.max("batch")).first()[0] or 0
    late = (F.col("batch") <= last - 18) & (F.col("like_count") % 5 == 0)
    folder, files = _landed(spark, posts.withColumn("batch", F.when(late, F.lit(last + 1)).otherwise(F.col("batch"))), "stream-late")
    out, state = scratch_path(spark, "stream-late"), scratch_path(spark, "stream-state")
    summary = lambda: tumbling_summary(enrich_stream(stream_raw(spark, folder, files_per_batch=files), FREQUENT), delay="4 days")
    query_ = run_available(summary(), out, state)
    return spark.read.schema(summary().schema).parquet(out).select(
        "event_day", "post_count", "total_engagement", F.lit(dropped_rows(query_) > 0).alias("turned_away")
    )


@query(
    "stream_merge",
    "SELECT strftime(ts, '%Y-%m-%d') AS event_day, count(*) AS post_count, count(DISTINCT event_id) AS distinct_posts FROM events GROUP BY 1",
)
def q_stream_merge(spark, sf):
    """Batches merged by id; running the stream anew from the start changes nothing."""
    out, posts = scratch_path(spark, "stream-merge"), event_stream(spark, sf)
    for _ in range(2):
        merge_stream(posts, out, scratch_path(spark, "stream-state"))
    return spark.read.schema(ENRICHED).parquet(out).groupBy("event_day").agg(
        F.count(F.lit(1)).alias("post_count"), F.count_distinct("id").alias("distinct_posts")
    )


@query(
    "stream_landed_posts",
    "SELECT role AS source, count(*) AS post_count, CAST(sum(turn) AS BIGINT) AS likes FROM conversations GROUP BY 1",
)
def q_stream_landed_posts(spark, sf):
    """JSON lines land in a folder and are ingested file by file."""
    landed, out = scratch_path(spark, "landed"), scratch_path(spark, "stream-landed")
    turns = v.table(spark, sf, "conversations")
    metrics = F.struct(F.col("turn").alias("like_count")).alias("public_metrics")
    post = F.struct(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.lit("2024-01-01T00:00:00.000Z").alias("created_at"),
        "text",
        F.col("role").alias("source"),
        metrics,
    )
    turns.select(F.to_json(post).alias("value")).write.text(landed)
    run_available(
        enrich_stream(stream_raw(spark, landed), FREQUENT).drop("created_ts"), out, scratch_path(spark, "stream-state")
    )
    return spark.read.schema(ENRICHED).parquet(out).groupBy("source").agg(
        F.count(F.lit(1)).alias("post_count"), F.sum("like_count").alias("likes")
    )
