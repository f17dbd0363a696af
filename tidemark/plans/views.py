"""Posts, runs and write logs derived from the given tables, in Spark and in SQL.

Every view covers whole tables. ``event_posts`` carries a short status text and serves the lake
queries; ``posts`` takes its text from ``documents`` and serves the text queries.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import attempts as attempt_ops
from tidemark.operators import ledger
from tidemark.operators.lexicon import NEGATIVE_WORDS, POSITIVE_WORDS
from tidemark.operators.windows import incremental_windows, schedule
from tidemark.session import local_table, settle, spread

PREFIX = "lake"

# Word lists that hit the given texts: the built-in words and the texts' own frequent words.
FREQUENT_POSITIVE = ["the", "and", "der", "que", "with", "les"]
FREQUENT_NEGATIVE = ["of", "is", "und", "la", "no", "for"]
PLUS = POSITIVE_WORDS + FREQUENT_POSITIVE
MINUS = NEGATIVE_WORDS + FREQUENT_NEGATIVE

# Fixed value: a task attempt counts as done when its mean event value reaches this many cents.
DONE_CENTS = 5000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, lang, text`` of all documents, spread over the cores."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per event, without text; ``doc_id`` names the document that holds it."""
    n_docs = table(spark, sf_dir, "documents").agg(F.count(F.lit(1))).scalar()
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("created_at"),
        F.col("ts").cast("timestamp_ntz").alias("created_ts"),
        F.floor(F.col("value") * 100).cast("bigint").alias("like_count"),
        F.get_json_object("props", "$.k").cast("bigint").alias("retweet_count"),
        F.col("user_id").alias("reply_count"),
        F.lit(0).cast("bigint").alias("quote_count"),
        F.col("event_type").alias("source"),
        F.concat_ws(" ", "event_type", "props").alias("status"),
        (F.col("event_id") % n_docs).alias("doc_id"),
    )


POST_COLUMNS = ["id", "created_at", "text", "like_count", "retweet_count", "reply_count", "quote_count", "source"]


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised posts with document text, plus ``created_ts``."""
    joined = facts(spark, sf_dir).join(texts(spark, sf_dir).select("doc_id", "text"), "doc_id")
    return joined.select(*POST_COLUMNS, "created_ts")


def event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised posts with the short status text, plus ``created_ts``."""
    return facts(spark, sf_dir).withColumn("text", F.col("status")).select(*POST_COLUMNS, "created_ts")


def instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, created_ts`` only, for queries that need no more of a post."""
    return facts(spark, sf_dir).select("id", "created_ts")


def lexicon(spark: SparkSession) -> DataFrame:
    rows = [(w, 1) for w in PLUS] + [(w, -1) for w in MINUS]
    return local_table(spark, rows, "token string, polarity int")


class RunBook:
    """Runs, task attempts and write logs read out of the events, from one pass over them.

    The pass counts events by day, third of the day and type: at most fifteen rows per day. That
    table is settled in the shared folder, and everything below starts from it.

    The attempt log: each day is a run, event types stand for tasks, and the thirds of a day are a
    task's attempts. An attempt is done when its mean value reaches ``DONE_CENTS``; later attempts
    then do not happen, and a task starts only when the tasks before it were done.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        events = table(spark, sf_dir, "events").select(
            F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", "value"
        )
        self.cells = settle(
            events.groupBy(
                F.col("ts").cast("date").alias("day"),
                F.expr("hour(ts) div 8 + 1").cast("bigint").alias("third"),
                "event_type",
            ).agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.floor(F.col("value") * 100).cast("bigint")).alias("cents"),
            ),
            "cells",
        )
        self.counts = self.cells.groupBy(
            F.date_add("day", 1).alias("slot_date"), F.col("day").cast("string").alias("event_day")
        ).agg(F.sum("n").alias("rows"))
        self.runs = schedule(self.cells.select(F.col("day").cast("timestamp_ntz").alias("created_ts")))

    @cached_property
    def attempts(self) -> DataFrame:
        return settle(self._attempts(), "attempts")

    def _attempts(self) -> DataFrame:
        first = self.cells.agg(F.min("day")).scalar()
        task = (
            F.when(F.col("event_type").isin("click", "view"), "extract")
            .when(F.col("event_type").isin("error", "signup"), "transform")
            .otherwise("load")
        )
        tried = (
            self.cells.groupBy(F.datediff("day", first).cast("bigint").alias("run"), task.alias("task"), "third")
            .agg(F.sum("n").alias("n"), F.sum("cents").alias("cents"))
            .withColumn("done", F.col("cents") >= F.col("n") * DONE_CENTS)
        )
        # A run has at most nine cells, so these windows see tiny groups after one shuffle by run.
        by_task, by_run = Window.partitionBy("run", "task"), Window.partitionBy("run")
        passed = lambda name: F.max(F.col("done") & (F.col("task") == name)).over(by_run)
        tried = tried.withColumns(
            {
                "done_at": F.min(F.when(F.col("done"), F.col("third"))).over(by_task),
                "last_third": F.max("third").over(by_task),
                "extracted": passed("extract"),
                "transformed": passed("transform"),
            }
        )
        started = (
            (F.col("task") == "extract")
            | ((F.col("task") == "transform") & F.col("extracted"))
            | ((F.col("task") == "load") & F.col("extracted") & F.col("transformed"))
        )
        state = (
            F.when(F.col("done"), "success")
            .when(F.col("third") == F.col("last_third"), "failed")
            .otherwise("up_for_retry")
        )
        ordinal = F.when(F.col("task") == "extract", 1).when(F.col("task") == "transform", 2).otherwise(3)
        return (
            tried.filter(started & (F.col("third") <= F.coalesce("done_at", "last_third")))
            .select(
                "run",
                "task",
                ordinal.cast("bigint").alias("task_ord"),
                F.col("third").alias("attempt"),
                state.alias("state"),
                F.col("n").alias("duration_min"),
            )
        )

    @cached_property
    def load_attempts(self) -> DataFrame:
        return self.attempts.filter(F.col("task") == "load").select("run", "attempt")

    @cached_property
    def states(self) -> DataFrame:
        """Runs with ``state`` from the attempt log; a run without attempts failed."""
        rolled = attempt_ops.attempt_rollup(self.attempts).select("run", "state")
        return self.runs.join(rolled, "run", "left").withColumn("state", F.coalesce("state", F.lit("failed")))

    @cached_property
    def as_written(self) -> DataFrame:
        """The write log of overlapping windows, run-date partitions and stamped keys.

        Settled too: one row per object write, and the accounting queries read it several times.
        """
        return settle(ledger.lake_writes(self.counts, self.runs, self.load_attempts, prefix=PREFIX), "writes")

    @cached_property
    def idempotent(self) -> DataFrame:
        """The write log of incremental windows, event-date partitions and deterministic keys."""
        windows = incremental_windows(self.states)
        log = ledger.lake_writes(
            self.counts, windows, self.load_attempts, ledger.EVENT_DATE, deterministic=True, prefix=PREFIX
        )
        return settle(log, "writes")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily runs with a seven day lookback over the events."""
    return schedule(table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp_ntz").alias("created_ts")))


# --------------------------------------------------------------------------- SQL counterparts

SQL_SPLIT = (
    r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)
SQL_EDGE = ".,!?;:\"''"


def sql_list(items) -> str:
    return ", ".join("'" + str(i).replace("'", "''") + "'" for i in items)


def sql_words(text: str = "text") -> str:
    return f"list_filter(regexp_split_to_array({text}, '{SQL_SPLIT}'), lambda w: w <> '')"


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + body.strip()


SQL_FACTS = """
facts AS (
  SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS created_at, ts AS created_ts,
         CAST(floor(value * 100) AS BIGINT) AS like_count, CAST(props->>'$.k' AS BIGINT) AS retweet_count,
         user_id AS reply_count, CAST(0 AS BIGINT) AS quote_count, event_type AS source,
         event_type || ' ' || props AS status, event_id % (SELECT count(*) FROM documents) AS doc_id
  FROM events)
"""
SQL_WORDS = f"""
raw_words AS (
  SELECT doc_id, generate_subscripts(ws, 1) - 1 AS position, unnest(ws) AS raw
  FROM (SELECT doc_id, {sql_words()} AS ws FROM documents)),
words AS (
  SELECT doc_id, position, raw, lower(trim(raw, '{SQL_EDGE}')) AS token FROM raw_words)
"""
SQL_LEXICON = (
    "lexicon AS (SELECT unnest(["
    + sql_list(PLUS)
    + "]) AS token, 1 AS polarity UNION ALL SELECT unnest(["
    + sql_list(MINUS)
    + "]), -1)"
)
SQL_NET = """
net AS (
  SELECT d.doc_id, d.lang, coalesce(h.positives, 0) AS positives, coalesce(h.negatives, 0) AS negatives,
         coalesce(h.n_tokens, 0) AS n_tokens,
         greatest(-3, least(3, coalesce(h.positives, 0) - coalesce(h.negatives, 0))) AS thirds
  FROM documents d LEFT JOIN (
    SELECT doc_id, count(*) AS n_tokens, count(*) FILTER (polarity = 1) AS positives,
           count(*) FILTER (polarity = -1) AS negatives
    FROM words LEFT JOIN lexicon USING (token) GROUP BY doc_id) h USING (doc_id))
"""
SQL_SCORED = """
scored AS (
  SELECT f.*, n.thirds, CAST(round(n.thirds / 3.0, 4) AS DOUBLE) AS sentiment_score,
         CASE WHEN n.thirds > 0 THEN 'positive' WHEN n.thirds < 0 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
         like_count + retweet_count + reply_count + quote_count AS engagement_total,
         substr(created_at, 1, 10) AS event_day
  FROM facts f JOIN net n USING (doc_id))
"""
SQL_RUNS = """
span AS (SELECT CAST(min(ts) AS DATE) AS first, CAST(max(ts) AS DATE) AS last FROM events),
runs AS (
  SELECT CAST(date_diff('day', first, CAST(d AS DATE)) - 1 AS BIGINT) AS run, d AS run_ts,
         d - INTERVAL 7 DAY AS window_start, d AS window_end
  FROM (SELECT first, unnest(generate_series(first + INTERVAL 1 DAY, last + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM span))
"""
SQL_ATTEMPTS = f"""
cells AS (
  SELECT date_diff('day', (SELECT CAST(min(ts) AS DATE) FROM events), CAST(ts AS DATE)) AS run,
         CASE WHEN event_type IN ('click', 'view') THEN 'extract'
              WHEN event_type IN ('error', 'signup') THEN 'transform' ELSE 'load' END AS task,
         hour(ts) // 8 + 1 AS third, count(*) AS n,
         sum(CAST(floor(value * 100) AS BIGINT)) >= count(*) * {DONE_CENTS} AS done
  FROM events GROUP BY 1, 2, 3),
ends AS (
  SELECT run, task, min(third) FILTER (done) AS done_at, max(third) AS last_third FROM cells GROUP BY 1, 2),
attempts AS (
  SELECT CAST(c.run AS BIGINT) AS run, c.task, CASE c.task WHEN 'extract' THEN 1 WHEN 'transform' THEN 2 ELSE 3 END AS task_ord,
         CAST(third AS BIGINT) AS attempt, n AS duration_min,
         CASE WHEN done THEN 'success' WHEN third = last_third THEN 'failed' ELSE 'up_for_retry' END AS state
  FROM cells c JOIN ends e ON c.run = e.run AND c.task = e.task
  WHERE third <= coalesce(done_at, last_third)
    AND (c.task = 'extract' OR EXISTS (SELECT 1 FROM ends x WHERE x.run = c.run AND x.task = 'extract' AND x.done_at IS NOT NULL))
    AND (c.task <> 'load' OR EXISTS (SELECT 1 FROM ends x WHERE x.run = c.run AND x.task = 'transform' AND x.done_at IS NOT NULL)))
"""
SQL_STATES = """
good AS (
  SELECT run FROM attempts WHERE state = 'success' GROUP BY run HAVING count(*) = 3),
states AS (
  SELECT r.*, CASE WHEN g.run IS NULL THEN 'failed' ELSE 'success' END AS state
  FROM runs r LEFT JOIN good g USING (run)),
marked AS (
  SELECT s.*, max(CASE WHEN state = 'success' THEN window_end END)
         OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high_water
  FROM states s)
"""
SQL_WRITES = f"""
write_log AS (
  SELECT '{PREFIX}/posts/year=' || strftime(run_ts, '%Y/month=%m/day=%d') AS partition,
         'posts_' || strftime(run_ts + to_seconds(attempt), '%Y%m%dT%H%M%SZ') || '.parquet' AS name,
         'posts' AS dataset, count(*) AS rows, run, attempt
  FROM runs JOIN attempts USING (run) JOIN events ON ts >= window_start AND ts < window_end
  WHERE task = 'load' GROUP BY ALL
  UNION ALL
  SELECT '{PREFIX}/daily_summary/run_date=' || strftime(run_ts, '%Y-%m-%d'),
         'summary_' || strftime(run_ts + to_seconds(attempt), '%Y%m%dT%H%M%SZ') || '.parquet',
         'daily_summary', count(DISTINCT CAST(ts AS DATE)), run, attempt
  FROM runs JOIN attempts USING (run) JOIN events ON ts >= window_start AND ts < window_end
  WHERE task = 'load' GROUP BY run_ts, run, attempt),
writes AS (
  SELECT partition || '/' || name AS key, dataset, partition, rows, run, attempt, run * 1000000 + attempt AS seq FROM write_log)
"""
SQL_WRITES_IDEMPOTENT = f"""
spans AS (
  SELECT run, run_ts, window_end, coalesce(high_water, (SELECT min(window_end) - INTERVAL 1 DAY FROM runs)) AS window_start
  FROM marked),
write_log AS (
  SELECT '{PREFIX}/posts/year=' || strftime(ts, '%Y/month=%m/day=%d') AS partition, 'posts.parquet' AS name,
         'posts' AS dataset, count(*) AS rows, run, attempt
  FROM spans JOIN attempts USING (run) JOIN events ON ts >= window_start AND ts < window_end
  WHERE task = 'load' GROUP BY ALL
  UNION ALL
  SELECT '{PREFIX}/daily_summary/run_date=' || strftime(run_ts, '%Y-%m-%d'),
         'summary_' || strftime(window_start, '%Y-%m-%d') || '_' || strftime(window_end, '%Y-%m-%d') || '.parquet',
         'daily_summary', count(DISTINCT CAST(ts AS DATE)), run, attempt
  FROM spans JOIN attempts USING (run) JOIN events ON ts >= window_start AND ts < window_end
  WHERE task = 'load' GROUP BY run_ts, window_start, window_end, run, attempt),
writes AS (
  SELECT partition || '/' || name AS key, dataset, partition, rows, run, attempt, run * 1000000 + attempt AS seq FROM write_log)
"""
SQL_OBJECTS = """
objects AS (
  SELECT key, arg_max(dataset, seq) AS dataset, arg_max(partition, seq) AS partition,
         arg_max(rows, seq) AS rows, count(*) AS writes FROM writes GROUP BY key)
"""
LAKE_SQL = (SQL_RUNS, SQL_ATTEMPTS, SQL_WRITES, SQL_OBJECTS)
IDEMPOTENT_SQL = (SQL_RUNS, SQL_ATTEMPTS, SQL_STATES, SQL_WRITES_IDEMPOTENT, SQL_OBJECTS)
