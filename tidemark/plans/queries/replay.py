"""Run windows: overlapping replay, incremental reads, backfill, dates and paths."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.dates import (
    event_day,
    event_partition_path,
    path_date,
    posts_partition_path,
    run_stamp,
    summary_partition_path,
    utc_instant,
)
from tidemark.operators import sketches
from tidemark.operators import windows as win
from tidemark.operators.attempts import last_good_run
from tidemark.operators.dedupe import first_per_key, last_per_key
from tidemark.operators.ledger import cumulative_distinct, missing_from, present_in, unknown_to
from tidemark.plans import views as v
from tidemark.plans.registry import query
from tidemark.session import scratch_path


def _stamp(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


@query(
    "run_windows",
    v.with_ctes(v.SQL_RUNS, body="""
SELECT run, strftime(run_ts, '%Y-%m-%d %H:%M:%S') AS run_ts, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end FROM runs"""),
)
def q_run_windows(spark, sf):
    return v.runs(spark, sf).select("run", _stamp("run_ts"), _stamp("window_start"), _stamp("window_end"))


@query(
    "window_replay",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, body="""
SELECT run, id, like_count FROM runs JOIN facts ON created_ts >= window_start AND created_ts < window_end"""),
)
def q_window_replay(spark, sf):
    posts = v.facts(spark, sf).select("id", "created_ts", "like_count")
    return win.replay(posts, v.runs(spark, sf)).select("run", "id", "like_count")


@query(
    "backfill_replay",
    v.with_ctes(v.SQL_FACTS, body="""
SELECT CAST(0 AS BIGINT) AS run, source, count(*) AS replayed, CAST(sum(like_count) AS BIGINT) AS likes FROM facts GROUP BY source"""),
)
def q_backfill_replay(spark, sf):
    """One window over the whole history finds every post once."""
    posts = v.facts(spark, sf).select("id", "created_ts", "like_count", "source")
    found = win.replay(posts, win.backfill_run(posts))
    return found.groupBy("run", "source").agg(F.count(F.lit(1)).alias("replayed"), F.sum("like_count").alias("likes"))


@query(
    "incremental_replay",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, v.SQL_ATTEMPTS, v.SQL_STATES, body="""
, spans AS (
  SELECT run, coalesce(high_water, (SELECT min(window_end) - INTERVAL 1 DAY FROM runs)) AS window_start, window_end FROM marked)
SELECT run, count(*) AS replayed, CAST(sum(like_count) AS BIGINT) AS likes
FROM spans JOIN facts ON created_ts >= window_start AND created_ts < window_end GROUP BY run"""),
)
def q_incremental_replay(spark, sf):
    """Windows that reach back to the last good run, however long ago that was."""
    posts = v.facts(spark, sf).select("id", "created_ts", "like_count")
    found = win.replay(posts, win.incremental_windows(v.RunBook(spark, sf).states))
    return found.groupBy("run").agg(F.count(F.lit(1)).alias("replayed"), F.sum("like_count").alias("likes"))


@query(
    "window_replay_right_closed",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, body="""
SELECT run, count(*) AS replayed, CAST(sum(like_count) AS BIGINT) AS likes
FROM runs JOIN facts ON created_ts > window_start AND created_ts <= window_end GROUP BY run"""),
)
def q_window_replay_right(spark, sf):
    posts = v.facts(spark, sf).select("id", "created_ts", "like_count")
    return (
        win.replay(posts, v.runs(spark, sf), closed="right")
        .groupBy("run")
        .agg(F.count(F.lit(1)).alias("replayed"), F.sum("like_count").alias("likes"))
    )


@query(
    "run_extract_counts",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, body="""
SELECT run, count(id) AS extracted, count(DISTINCT id) AS distinct_extracted
FROM runs LEFT JOIN facts ON created_ts >= window_start AND created_ts < window_end GROUP BY run"""),
)
def q_run_extract_counts(spark, sf):
    return win.run_extracts(v.instants(spark, sf), v.runs(spark, sf))


@query(
    "author_window_counts",
    v.with_ctes(v.SQL_RUNS, body="""
SELECT run, count(user_id) AS extracted, count(DISTINCT user_id) AS distinct_extracted
FROM runs LEFT JOIN events ON ts > window_start AND ts <= window_end GROUP BY run"""),
)
def q_author_window_counts(spark, sf):
    """The same counts over a key that comes back on many days, with right-closed windows."""
    seen = v.table(spark, sf, "events").select(
        F.col("user_id").alias("id"), F.col("ts").cast("timestamp_ntz").alias("created_ts")
    )
    return win.run_extracts(seen, v.runs(spark, sf), closed="right")


@query(
    "duplication_factor",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, body="""
SELECT count(*) AS rows_in_lake, count(DISTINCT id) AS distinct_posts, count(*) / count(DISTINCT id) AS duplication_factor
FROM runs JOIN facts ON created_ts >= window_start AND created_ts < window_end"""),
)
def q_duplication_factor(spark, sf):
    return win.duplication_factor(v.instants(spark, sf), v.runs(spark, sf))


_ODD_RUNS_SQL = """
odd_runs AS (
  SELECT run, window_start + to_minutes(run * 37 % 600) AS window_start, window_end + to_minutes(run * 53 % 900 - 300) AS window_end FROM runs)
"""


def odd_runs(spark, sf):
    """The runs with windows that begin and end at hours and minutes of their own."""
    minutes = lambda c, n: F.expr(f"{c} + make_dt_interval(0, 0, {n})")
    return v.runs(spark, sf).withColumns({"window_start": minutes("window_start", "run * 37 % 600"), "window_end": minutes("window_end", "run * 53 % 900 - 300")})


@query(
    "run_extract_counts_any_instant",
    v.with_ctes(v.SQL_RUNS, _ODD_RUNS_SQL, body="""
SELECT run, count(user_id) AS extracted, count(DISTINCT user_id) AS distinct_extracted
FROM odd_runs LEFT JOIN events ON ts >= window_start AND ts < window_end GROUP BY run"""),
)
def q_run_extract_counts_any_instant(spark, sf):
    """Rows and authors of windows that do not begin at midnight, from counts between neighbouring edges."""
    seen = v.table(spark, sf, "events").select(F.col("user_id").alias("id"), F.col("ts").cast("timestamp_ntz").alias("created_ts"))
    return win.run_extracts(seen, odd_runs(spark, sf))


@query(
    "duplication_any_instant",
    v.with_ctes(v.SQL_RUNS, _ODD_RUNS_SQL, body="""
SELECT count(*) AS rows_in_lake, count(DISTINCT event_id) AS distinct_posts, count(*) / count(DISTINCT event_id) AS duplication_factor
FROM odd_runs JOIN events ON ts > window_start AND ts <= window_end"""),
)
def q_duplication_any_instant(spark, sf):
    return win.duplication_factor(v.instants(spark, sf), odd_runs(spark, sf), closed="right")


def stored_sketches(spark, sf):
    """Sketches of the events' authors, stored in two batches of which one is written twice."""
    root = scratch_path(spark, "sketches")
    seen = v.table(spark, sf, "events").select("event_id", F.col("user_id").alias("id"), F.col("ts").cast("timestamp_ntz").alias("created_ts"))
    for rest in (0, 1, 0):
        sketches.write_sketches(sketches.slot_sketches(seen.filter(F.col("event_id") % 2 == rest)), root, f"part-{rest}")
    return seen.drop("event_id"), sketches.read_sketches(spark, root)


def _near(estimate: str, exact: str):
    """Whether an estimate lies within its stated bound of the exact count."""
    return F.abs(F.col(estimate) - F.col(exact)) <= sketches.error_bound() * F.col(exact)


@query(
    "sketched_extract_counts",
    v.with_ctes(v.SQL_RUNS, body="""
SELECT run, count(user_id) AS extracted, count(DISTINCT user_id) AS distinct_extracted, true AS within_bound
FROM runs LEFT JOIN events ON ts >= window_start AND ts < window_end GROUP BY run"""),
)
def q_sketched_extract_counts(spark, sf):
    """Distinct authors of every window from stored sketches, beside the exact counts that they are held against."""
    seen, stored = stored_sketches(spark, sf)
    runs = v.runs(spark, sf)
    exact = win.run_extracts(seen, runs).select("run", "distinct_extracted")
    return sketches.window_estimates(stored, runs).join(exact, "run").select(
        "run", "extracted", "distinct_extracted", _near("distinct_estimate", "distinct_extracted").alias("within_bound")
    )


@query(
    "sketched_duplication",
    v.with_ctes(v.SQL_RUNS, body="""
SELECT count(*) AS rows_in_lake, count(DISTINCT user_id) AS distinct_posts, true AS within_bound
FROM runs JOIN events ON ts >= window_start AND ts < window_end"""),
)
def q_sketched_duplication(spark, sf):
    """The duplication factor of the overlapping windows without a shuffle of ids, against the exact one."""
    seen, stored = stored_sketches(spark, sf)
    runs = v.runs(spark, sf)
    exact = win.duplication_factor(seen, runs).select("distinct_posts").scalar()
    return sketches.approximate_duplication(stored, runs).withColumn("distinct_posts", exact).select(
        "rows_in_lake", "distinct_posts", _near("distinct_estimate", "distinct_posts").alias("within_bound")
    )


@query(
    "sketched_cumulative_posts",
    """
WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
f AS (SELECT user_id, min(CAST(ts AS DATE)) AS first FROM events GROUP BY 1)
SELECT strftime(day, '%Y-%m-%d') AS day, (SELECT count(*) FROM events WHERE CAST(ts AS DATE) <= day) AS rows_so_far,
       (SELECT count(*) FROM f WHERE first <= day) AS distinct_so_far, true AS within_bound
FROM d""",
)
def q_sketched_cumulative_posts(spark, sf):
    seen, stored = stored_sketches(spark, sf)
    day = F.col("created_ts").cast("date")
    firsts = seen.groupBy("id").agg(F.min(day).alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("fresh"))
    far = sketches.cumulative_estimates(stored).withColumn("day", F.col("slot").cast("date")).join(firsts, "day", "left")
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = far.withColumn("distinct_so_far", F.coalesce(F.sum("fresh").over(upto), F.lit(0)))
    return counted.select(
        F.col("day").cast("string").alias("day"), "rows_so_far", "distinct_so_far", _near("distinct_estimate", "distinct_so_far").alias("within_bound")
    )


@query(
    "last_window_posts",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, body="""
SELECT id, created_at FROM facts
WHERE created_ts >= (SELECT max(window_end) FROM runs) - INTERVAL 7 DAY AND created_ts < (SELECT max(window_end) FROM runs)"""),
)
def q_last_window_posts(spark, sf):
    """Half-open window of the last run; the bounds are scalars, so the scan filters directly."""
    end = v.runs(spark, sf).agg(F.max("window_end")).scalar()
    start = v.runs(spark, sf).agg(F.max_by("window_start", "run")).scalar()
    return v.facts(spark, sf).filter(win.in_window(F.col("created_ts"), start, end)).select("id", "created_at")


@query(
    "one_day_posts",
    v.with_ctes(v.SQL_FACTS, body="""
SELECT source, count(*) AS post_count, CAST(sum(like_count) AS BIGINT) AS likes
FROM facts WHERE created_ts >= TIMESTAMP '2024-01-15' AND created_ts < TIMESTAMP '2024-01-16' GROUP BY source"""),
)
def q_one_day_posts(spark, sf):
    day = win.in_window(
        F.col("created_ts"), F.lit("2024-01-15").cast("timestamp_ntz"), F.lit("2024-01-16").cast("timestamp_ntz")
    )
    return v.facts(spark, sf).filter(day).groupBy("source").agg(
        F.count(F.lit(1)).alias("post_count"), F.sum("like_count").alias("likes")
    )


_STATE_SQL = (v.SQL_RUNS, v.SQL_ATTEMPTS, v.SQL_STATES)


@query(
    "carried_high_water",
    v.with_ctes(*_STATE_SQL, body="""
SELECT run, state, strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end,
       strftime(high_water, '%Y-%m-%d %H:%M:%S') AS high_water FROM marked"""),
)
def q_carried_high_water(spark, sf):
    return win.high_water(v.RunBook(spark, sf).states).select("run", "state", _stamp("window_end"), _stamp("high_water"))


@query(
    "last_good_run",
    v.with_ctes(*_STATE_SQL, body="""
SELECT max(run) AS run, strftime(max(window_end), '%Y-%m-%d %H:%M:%S') AS window_end FROM states WHERE state = 'success'"""),
)
def q_last_good_run(spark, sf):
    return last_good_run(v.RunBook(spark, sf).states).select("run", _stamp("window_end"))


@query(
    "posts_after_high_water",
    v.with_ctes(v.SQL_FACTS, *_STATE_SQL, body="""
SELECT id, created_at FROM facts
WHERE (SELECT max(window_end) FROM states WHERE state = 'success') IS NULL
   OR created_ts >= (SELECT max(window_end) FROM states WHERE state = 'success')"""),
)
def q_posts_after_high_water(spark, sf):
    return win.newer_than_last_good(v.facts(spark, sf), v.RunBook(spark, sf).states).select("id", "created_at")


@query(
    "incremental_reads",
    v.with_ctes(v.SQL_FACTS, *_STATE_SQL, body="""
, spans AS (
  SELECT run, state, window_end, coalesce(high_water, (SELECT min(window_end) - INTERVAL 1 DAY FROM runs)) AS window_start FROM marked)
SELECT run, count(id) AS extracted, count(DISTINCT id) AS distinct_extracted
FROM spans LEFT JOIN facts ON created_ts >= window_start AND created_ts < window_end GROUP BY run"""),
)
def q_incremental_reads(spark, sf):
    """Each run reads from where the last successful one ended."""
    return win.run_extracts(v.instants(spark, sf), win.incremental_windows(v.RunBook(spark, sf).states))


@query(
    "sliding_window_counts",
    """
WITH starts AS (
  SELECT unnest(generate_series((SELECT CAST(min(ts) AS DATE) - 6 FROM events)::TIMESTAMP,
                                (SELECT CAST(max(ts) AS DATE) FROM events)::TIMESTAMP, INTERVAL 1 DAY)) AS s)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(s + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
       count(*) AS post_count
FROM starts JOIN events ON ts >= s AND ts < s + INTERVAL 7 DAY GROUP BY s""",
)
def q_sliding_window_counts(spark, sf):
    return win.sliding_counts(v.instants(spark, sf)).select(_stamp("window_start"), _stamp("window_end"), "post_count")


@query(
    "backfill_layouts",
    v.with_ctes(v.SQL_FACTS, body=f"""
, span AS (SELECT max(CAST(created_ts AS DATE)) + INTERVAL 1 DAY AS run_ts FROM facts)
SELECT 'event_date' AS layout, '{v.PREFIX}/posts/year=' || strftime(created_ts, '%Y/month=%m/day=%d') AS partition, count(*) AS rows
FROM facts GROUP BY 2
UNION ALL
SELECT 'run_date', '{v.PREFIX}/posts/year=' || strftime(run_ts, '%Y/month=%m/day=%d'), (SELECT count(*) FROM facts) FROM span"""),
)
def q_backfill_layouts(spark, sf):
    """One run over the whole history: a single run-date partition, or one partition per day."""
    posts = v.instants(spark, sf)
    run = win.backfill_run(posts)
    counts = win.run_slots(run).join(win.slot_counts(posts), "slot_date")
    by_event = counts.groupBy(event_partition_path(v.PREFIX, F.col("event_day")).alias("partition")).agg(
        F.sum("rows").alias("rows")
    )
    by_run = counts.join(run, "run").groupBy(posts_partition_path(v.PREFIX, F.col("run_ts")).alias("partition")).agg(
        F.sum("rows").alias("rows")
    )
    named = lambda df, name: df.select(F.lit(name).alias("layout"), "partition", "rows")
    return named(by_event, "event_date").unionByName(named(by_run, "run_date"))


@query(
    "cumulative_distinct",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, v.SQL_ATTEMPTS, body="""
, seen AS (
  SELECT id, min(run) AS run FROM runs JOIN facts ON created_ts >= window_start AND created_ts < window_end
  WHERE run IN (SELECT run FROM attempts WHERE task = 'load') GROUP BY id),
fresh AS (SELECT run, count(*) AS new_posts FROM seen GROUP BY run)
SELECT run, new_posts, CAST(sum(new_posts) OVER (ORDER BY run) AS BIGINT) AS distinct_posts FROM fresh"""),
)
def q_cumulative_distinct(spark, sf):
    book = v.RunBook(spark, sf)
    return cumulative_distinct(
        v.instants(spark, sf), book.runs, book.load_attempts, win.slot_date(F.col("created_ts"))
    )


_LAKE_IDS_SQL = """
, lake AS (
  SELECT DISTINCT id FROM runs JOIN facts ON created_ts >= window_start AND created_ts < window_end
  WHERE run IN (SELECT run FROM attempts WHERE task = 'load'))
"""


def stored_posts(facts, book):
    """Posts that some run with a load attempt wrote, one row per post: a filter on their slot."""
    reached = (
        win.run_slots(book.runs)
        .join(book.load_attempts.select("run").distinct(), "run", "left_semi")
        .select("slot_date")
        .distinct()
    )
    dated = facts.withColumn("slot_date", win.slot_date(F.col("created_ts")))
    return dated.join(reached, "slot_date", "left_semi").drop("slot_date")


@query(
    "stored_posts_in_source",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, v.SQL_ATTEMPTS, body=_LAKE_IDS_SQL + """
SELECT source, count(*) AS post_count FROM facts JOIN lake USING (id) GROUP BY source"""),
)
def q_stored_in_source(spark, sf):
    facts = v.facts(spark, sf)
    ids = present_in(stored_posts(facts.select("id", "created_ts"), v.RunBook(spark, sf)), facts)
    return facts.join(ids, "id").groupBy("source").agg(F.count(F.lit(1)).alias("post_count"))


@query(
    "posts_missing_from_lake",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, v.SQL_ATTEMPTS, body=_LAKE_IDS_SQL + """
SELECT id, created_at FROM facts WHERE id NOT IN (SELECT id FROM lake)"""),
)
def q_missing_from_lake(spark, sf):
    facts = v.facts(spark, sf)
    lake = stored_posts(facts.select("id", "created_ts"), v.RunBook(spark, sf))
    return missing_from(lake, facts.select("id", "created_at"))


@query(
    "lake_posts_unknown_to_source",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, v.SQL_ATTEMPTS, body=_LAKE_IDS_SQL + """
SELECT id, created_at FROM facts JOIN lake USING (id) WHERE source = 'signup'"""),
)
def q_unknown_to_source(spark, sf):
    """Against a source that has withdrawn its signup posts."""
    source = v.facts(spark, sf).filter(F.col("source") != "signup")
    lake = stored_posts(v.facts(spark, sf).select("id", "created_at", "created_ts"), v.RunBook(spark, sf))
    return unknown_to(source, lake.drop("created_ts"))


@query(
    "order_lines_coverage",
    """
SELECT (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)) AS known_orders,
       (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS orders_without_lines,
       (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS lines_without_order""",
)
def q_order_lines_coverage(spark, sf):
    """Overlap and both anti-joins over the two largest tables; ids are reduced before joining."""
    lines = v.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"))
    orders = v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    per_line_id = lines.groupBy("id").agg(F.count(F.lit(1)).alias("lines"))
    per_order_id = orders.groupBy("id").agg(F.count(F.lit(1)).alias("orders"))
    both = per_line_id.join(per_order_id, "id", "full_outer")
    return both.agg(
        F.count_if(F.col("lines").isNotNull() & F.col("orders").isNotNull()).alias("known_orders"),
        F.coalesce(F.sum(F.when(F.col("lines").isNull(), F.col("orders"))), F.lit(0)).alias("orders_without_lines"),
        F.coalesce(F.sum(F.when(F.col("orders").isNull(), F.col("lines"))), F.lit(0)).alias("lines_without_order"),
    )


@query(
    "distinct_ids",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, body="""
SELECT DISTINCT id FROM runs JOIN facts ON created_ts >= window_start AND created_ts < window_end"""),
)
def q_distinct_ids(spark, sf):
    return win.window_copies(v.instants(spark, sf), v.runs(spark, sf)).select("id").distinct()


@query(
    "first_post_per_author",
    "SELECT user_id, arg_min(event_id, ts) AS event_id, arg_min(event_type, ts) AS event_type FROM events GROUP BY user_id",
)
def q_first_per_author(spark, sf):
    """Keep-first on a repeating key with an explicit order."""
    events = v.table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return first_per_key(events, ["user_id"], [F.col("ts"), F.col("event_id")]).drop("ts")


@query(
    "deduplicated_generations",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, body="""
, copies AS (
  SELECT id, run, like_count + run AS like_count FROM runs JOIN facts ON created_ts >= window_start AND created_ts < window_end)
SELECT id, max(run) AS run, CAST(arg_max(like_count, run) AS BIGINT) AS like_count, count(*) AS copies FROM copies GROUP BY id"""),
)
def q_deduplicated_generations(spark, sf):
    """Every replayed copy of a post has its run's count; the last run's copy stays."""
    posts = v.facts(spark, sf).select("id", "created_ts", "like_count")
    copies = win.replay(posts, v.runs(spark, sf)).select("id", "run", (F.col("like_count") + F.col("run")).alias("like_count"))
    return last_per_key(copies, ["id"], [F.col("run")], copies="copies")


@query(
    "lake_generations",
    v.with_ctes(v.SQL_FACTS, body="""
SELECT generation, source, count(*) AS post_count FROM (
  SELECT 1 AS generation, source FROM facts UNION ALL SELECT 2, source FROM facts WHERE like_count >= 1000) GROUP BY ALL"""),
)
def q_lake_generations(spark, sf):
    """Two appended generations stay side by side."""
    facts = v.facts(spark, sf).select("id", "source", "like_count")
    first = facts.withColumn("generation", F.lit(1).cast("bigint"))
    second = facts.filter(F.col("like_count") >= 1000).withColumn("generation", F.lit(2).cast("bigint"))
    return first.unionByName(second).groupBy("generation", "source").agg(F.count(F.lit(1)).alias("post_count"))


@query(
    "event_days",
    v.with_ctes(v.SQL_FACTS, body="""
SELECT event_day, count(*) AS post_count FROM (
  SELECT CASE WHEN source = 'signup' THEN '' ELSE substr(created_at, 1, 10) END AS event_day FROM facts) GROUP BY 1"""),
)
def q_event_days(spark, sf):
    """First ten characters of the stored time; a null time gives the empty day."""
    created = F.when(F.col("source") != "signup", F.col("created_at"))
    return v.facts(spark, sf).groupBy(event_day(created).alias("event_day")).agg(F.count(F.lit(1)).alias("post_count"))


@query(
    "batch_day_counts",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, body="""
SELECT run, count(DISTINCT substr(created_at, 1, 10)) AS days
FROM runs JOIN facts ON created_ts >= window_start AND created_ts < window_end GROUP BY run"""),
)
def q_batch_day_counts(spark, sf):
    counts = win.run_slots(v.runs(spark, sf)).join(win.slot_counts(v.instants(spark, sf)), "slot_date")
    return counts.groupBy("run").agg(F.count_distinct("event_day").alias("days"))


@query(
    "partition_paths",
    f"""
SELECT '{v.PREFIX}/posts/year=' || strftime(ts, '%Y/month=%m/day=%d') AS posts_path,
       '{v.PREFIX}/daily_summary/run_date=' || strftime(ts, '%Y-%m-%d') AS summary_path,
       count(*) AS posts, count(DISTINCT strftime(ts, '%Y%m%dT%H%M%SZ')) AS stamps, min(strftime(ts, '%Y%m%dT%H%M%SZ')) AS first_stamp
FROM events GROUP BY ALL""",
)
def q_partition_paths(spark, sf):
    at = F.col("created_ts")
    return v.instants(spark, sf).groupBy(
        posts_partition_path(v.PREFIX, at).alias("posts_path"), summary_partition_path(v.PREFIX, at).alias("summary_path")
    ).agg(
        F.count(F.lit(1)).alias("posts"),
        F.count_distinct(run_stamp(at)).alias("stamps"),
        F.min(run_stamp(at)).alias("first_stamp"),
    )


@query(
    "path_dates",
    f"""
SELECT '{v.PREFIX}/posts/year=' || strftime(ts, '%Y/month=%m/day=%d') AS partition, strftime(ts, '%Y-%m-%d') AS day, count(*) AS posts
FROM events GROUP BY ALL""",
)
def q_path_dates(spark, sf):
    """Day string to partition path, and the path back to its date."""
    path = event_partition_path(v.PREFIX, event_day(F.col("created_at")))
    counted = v.facts(spark, sf).groupBy(path.alias("partition")).agg(F.count(F.lit(1)).alias("posts"))
    return counted.select("partition", path_date(F.col("partition")).cast("string").alias("day"), "posts")


@query(
    "parsed_instants",
    v.with_ctes(v.SQL_FACTS, body="""
SELECT id, strftime(created_ts - INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS lookback_from,
       CASE WHEN source = 'error' THEN strftime(created_ts - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(created_ts, '%Y-%m-%d %H:%M:%S') END AS instant
FROM facts"""),
)
def q_parsed_instants(spark, sf):
    """Both spellings of a time parse to UTC instants; error posts carry a +02:00 offset."""
    spaced = F.concat(F.replace(F.substring("created_at", 1, 19), F.lit("T"), F.lit(" ")), F.lit("+02:00"))
    spelled = F.when(F.col("source") == "error", spaced).otherwise(F.col("created_at"))
    instant = utc_instant(spelled)
    back = utc_instant(F.col("created_at")) - F.expr("interval 7 days")
    return v.facts(spark, sf).select(
        "id",
        F.date_format(back, "yyyy-MM-dd HH:mm:ss").alias("lookback_from"),
        F.date_format(instant, "yyyy-MM-dd HH:mm:ss").alias("instant"),
    )
