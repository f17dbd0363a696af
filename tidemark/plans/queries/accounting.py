"""Write logs, objects, attempts, sizes, cost and the audits over them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import attempts as att
from tidemark.operators import audit, cost, ledger, ordered
from tidemark.operators import windows as win
from tidemark.plans import views as v
from tidemark.plans.queries.replay import stored_posts
from tidemark.plans.registry import query
from tidemark.sources.reference import POSTS_SIZES, PRICES, SUMMARY_SIZES, prices, size_points


def _objects(spark, sf):
    return ledger.live_objects(v.RunBook(spark, sf).as_written)


@query(
    "lake_write_log",
    v.with_ctes(*v.LAKE_SQL, body="SELECT key, dataset, partition, rows, run, attempt FROM writes"),
)
def q_write_log(spark, sf):
    return v.RunBook(spark, sf).as_written.drop("seq")


@query(
    "idempotent_write_log",
    v.with_ctes(*v.IDEMPOTENT_SQL, body="SELECT key, dataset, partition, rows, run, attempt FROM writes"),
)
def q_idempotent_write_log(spark, sf):
    return v.RunBook(spark, sf).idempotent.drop("seq")


@query(
    "live_objects",
    v.with_ctes(*v.IDEMPOTENT_SQL, body="SELECT key, dataset, partition, rows, writes FROM objects"),
)
def q_live_objects(spark, sf):
    return ledger.live_objects(v.RunBook(spark, sf).idempotent).drop("run")


@query(
    "replaced_writes",
    v.with_ctes(*v.IDEMPOTENT_SQL, body="""
SELECT key, run, attempt, row_number() OVER (PARTITION BY key ORDER BY seq) > 1 AS replaced FROM writes"""),
)
def q_replaced_writes(spark, sf):
    return ledger.flag_replaced(v.RunBook(spark, sf).idempotent).select("key", "run", "attempt", "replaced")


@query(
    "summary_objects",
    v.with_ctes(*v.LAKE_SQL, body="SELECT key, rows, writes FROM objects WHERE dataset = 'daily_summary'"),
)
def q_summary_objects(spark, sf):
    return ledger.dataset_objects(_objects(spark, sf), "daily_summary").select("key", "rows", "writes")


@query(
    "partition_rows",
    v.with_ctes(*v.LAKE_SQL, body="""
SELECT partition, CAST(sum(rows) AS BIGINT) AS rows, count(*) AS objects FROM objects WHERE dataset = 'posts'
GROUP BY partition ORDER BY partition"""),
)
def q_partition_rows(spark, sf):
    return ledger.partition_rows(_objects(spark, sf))


@query(
    "lake_totals",
    v.with_ctes(v.SQL_FACTS, *v.LAKE_SQL, body="""
SELECT CAST(sum(rows) FILTER (dataset = 'posts') AS BIGINT) AS rows_in_lake,
       CAST(sum(rows) FILTER (dataset <> 'posts') AS BIGINT) AS summary_rows, count(*) AS objects,
       (SELECT count(DISTINCT id) FROM runs JOIN facts ON created_ts >= window_start AND created_ts < window_end
        WHERE run IN (SELECT run FROM attempts WHERE task = 'load')) AS distinct_posts
FROM objects"""),
)
def q_lake_totals(spark, sf):
    book = v.RunBook(spark, sf)
    return ledger.lake_totals(ledger.live_objects(book.as_written), stored_posts(v.facts(spark, sf), book))


@query(
    "put_and_object_counts",
    v.with_ctes(*v.IDEMPOTENT_SQL, body="""
SELECT dataset, count(*) AS put_requests, count(DISTINCT key) AS objects, count(*) - count(DISTINCT key) AS overwritten
FROM writes GROUP BY dataset"""),
)
def q_put_counts(spark, sf):
    return ledger.put_counts(v.RunBook(spark, sf).idempotent)


@query(
    "largest_partition",
    v.with_ctes(*v.LAKE_SQL, body="""
SELECT partition, rows FROM (SELECT partition, CAST(sum(rows) AS BIGINT) AS rows FROM objects WHERE dataset = 'posts' GROUP BY partition)
ORDER BY rows DESC, partition LIMIT 1"""),
)
def q_largest_partition(spark, sf):
    return ledger.largest_partition(_objects(spark, sf))


@query(
    "cumulative_lake",
    v.with_ctes(*v.IDEMPOTENT_SQL, body="""
, standing AS (
  SELECT r.run, w.key, arg_max(w.rows, w.seq) AS rows, any_value(w.dataset) AS dataset, count(*) AS puts
  FROM (SELECT DISTINCT run FROM writes) r JOIN writes w ON w.run <= r.run GROUP BY r.run, w.key)
SELECT run, CAST(sum(CASE WHEN dataset = 'posts' THEN rows ELSE 0 END) AS BIGINT) AS rows_in_lake,
       CAST(sum(puts) AS BIGINT) AS put_requests, count(*) AS objects
FROM standing GROUP BY run"""),
)
def q_cumulative_lake(spark, sf):
    return ledger.cumulative_lake(v.RunBook(spark, sf).idempotent)


@query(
    "cumulative_lake_as_written",
    v.with_ctes(*v.LAKE_SQL, body="""
, standing AS (
  SELECT r.run, w.key, arg_max(w.rows, w.seq) AS rows, any_value(w.dataset) AS dataset, count(*) AS puts
  FROM (SELECT DISTINCT run FROM writes) r JOIN writes w ON w.run <= r.run GROUP BY r.run, w.key)
SELECT run, CAST(sum(CASE WHEN dataset = 'posts' THEN rows ELSE 0 END) AS BIGINT) AS rows_in_lake,
       CAST(sum(puts) AS BIGINT) AS put_requests, count(*) AS objects
FROM standing GROUP BY run"""),
)
def q_cumulative_lake_as_written(spark, sf):
    return ledger.cumulative_lake(v.RunBook(spark, sf).as_written)


@query(
    "partition_running_rows",
    v.with_ctes(*v.IDEMPOTENT_SQL, body="""
SELECT DISTINCT partition, run,
       CAST(sum(rows) OVER (PARTITION BY partition ORDER BY run RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_rows,
       count(*) OVER (PARTITION BY partition ORDER BY run RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_writes
FROM writes WHERE dataset = 'posts'"""),
)
def q_partition_running_rows(spark, sf):
    return ledger.partition_running_rows(v.RunBook(spark, sf).idempotent)


@query(
    "series_decreases",
    v.with_ctes(v.SQL_RUNS, body="""
, series AS (SELECT run, count(*) AS extracted FROM runs JOIN events ON ts >= window_start AND ts < window_end GROUP BY run),
stepped AS (SELECT *, lag(extracted) OVER (ORDER BY run) AS previous_extracted FROM series)
SELECT run, extracted, previous_extracted FROM stepped WHERE extracted < previous_extracted"""),
)
def q_series_decreases(spark, sf):
    """Runs that read less than the run before."""
    series = win.run_extracts(v.instants(spark, sf), v.runs(spark, sf)).select("run", "extracted")
    return audit.decreasing_steps(series, ["extracted"])


@query(
    "lake_never_shrinks",
    v.with_ctes(*v.IDEMPOTENT_SQL, body="""
, standing AS (
  SELECT r.run, w.key, arg_max(w.rows, w.seq) AS rows, any_value(w.dataset) AS dataset, count(*) AS puts
  FROM (SELECT DISTINCT run FROM writes) r JOIN writes w ON w.run <= r.run GROUP BY r.run, w.key),
series AS (SELECT run, sum(CASE WHEN dataset = 'posts' THEN rows ELSE 0 END) AS rows, sum(puts) AS puts FROM standing GROUP BY run),
steps AS (SELECT *, lag(rows) OVER (ORDER BY run) AS p, lag(puts) OVER (ORDER BY run) AS q FROM series)
SELECT count(*) AS decreasing_runs FROM steps WHERE rows < p OR puts < q"""),
)
def q_lake_never_shrinks(spark, sf):
    fell = audit.decreasing_steps(ledger.cumulative_lake(v.RunBook(spark, sf).idempotent), ["rows_in_lake", "put_requests"])
    return fell.agg(F.count(F.lit(1)).alias("decreasing_runs"))


@query(
    "rows_balance",
    v.with_ctes(*v.IDEMPOTENT_SQL, body="""
, flow AS (SELECT dataset, sum(rows) AS written FROM writes GROUP BY dataset),
live AS (SELECT dataset, sum(rows) AS standing FROM objects GROUP BY dataset)
SELECT dataset, CAST(standing AS BIGINT) AS standing_rows, CAST(written AS BIGINT) AS written_rows,
       CAST(written - standing AS BIGINT) AS overwritten_rows, standing = written - (written - standing) AS balanced
FROM flow JOIN live USING (dataset)"""),
)
def q_rows_balance(spark, sf):
    return audit.rows_balance(v.RunBook(spark, sf).idempotent)


@query(
    "put_balance",
    v.with_ctes(*v.IDEMPOTENT_SQL, body="""
SELECT (SELECT count(*) FROM writes) AS put_requests, CAST(sum(writes) AS BIGINT) AS object_writes, count(*) AS objects, true AS balanced
FROM objects"""),
)
def q_put_balance(spark, sf):
    return audit.put_balance(v.RunBook(spark, sf).idempotent)


@query(
    "distinct_bounds",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, body="""
SELECT count(*) AS rows_in_lake, count(DISTINCT id) AS distinct_posts, (SELECT count(*) FROM events) AS source_posts,
       count(*) FILTER (id NOT IN (SELECT CAST(event_id AS VARCHAR) FROM events)) AS unknown_posts,
       count(DISTINCT id) <= count(*) AND count(DISTINCT id) <= (SELECT count(*) FROM events) AS sound
FROM runs JOIN facts ON created_ts >= window_start AND created_ts < window_end"""),
)
def q_distinct_bounds(spark, sf):
    lake = win.window_copies(v.instants(spark, sf), v.runs(spark, sf))
    return audit.distinct_bounds(lake, v.instants(spark, sf), "copies")


@query(
    "posts_lost_before_last_good_run",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, v.SQL_ATTEMPTS, v.SQL_STATES, body="""
SELECT id, created_at FROM facts
WHERE created_ts < (SELECT max(window_end) FROM states WHERE state = 'success')
  AND (like_count % 10 = 3 OR id NOT IN (SELECT id FROM runs JOIN facts ON created_ts >= window_start AND created_ts < window_end
                 WHERE run IN (SELECT run FROM attempts WHERE task = 'load')))"""),
)
def q_lost_posts(spark, sf):
    book = v.RunBook(spark, sf)
    good = att.last_good_run(book.states).select("window_end").scalar()
    source = v.facts(spark, sf).select("id", "created_at", "created_ts", "like_count")
    # A tenth of the posts never reached this lake.
    lake = stored_posts(source.filter(F.col("like_count") % 10 != 3), book)
    return audit.lost_posts(lake, source, good).select("id", "created_at")


@query(
    "misplaced_posts",
    v.with_ctes(v.SQL_FACTS, v.SQL_RUNS, body="""
SELECT run, count(*) AS misplaced FROM runs JOIN facts ON created_ts >= window_start AND created_ts < window_end
WHERE CAST(run_ts AS DATE) <> CAST(created_ts AS DATE) GROUP BY run"""),
)
def q_misplaced_posts(spark, sf):
    """Under the run-date layout nearly every post lies in another day's partition."""
    from tidemark.functions.dates import event_day, posts_partition_path

    lake = win.replay(v.facts(spark, sf).select("id", "created_at", "created_ts"), v.runs(spark, sf)).select(
        "run",
        event_day(F.col("created_at")).alias("event_day"),
        posts_partition_path(v.PREFIX, F.col("run_ts")).alias("partition"),
    )
    return audit.misplaced_posts(lake).groupBy("run").agg(F.count(F.lit(1)).alias("misplaced"))


@query(
    "partition_skew",
    v.with_ctes(*v.LAKE_SQL, body=f"""
, by_run AS (SELECT partition, sum(rows) AS rows FROM objects WHERE dataset = 'posts' GROUP BY 1),
by_event AS (SELECT '{v.PREFIX}/posts/year=' || strftime(ts, '%Y/month=%m/day=%d') AS partition, count(*) AS rows
             FROM events WHERE CAST(ts AS DATE) IN (
               SELECT CAST(e.ts AS DATE) FROM events e JOIN ({v.with_ctes(v.SQL_RUNS, v.SQL_ATTEMPTS, v.SQL_STATES, body='''
               SELECT run, window_end, coalesce(high_water, (SELECT min(window_end) - INTERVAL 1 DAY FROM runs)) AS window_start FROM marked
               WHERE run IN (SELECT run FROM attempts WHERE task = 'load')''')}) s ON e.ts >= s.window_start AND e.ts < s.window_end)
             GROUP BY 1)
SELECT partition, CAST(coalesce(r.rows, 0) AS BIGINT) AS run_date_rows, CAST(coalesce(e.rows, 0) AS BIGINT) AS event_date_rows
FROM by_run r FULL JOIN by_event e USING (partition)"""),
)
def q_partition_skew(spark, sf):
    book = v.RunBook(spark, sf)
    return audit.partition_skew(ledger.live_objects(book.as_written), ledger.live_objects(book.idempotent))


# ------------------------------------------------------------------------------- attempts


@query(
    "attempt_rollup",
    v.with_ctes(v.SQL_ATTEMPTS, body="""
SELECT run, count(*) AS attempts, count(*) FILTER (attempt > 1) AS retries,
       CASE WHEN count(*) FILTER (state = 'success') = 3 THEN 'success' ELSE 'failed' END AS state,
       CAST(sum(duration_min) + 2 * count(*) FILTER (state = 'up_for_retry') AS BIGINT) AS duration_min
FROM attempts GROUP BY run"""),
)
def q_attempt_rollup(spark, sf):
    return att.attempt_rollup(v.RunBook(spark, sf).attempts)


@query(
    "attempt_offsets",
    v.with_ctes(v.SQL_ATTEMPTS, body="""
SELECT run, task, attempt, state, duration_min,
       CAST(coalesce(sum(duration_min + CASE WHEN state = 'up_for_retry' THEN 2 ELSE 0 END)
            OVER (PARTITION BY run ORDER BY task_ord, attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_min
FROM attempts"""),
)
def q_attempt_offsets(spark, sf):
    return att.attempt_offsets(v.RunBook(spark, sf).attempts).drop("task_ord")


@query(
    "attempt_totals",
    v.with_ctes(v.SQL_ATTEMPTS, body="""
, per_run AS (SELECT run, count(*) AS n, count(*) FILTER (attempt > 1) AS retries, count(*) FILTER (state = 'success') = 3 AS done
              FROM attempts GROUP BY run)
SELECT count(*) AS runs, count(*) FILTER (NOT done) AS failed_runs, CAST(sum(n) AS BIGINT) AS attempts,
       CAST(sum(retries) AS BIGINT) AS retries, count(*) FILTER (done AND n < 3) AS short_runs FROM per_run"""),
)
def q_attempt_totals(spark, sf):
    return att.attempt_totals(v.RunBook(spark, sf).attempts)


# ---------------------------------------------------------------------------- size and cost

_POINT_ROWS = ", ".join(
    [f"('posts', {r}, {b})" for r, b in POSTS_SIZES] + [f"('daily_summary', {r}, {b})" for r, b in SUMMARY_SIZES]
)
SQL_SIZED = f"""
points AS (SELECT * FROM (VALUES {_POINT_ROWS}) t(dataset, prows, pbytes)),
tops AS (SELECT dataset, max(prows) AS top FROM points GROUP BY dataset),
around AS (
  SELECT o.key, o.dataset, o.partition, o.rows, top,
         max(prows) FILTER (prows < o.rows) AS lo, min(prows) FILTER (prows >= o.rows) AS hi,
         min(prows) AS bottom, max(prows) FILTER (prows < top) AS second
  FROM objects o JOIN points p USING (dataset) JOIN tops USING (dataset) GROUP BY ALL),
sized AS (
  SELECT a.key, a.dataset, a.partition, a.rows, a.rows > top AS extrapolated,
         CAST(CASE WHEN a.rows <= 0 THEN 0 WHEN a.rows <= bottom THEN b.pbytes
              WHEN a.rows <= top THEN floor(l.pbytes + (a.rows - lo) / (hi - lo) * (h.pbytes - l.pbytes) + 0.5)
              ELSE floor(t.pbytes + (t.pbytes - s.pbytes) / (top - second) * (a.rows - top) + 0.5) END AS BIGINT) AS bytes
  FROM around a
  LEFT JOIN points l ON l.dataset = a.dataset AND l.prows = lo LEFT JOIN points h ON h.dataset = a.dataset AND h.prows = hi
  LEFT JOIN points b ON b.dataset = a.dataset AND b.prows = bottom LEFT JOIN points t ON t.dataset = a.dataset AND t.prows = top
  LEFT JOIN points s ON s.dataset = a.dataset AND s.prows = second)
"""


def _sized(spark, sf):
    return cost.estimate_bytes(_objects(spark, sf).drop("run", "writes"), size_points(spark))


@query(
    "object_size_estimates",
    v.with_ctes(*v.LAKE_SQL, SQL_SIZED, body="SELECT key, dataset, partition, rows, extrapolated, bytes FROM sized"),
)
def q_object_sizes(spark, sf):
    return _sized(spark, sf)


@query(
    "hourly_size_estimates",
    """
WITH objects AS (
  SELECT strftime(ts, '%Y-%m-%dT%H') || '/' || event_type AS key, 'posts' AS dataset, event_type AS partition, count(*) AS rows
  FROM events GROUP BY ALL),
""" + SQL_SIZED + "SELECT key, rows, bytes, extrapolated FROM sized",
)
def q_hourly_sizes(spark, sf):
    """Small objects: one per hour and event type, between the lower measured points."""
    hour = F.date_format("ts", "yyyy-MM-dd'T'HH")
    objects = v.table(spark, sf, "events").groupBy(F.concat_ws("/", hour, "event_type").alias("key")).agg(
        F.count(F.lit(1)).alias("rows")
    ).withColumn("dataset", F.lit("posts"))
    return cost.estimate_bytes(objects, size_points(spark)).drop("dataset")


@query(
    "object_size_totals",
    v.with_ctes(*v.LAKE_SQL, SQL_SIZED, body="""
SELECT dataset, count(*) AS objects, CAST(sum(bytes) AS BIGINT) AS total_bytes, sum(bytes) / count(*) AS avg_bytes
FROM sized GROUP BY dataset"""),
)
def q_object_size_totals(spark, sf):
    return cost.object_sizes(_sized(spark, sf))


@query(
    "largest_day_bytes",
    v.with_ctes(*v.IDEMPOTENT_SQL, SQL_SIZED, body="""
SELECT partition, bytes FROM (SELECT partition, CAST(sum(bytes) AS BIGINT) AS bytes FROM sized WHERE dataset = 'posts' GROUP BY partition)
ORDER BY bytes DESC, partition LIMIT 1"""),
)
def q_largest_day_bytes(spark, sf):
    objects = ledger.live_objects(v.RunBook(spark, sf).idempotent)
    return ledger.largest_partition(cost.estimate_bytes(objects, size_points(spark)), "bytes")


_SIZE_SOURCE_SQL = """
measured AS (
  SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS rows, sum(strlen(event_type) + strlen(props) + 33) AS bytes, max(event_id) AS seq
  FROM events GROUP BY 1, 2)
"""


def _measured(spark, sf):
    """Serialised bytes against rows, one point per day and event type."""
    size = F.octet_length("event_type") + F.octet_length("props") + 33
    return v.table(spark, sf, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(size.cast("bigint")).alias("bytes"), F.max("event_id").alias("seq")
    )


@query(
    "size_fit",
    v.with_ctes(_SIZE_SOURCE_SQL, body="""
SELECT round(regr_intercept(bytes, rows), 3) AS overhead_bytes, round(regr_slope(bytes, rows), 4) AS bytes_per_row, count(*) AS points
FROM measured"""),
)
def q_size_fit(spark, sf):
    fit = cost.fit_sizes(_measured(spark, sf))
    return fit.select(F.round("overhead_bytes", 3).alias("overhead_bytes"), F.round("bytes_per_row", 4).alias("bytes_per_row"), "points")


@query(
    "latest_sizes",
    v.with_ctes(_SIZE_SOURCE_SQL, body="SELECT rows, CAST(arg_max(bytes, seq) AS BIGINT) AS bytes FROM measured GROUP BY rows"),
)
def q_latest_sizes(spark, sf):
    return cost.latest_sizes(_measured(spark, sf))


@query(
    "payload_crossing",
    v.with_ctes(v.SQL_RUNS, body="""
, series AS (SELECT run + 1 AS days, (SELECT count(*) FROM events WHERE ts < window_end) AS rows FROM runs),
stepped AS (SELECT days, rows, lag(days) OVER (ORDER BY days) AS d0, lag(rows) OVER (ORDER BY days) AS r0 FROM series)
SELECT CAST(floor(d0 + (655.35 - r0) / (rows - r0) * (days - d0) + 0.5) AS BIGINT) AS crossing
FROM stepped WHERE rows > 655.35 AND r0 <= 655.35 ORDER BY days LIMIT 1"""),
)
def q_payload_crossing(spark, sf):
    """The day on which cumulated rows of a hundred bytes pass a 65,535 byte column."""
    book = v.RunBook(spark, sf)
    per_slot = book.counts.groupBy("slot_date").agg(F.sum("rows").alias("rows"))
    daily = per_slot.join(book.runs.select("run", F.col("run_ts").cast("date").alias("slot_date")), "slot_date")
    upto = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    series = daily.select((F.col("run") + 1).alias("days"), F.sum("rows").over(upto).alias("rows"))
    return cost.first_crossing(series, "days", "rows", 655.35)


LIMITS = [65_535, 1 << 20, 4 << 20, 1 << 30]


@query(
    "payload_crossing_posts",
    v.with_ctes(v.SQL_FACTS, body=f"""
, sized AS (
  SELECT id, created_at, strlen(id) + strlen(created_at) + strlen(text) + strlen(f.source) + strlen(CAST(like_count AS VARCHAR)) AS bytes
  FROM facts f JOIN documents d USING (doc_id)),
summed AS (
  SELECT id, bytes, row_number() OVER w AS position, sum(bytes) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
  FROM sized WINDOW w AS (ORDER BY created_at, id)),
limits AS (SELECT unnest([{', '.join(map(str, LIMITS))}]) AS passed_limit)
SELECT CAST(passed_limit AS BIGINT) AS passed_limit, id, CAST(bytes AS BIGINT) AS bytes, position, CAST(running AS BIGINT) AS running
FROM limits JOIN summed ON running > passed_limit AND running - bytes <= passed_limit"""),
)
def q_payload_crossing_posts(spark, sf):
    """The very post at which the bytes of whole rows, in order of time, pass each limit of a payload column."""
    posts = v.posts(spark, sf)
    size = sum((F.octet_length(F.col(c).cast("string")) for c in ("created_at", "text", "source", "like_count")), F.octet_length("id"))
    sized = posts.select("id", "created_at", size.cast("bigint").alias("bytes"))
    return ordered.crossings(sized, ["created_at", "id"], "bytes", LIMITS).select("passed_limit", "id", "bytes", F.col("position").cast("bigint").alias("position"), "running")


@query(
    "running_engagement",
    v.with_ctes(v.SQL_FACTS, body="""
SELECT id, CAST(sum(like_count + retweet_count + reply_count) OVER (ORDER BY created_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running
FROM facts"""),
)
def q_running_engagement(spark, sf):
    """Engagement so far at every single post, range by range of time."""
    posts = v.facts(spark, sf).select("id", "created_at", (F.col("like_count") + F.col("retweet_count") + F.col("reply_count")).alias("engagement"))
    return ordered.running_sum(posts, ["created_at", "id"], "engagement").select("id", "running")


@query(
    "post_series_decreases",
    v.with_ctes(v.SQL_FACTS, body="""
, steps AS (SELECT id, like_count, retweet_count, lag(like_count) OVER w AS previous_like_count, lag(retweet_count) OVER w AS previous_retweet_count
  FROM facts WINDOW w AS (ORDER BY created_at, id))
SELECT id, like_count, retweet_count, previous_like_count, previous_retweet_count FROM steps
WHERE like_count < previous_like_count OR retweet_count < previous_retweet_count"""),
)
def q_post_series_decreases(spark, sf):
    """The monotonicity check on a series with a row per post."""
    series = v.facts(spark, sf).select("created_at", "id", "like_count", "retweet_count")
    return audit.decreasing_steps(series, ["like_count", "retweet_count"], ["created_at", "id"]).drop("created_at")


_PRICE = {name: value for name, value, _ in PRICES}


def _usage_sql(layout: str, scan: str) -> str:
    return f"""
SELECT '{layout}' AS layout, CAST(sum(bytes) AS BIGINT) AS bytes, (SELECT count(*) FROM writes) AS put_requests,
       CAST(({scan}) AS BIGINT) AS scan_bytes FROM sized"""


def _cost_sql(ctes, layout: str, scan: str) -> str:
    usage = v.with_ctes(*ctes, SQL_SIZED, body=_usage_sql(layout, scan))
    return f"""
SELECT layout, bytes, put_requests, scan_bytes, bytes / 1e9 * {_PRICE['storage_gb_month']} AS storage_usd,
       put_requests * {_PRICE['put_request']:e} AS put_usd, scan_bytes / 1e12 * {_PRICE['scan_tb']} AS per_query_usd,
       scan_bytes / 1e12 * {_PRICE['scan_tb']} * 1000 AS query_usd,
       bytes / 1e9 * {_PRICE['storage_gb_month']} + put_requests * {_PRICE['put_request']:e} + scan_bytes / 1e12 * {_PRICE['scan_tb']} * 1000 AS total_usd
FROM ({usage})"""


@query(
    "cost_report",
    _cost_sql(v.LAKE_SQL, "run_date", "SELECT sum(bytes) FROM sized WHERE dataset = 'posts'")
    + " UNION ALL "
    + _cost_sql(
        v.IDEMPOTENT_SQL,
        "event_date",
        "SELECT max(b) FROM (SELECT sum(bytes) AS b FROM sized WHERE dataset = 'posts' GROUP BY partition)",
    ),
)
def q_cost_report(spark, sf):
    """What a month costs under both layouts, with a one-day query a thousand times."""

    def usage(layout, writes, pruned):
        sized = cost.estimate_bytes(ledger.live_objects(writes), size_points(spark))
        posts = ledger.dataset_objects(sized, "posts")
        per_day = posts.groupBy("partition").agg(F.sum("bytes").alias("b"))
        scan = per_day.agg((F.max if pruned else F.sum)("b")).scalar()
        return sized.agg(F.sum("bytes").alias("bytes"), F.sum("writes").alias("put_requests")).select(
            F.lit(layout).alias("layout"), "bytes", "put_requests", scan.alias("scan_bytes")
        )

    book = v.RunBook(spark, sf)
    both = usage("run_date", book.as_written, False).unionByName(usage("event_date", book.idempotent, True))
    return cost.cost_report(both, prices(spark))
