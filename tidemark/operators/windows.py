"""Run windows: schedules, overlapping replay, high-water marks.

A *slot* is the first scheduled run instant at or after a post: every post falls in one slot, and a
window is a contiguous range of slots. A *cell* is the stretch between two neighbouring window edges,
at whatever instants those lie; a window is a range of cells, from the cell that its start opens to the
one before its end. Posts are aggregated per slot or cell first, so what meets the run table is one
row per cell, not seven copies of every post.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: days the recent-search window reaches back.
LOOKBACK_DAYS = 7

def _days(column: str, n: int) -> Column:
    return F.expr(f"{column} + make_dt_interval({n})")


def schedule(posts: DataFrame, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Daily runs covering the posts: ``run, run_ts, window_start, window_end``.

    Run 0 happens at the midnight after the first post's day. One row per calendar day.
    """
    day = F.col("created_ts").cast("date")
    span = posts.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return (
        span.select("first", F.explode(F.expr("sequence(date_add(first, 1), date_add(last, 1))")).alias("d"))
        .select(
            (F.datediff("d", "first") - 1).cast("bigint").alias("run"),
            F.col("d").cast("timestamp_ntz").alias("run_ts"),
        )
        .withColumn("window_start", _days("run_ts", -lookback_days))
        .withColumn("window_end", F.col("run_ts"))
    )


def backfill_run(posts: DataFrame) -> DataFrame:
    """One run whose window holds the whole history."""
    day = F.col("created_ts").cast("date")
    return posts.agg(
        F.date_add(F.max(day), 1).cast("timestamp_ntz").alias("run_ts"),
        F.min(day).cast("timestamp_ntz").alias("window_start"),
    ).select(F.lit(0).cast("bigint").alias("run"), "run_ts", "window_start", F.col("run_ts").alias("window_end"))


def in_window(instant: Column, start: Column, end: Column, closed: str = "left") -> Column:
    """``[start, end)`` for ``left``, ``(start, end]`` for ``right``."""
    if closed == "left":
        return (instant >= start) & (instant < end)
    if closed == "right":
        return (instant > start) & (instant <= end)
    raise ValueError("closed must be 'left' or 'right'")


def slot_date(instant: Column, closed: str = "left") -> Column:
    """The date of the first midnight run whose window holds the instant."""
    day = instant.cast("date")
    if closed == "right":
        return F.when(instant == day.cast("timestamp_ntz"), day).otherwise(F.date_add(day, 1))
    return F.date_add(day, 1)


def replay(posts: DataFrame, runs: DataFrame, closed: str = "left") -> DataFrame:
    """Every (run, post) pair of overlapping windows, as an equi-join on the post's slot.

    The plain range condition plans as a nested loop over posts and runs. A post has one slot, and
    a window of any length lists its own; the exact bounds are checked on the joined rows, so
    windows may begin and end at any instant.
    """
    dated = posts.withColumn("slot_date", slot_date(F.col("created_ts"), closed))
    reach = run_slots(runs).join(runs, "run")
    return dated.join(reach, "slot_date").filter(
        in_window(F.col("created_ts"), F.col("window_start"), F.col("window_end"), closed)
    )


def run_slots(runs: DataFrame) -> DataFrame:
    """``run, slot_date`` for every slot that a run's window touches; bounded by runs x window days."""
    return runs.filter(F.col("window_start") < F.col("window_end")).select(
        "run",
        F.explode(
            F.expr("sequence(date_add(cast(window_start as date), 1), date_add(cast(window_end - interval 1 microsecond as date), 1))")
        ).alias("slot_date"),
    )


def _hour(instant: Column) -> Column:
    """The number of an instant's hour."""
    return F.datediff(instant.cast("date"), F.lit("1970-01-01").cast("date")) * 24 + F.hour(instant)


def edge_ranks(runs: DataFrame) -> DataFrame:
    """For each hour from the first window edge to the last: ``hour``, how many edges come ``before`` it,
    and its own ``edges``.

    One row per hour of the schedule's span, so the table and its window grow with the calendar.
    """
    edges = runs.filter(F.col("window_start") < F.col("window_end")).select(F.explode(F.array("window_start", "window_end")).alias("edge")).distinct()
    held = edges.groupBy(_hour(F.col("edge")).alias("hour")).agg(F.collect_list("edge").alias("edges"))
    span = held.agg(F.min("hour").alias("first"), F.max("hour").alias("last")).filter("first is not null")
    hours = span.select(F.explode(F.sequence("first", "last")).alias("hour")).join(held, "hour", "left")
    n = F.coalesce(F.size("edges"), F.lit(0))
    earlier = Window.orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    return hours.select("hour", F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias("before"), F.coalesce("edges", F.array().cast("array<timestamp_ntz>")).alias("edges"))


def with_cell(rows: DataFrame, instant: str, ranks: DataFrame, cell: str = "cell", closed: str = "left") -> DataFrame:
    """Rows within the schedule's span, with the number of window edges up to their instant.

    A post at an edge comes after it if windows hold their start (``left``), else before it.
    """
    passed = (lambda e: e <= F.col(instant)) if closed == "left" else (lambda e: e < F.col(instant))
    dated = rows.withColumn("_hour", _hour(F.col(instant)))
    joined = dated.join(ranks, F.col("_hour") == F.col("hour"))
    return joined.withColumn(cell, F.col("before") + F.size(F.filter("edges", passed))).drop("_hour", "hour", "before", "edges")


def run_cells(runs: DataFrame, ranks: DataFrame) -> DataFrame:
    """``run, first_cell, end_cell``: a window holds the cells from the first to the one before the end."""
    spans = runs.filter(F.col("window_start") < F.col("window_end"))
    marked = with_cell(with_cell(spans, "window_start", ranks, "first_cell"), "window_end", ranks, "end_cell")
    return marked.select("run", "first_cell", "end_cell")


def cell_coverage(spans: DataFrame) -> DataFrame:
    """``cell, windows`` for every cell that some window holds: a sweep over the edges, no window's cells are listed."""
    steps = spans.select(F.explode(F.array(F.struct(F.col("first_cell").alias("cell"), F.lit(1).alias("step")), F.struct(F.col("end_cell").alias("cell"), F.lit(-1).alias("step")))).alias("s"))
    by_cell = steps.groupBy("s.cell").agg(F.sum("s.step").alias("step"))
    swept = by_cell.withColumn("windows", F.sum("step").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # Each edge opens a cell of its own, so no cell is skipped.
    return swept.filter("windows > 0").select("cell", "windows")


def slot_counts(posts: DataFrame, closed: str = "left") -> DataFrame:
    """Rows per slot and event day: the one full pass over the posts."""
    return posts.groupBy(
        slot_date(F.col("created_ts"), closed).alias("slot_date"),
        F.col("created_ts").cast("date").cast("string").alias("event_day"),
    ).agg(F.count(F.lit(1)).alias("rows"))


def run_extracts(posts: DataFrame, runs: DataFrame, closed: str = "left") -> DataFrame:
    """``run, extracted, distinct_extracted`` without copying posts into every window.

    Windows may begin and end at any instant. Rows are counted per cell; a window's rows are the
    difference of two cumulative counts at its edges. An id with several cells is counted once per
    window: at its first cell inside it. So ids are reduced to counts by (cell, previous cell of the
    same id), a table bounded by the edges, and a window takes the entries whose previous cell lies
    before it.
    """
    ranks = edge_ranks(runs)
    spans = run_cells(runs, ranks)
    celled = with_cell(posts.select("id", "created_ts"), "created_ts", ranks, closed=closed)
    per_id = celled.groupBy("id").agg(F.array_sort(F.collect_set("cell")).alias("cells"))
    firsts = (
        per_id.select(F.posexplode("cells").alias("i", "cell"), "cells")
        .groupBy("cell", F.get("cells", F.col("i") - 1).alias("previous"))
        .agg(F.count(F.lit(1)).alias("ids"))
    )
    counts = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))
    edges = spans.select(F.explode(F.array("first_cell", "end_cell")).alias("cell")).distinct()
    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    swept = edges.join(counts, "cell", "full_outer").select("cell", F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("rows_before"))
    start = swept.select(F.col("cell").alias("first_cell"), F.col("rows_before").alias("at_start"))
    end = swept.select(F.col("cell").alias("end_cell"), F.col("rows_before").alias("at_end"))
    extracted = spans.join(start, "first_cell").join(end, "end_cell").select("run", (F.col("at_end") - F.col("at_start")).alias("extracted"))
    distinct = (
        spans.select("run", "first_cell", F.explode(F.expr("sequence(first_cell, end_cell - 1)")).alias("cell"))
        .join(firsts, "cell")
        .filter(F.col("previous").isNull() | (F.col("previous") < F.col("first_cell")))
        .groupBy("run")
        .agg(F.sum("ids").alias("distinct_extracted"))
    )
    return runs.select("run").join(extracted, "run", "left").join(distinct, "run", "left").select(
        "run",
        F.coalesce("extracted", F.lit(0)).cast("bigint").alias("extracted"),
        F.coalesce("distinct_extracted", F.lit(0)).cast("bigint").alias("distinct_extracted"),
    )


def high_water(runs: DataFrame) -> DataFrame:
    """Adds ``high_water``: the latest window end of an earlier successful run, null before any.

    The window has one row per scheduled run.
    """
    good = F.when(F.col("state") == "success", F.col("window_end"))
    earlier = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    return runs.withColumn("high_water", F.max(good).over(earlier))


def incremental_windows(runs: DataFrame) -> DataFrame:
    """Windows that start where the last successful run ended, or at the start of the schedule."""
    origin = _days("min_end", -1)
    marked = high_water(runs).withColumn("min_end", F.min("window_end").over(Window.partitionBy()))
    return marked.withColumn("window_start", F.coalesce(F.col("high_water"), origin)).drop("min_end")


def newer_than_last_good(posts: DataFrame, runs: DataFrame, closed: str = "left") -> DataFrame:
    """Posts past the last successful run's window end. All posts when no run succeeded."""
    mark = runs.filter(F.col("state") == "success").agg(F.max("window_end")).scalar()
    after = F.col("created_ts") > mark if closed == "right" else F.col("created_ts") >= mark
    return posts.filter(mark.isNull() | after)


def duplication_factor(posts: DataFrame, runs: DataFrame, closed: str = "left") -> DataFrame:
    """Replayed rows, distinct ids and their ratio (0 for an empty lake), one row."""
    covered = window_copies(posts.select("id", "created_ts"), runs, closed)
    per_id = covered.groupBy("id").agg(F.sum("copies").alias("rows"))
    totals = per_id.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows_in_lake"),
        F.count(F.lit(1)).alias("distinct_posts"),
    )
    return totals.withColumn(
        "duplication_factor",
        F.when(F.col("distinct_posts") == 0, 0.0).otherwise(F.col("rows_in_lake") / F.col("distinct_posts")),
    )


def window_copies(posts: DataFrame, runs: DataFrame, closed: str = "left") -> DataFrame:
    """Posts that some window holds, with ``copies``: how many windows do. Nothing is copied."""
    ranks = edge_ranks(runs)
    covered = cell_coverage(run_cells(runs, ranks)).withColumnRenamed("windows", "copies")
    return with_cell(posts, "created_ts", ranks, "_cell", closed).join(covered.withColumnRenamed("cell", "_cell"), "_cell").drop("_cell")


def sliding_counts(posts: DataFrame, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Posts per sliding window of ``lookback_days`` advancing daily, ``[start, end)``."""
    span = F.window("created_ts", f"{lookback_days} days", "1 day")
    return posts.groupBy(span.alias("w")).agg(F.count(F.lit(1)).alias("post_count")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "post_count"
    )
