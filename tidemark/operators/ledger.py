"""Lake accounting. An object is its key: writing a key again replaces it and is still a PUT.

The write log (``key, dataset, partition, rows, run, attempt, seq``) may be large and one key may
hold much of it, so per-key results come from map-side combined aggregates. Windows run only over
tables already reduced to one row per run or per (partition, run).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.dates import (
    event_partition_path,
    posts_partition_path,
    run_stamp,
    summary_partition_path,
)
from tidemark.operators.windows import run_slots

RUN_DATE = "run_date"
EVENT_DATE = "event_date"


def write_seq() -> Column:
    """Writes in time order; two writes of one (run, attempt) never share a key."""
    return F.struct("run", F.col("attempt").cast("bigint").alias("attempt"))


def _attempt_stamp() -> Column:
    return run_stamp(F.expr("run_ts + make_dt_interval(0, 0, 0, attempt)"))


def _stamped_name(kind: str) -> Column:
    return F.concat(F.lit(f"{kind}_"), _attempt_stamp(), F.lit(".parquet"))


def _window_name(kind: str) -> Column:
    day = lambda c: F.col(c).cast("date").cast("string")
    return F.concat(F.lit(f"{kind}_"), day("window_start"), F.lit("_"), day("window_end"), F.lit(".parquet"))


def lake_writes(
    counts: DataFrame,
    runs: DataFrame,
    load_attempts: DataFrame,
    layout: str = RUN_DATE,
    deterministic: bool = False,
    prefix: str = "lake",
) -> DataFrame:
    """The write log of a schedule, from per-slot counts.

    ``counts`` is ``slot_date, event_day, rows``; ``load_attempts`` is ``run, attempt``, one row per
    load that reached storage. The run-date layout writes one posts object per attempt, the
    event-date layout one per attempt and day. Stamped keys are new on every attempt,
    deterministic keys name the data. Each attempt also writes one daily_summary object.
    """
    per_day = (
        run_slots(runs).join(counts, "slot_date").groupBy("run", "event_day").agg(F.sum("rows").alias("rows"))
    )
    per_run = per_day.groupBy("run").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("days"))
    attempts = runs.select("run", "run_ts", "window_start", "window_end").join(load_attempts, "run")
    loaded = per_run.join(attempts, "run")
    posts_name = _window_name("posts") if deterministic else _stamped_name("posts")
    summary_name = _window_name("summary") if deterministic else _stamped_name("summary")

    def write(dataset: str, partition: Column, name: Column, rows: str) -> Column:
        return F.struct(
            F.concat(partition, F.lit("/"), name).alias("key"),
            F.lit(dataset).alias("dataset"),
            partition.alias("partition"),
            F.col(rows).cast("bigint").alias("rows"),
            "run",
            F.col("attempt").cast("bigint").alias("attempt"),
            write_seq().alias("seq"),
        )

    summary = write("daily_summary", summary_partition_path(prefix, F.col("run_ts")), summary_name, "days")
    if layout == RUN_DATE:
        posts = write("posts", posts_partition_path(prefix, F.col("run_ts")), posts_name, "rows")
        return loaded.select(F.inline(F.array(posts, summary)))
    posts_name = F.lit("posts.parquet") if deterministic else posts_name
    posts = write("posts", event_partition_path(prefix, F.col("event_day")), posts_name, "rows")
    by_day = per_day.join(attempts, "run").select(F.inline(F.array(posts)))
    return by_day.unionByName(loaded.select(F.inline(F.array(summary))))


def live_objects(writes: DataFrame) -> DataFrame:
    """One row per key as it stands: the last write, and how many writes the key took."""
    return writes.groupBy("key").agg(
        F.max_by(F.struct("dataset", "partition", "rows", "run"), "seq").alias("last"),
        F.count(F.lit(1)).alias("writes"),
    ).select("key", "last.dataset", "last.partition", "last.rows", "last.run", "writes")


def flag_replaced(writes: DataFrame) -> DataFrame:
    """Adds ``replaced``: the write hit a key that already existed."""
    first = writes.groupBy("key").agg(F.min("seq").alias("first_seq"))
    return writes.join(first, "key").withColumn("replaced", F.col("seq") > F.col("first_seq")).drop("first_seq")


def dataset_objects(objects: DataFrame, dataset: str) -> DataFrame:
    return objects.filter(F.col("dataset") == dataset)


def partition_rows(objects: DataFrame) -> DataFrame:
    """Rows and objects per posts partition, in path order."""
    return (
        dataset_objects(objects, "posts")
        .groupBy("partition")
        .agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("objects"))
        .orderBy("partition")
    )


def put_counts(writes: DataFrame) -> DataFrame:
    """PUTs against standing objects; the difference was overwritten."""
    per_key = writes.groupBy("dataset", "key").agg(F.count(F.lit(1)).alias("puts"))
    return per_key.groupBy("dataset").agg(
        F.sum("puts").alias("put_requests"),
        F.count(F.lit(1)).alias("objects"),
        F.sum(F.col("puts") - 1).alias("overwritten"),
    )


def largest_partition(objects: DataFrame, value: str = "rows") -> DataFrame:
    """The posts partition with the largest total, first path on ties, one row."""
    totals = dataset_objects(objects, "posts").groupBy("partition").agg(F.sum(value).alias(value))
    best = F.min_by("partition", F.struct(-F.col(value), F.col("partition")))
    return totals.agg(best.alias("partition"), F.max(value).alias(value))


def _upto_run() -> WindowSpec:
    """All runs up to this one; used on tables with one row per run."""
    return Window.orderBy("run").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def cumulative_lake(writes: DataFrame) -> DataFrame:
    """Rows, PUTs and objects standing after each run, last write winning at every point.

    A key's writes are first reduced to one per run, so the window behind a key holds at most one
    row per run.
    """
    per_key_run = writes.groupBy("key", "run").agg(
        F.max_by("rows", "seq").alias("rows"),
        F.max_by("dataset", "seq").alias("dataset"),
        F.count(F.lit(1)).alias("puts"),
    )
    before = F.lag("rows").over(Window.partitionBy("key").orderBy("run"))
    steps = per_key_run.withColumn("before", before)
    delta = F.when(F.col("dataset") == "posts", F.col("rows") - F.coalesce("before", F.lit(0))).otherwise(0)
    per_run = steps.groupBy("run").agg(
        F.sum(delta).alias("row_delta"),
        F.sum("puts").alias("put_delta"),
        F.count_if(F.col("before").isNull()).alias("object_delta"),
    )
    return per_run.select(
        "run",
        F.sum("row_delta").over(_upto_run()).alias("rows_in_lake"),
        F.sum("put_delta").over(_upto_run()).alias("put_requests"),
        F.sum("object_delta").over(_upto_run()).alias("objects"),
    )


def cumulative_distinct(posts: DataFrame, runs: DataFrame, loaded: DataFrame, slot: Column) -> DataFrame:
    """Distinct posts seen up to each run that wrote: each id counts at the first run it reached.

    ``loaded`` has ``run`` for runs whose load wrote.
    """
    first_run = (
        run_slots(runs).join(loaded.select("run").distinct(), "run", "left_semi")
        .groupBy("slot_date").agg(F.min("run").alias("run"))
    )
    per_id = (
        posts.select("id", slot.alias("slot_date")).join(first_run, "slot_date").groupBy("id").agg(F.min("run").alias("run"))
    )
    fresh = per_id.groupBy("run").agg(F.count(F.lit(1)).alias("new_posts"))
    return fresh.select("run", "new_posts", F.sum("new_posts").over(_upto_run()).alias("distinct_posts"))


def partition_running_rows(writes: DataFrame) -> DataFrame:
    """Rows written into each posts partition up to each run. Counts writes, not standing rows."""
    per_run = (
        dataset_objects(writes, "posts").groupBy("partition", "run")
        .agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("writes"))
    )
    w = Window.partitionBy("partition").orderBy("run").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_run.select(
        "partition",
        "run",
        F.sum("rows").over(w).alias("running_rows"),
        F.sum("writes").over(w).alias("running_writes"),
    )


def present_in(lake: DataFrame, source: DataFrame, key: str = "id") -> DataFrame:
    """Distinct lake ids that the source knows."""
    return lake.select(key).distinct().join(source.select(key), key, "left_semi")


def missing_from(lake: DataFrame, source: DataFrame, key: str = "id") -> DataFrame:
    """Source rows whose id the lake lacks."""
    return source.join(lake.select(key).distinct(), key, "left_anti")


def unknown_to(source: DataFrame, lake: DataFrame, key: str = "id") -> DataFrame:
    """Lake rows whose id the source lacks."""
    return missing_from(source, lake, key)


def lake_totals(objects: DataFrame, lake_ids: DataFrame) -> DataFrame:
    """Rows, summary rows and objects from the objects; distinct ids from the stored ids; one row."""
    is_posts = F.col("dataset") == "posts"
    totals = objects.agg(
        F.coalesce(F.sum(F.when(is_posts, F.col("rows"))), F.lit(0)).alias("rows_in_lake"),
        F.coalesce(F.sum(F.when(~is_posts, F.col("rows"))), F.lit(0)).alias("summary_rows"),
        F.count(F.lit(1)).alias("objects"),
    )
    return totals.withColumn("distinct_posts", lake_ids.agg(F.count_distinct("id")).scalar())
