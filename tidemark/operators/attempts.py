"""Task-attempt logs: ``run, task, task_ord, attempt, state, duration_min``.

A run has a few tasks and a task a few attempts (its retry limit plus one), so a run's group stays
small however large the log is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The schedule's retry settings.
RETRIES = 2
RETRY_DELAY_MIN = 2
TASKS = ["extract", "transform", "load"]


def attempt_rollup(attempts: DataFrame, n_tasks: int = len(TASKS)) -> DataFrame:
    """Per run: attempts, retries, final state and total duration with retry delays."""
    final = attempts.groupBy("run", "task").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("attempt") > 1).alias("retries"),
        F.max_by("state", "attempt").alias("state"),
        F.sum("duration_min").alias("duration"),
        F.count_if(F.col("state") == "up_for_retry").alias("waits"),
    )
    return final.groupBy("run").agg(
        F.sum("attempts").alias("attempts"),
        F.sum("retries").alias("retries"),
        F.when(F.count_if(F.col("state") == "success") == n_tasks, "success").otherwise("failed").alias("state"),
        (F.sum("duration") + F.sum("waits") * RETRY_DELAY_MIN).alias("duration_min"),
    )


def attempt_offsets(attempts: DataFrame) -> DataFrame:
    """Adds ``start_min``: minutes from the run's start, retry delays included."""
    w = Window.partitionBy("run").orderBy("task_ord", "attempt").rowsBetween(Window.unboundedPreceding, -1)
    wait = F.when(F.col("state") == "up_for_retry", RETRY_DELAY_MIN).otherwise(0)
    return attempts.withColumn(
        "start_min", F.coalesce(F.sum(F.col("duration_min") + wait).over(w), F.lit(0)).cast("bigint")
    )


def last_good_run(runs: DataFrame) -> DataFrame:
    """The latest successful run, one row; nulls when none succeeded."""
    return runs.filter(F.col("state") == "success").agg(
        F.max("run").alias("run"), F.max_by("window_end", "run").alias("window_end")
    )


def attempt_totals(attempts: DataFrame) -> DataFrame:
    """Check that completed runs took at least one attempt per task, and count retries; one row."""
    per_run = attempt_rollup(attempts)
    done = F.col("state") == "success"
    return per_run.agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(~done).alias("failed_runs"),
        F.sum("attempts").alias("attempts"),
        F.sum("retries").alias("retries"),
        F.count_if(done & (F.col("attempts") < len(TASKS))).alias("short_runs"),
    )
