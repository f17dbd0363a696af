"""Approximate distinct counts from mergeable sketches, one per time slot.

A theta sketch of a slot's ids is made once, in the pass that counts the slot's rows, and kept in a
table of its own. Any later question about distinct ids, over windows, runs or the whole history,
unites the sketches of its slots: no ids are shuffled again, and posts are not read.

Up to ``2 ** lg_k`` distinct ids the answer is exact; beyond, its relative standard error is
``1 / sqrt(2 ** lg_k)``. ``error_bound`` is three times that.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LG_K = 12
RESOLUTIONS = {"day": 86_400, "hour": 3_600}
SLOTS = "slot timestamp_ntz, rows bigint, ids binary, batch string"


def error_bound(lg_k: int = LG_K) -> float:
    """The relative error that an estimate keeps in all but one of some hundred cases."""
    return 3 / sqrt(2**lg_k)


def slot_of(instant: Column, resolution: str = "day") -> Column:
    """The beginning of an instant's slot."""
    if resolution not in RESOLUTIONS:
        raise ValueError(f"resolution must be one of {sorted(RESOLUTIONS)}")
    midnight = instant.cast("date").cast("timestamp_ntz")
    return midnight if resolution == "day" else midnight + F.make_dt_interval(hours=F.hour(instant))


def slot_sketches(posts: DataFrame, resolution: str = "day", lg_k: int = LG_K, key: str = "id") -> DataFrame:
    """``slot, rows, ids``: per slot the number of posts and a sketch of their ids, combined on the map side.

    Posts without a time are in no slot. A null id counts as a row but as no id.
    """
    timed = posts.filter(F.col("created_ts").isNotNull())
    return timed.groupBy(slot_of(F.col("created_ts"), resolution).alias("slot")).agg(
        F.count(F.lit(1)).alias("rows"), F.theta_sketch_agg(F.col(key).cast("string"), F.lit(lg_k)).alias("ids")
    )


def write_sketches(sketches: DataFrame, root: str, batch: str) -> None:
    """Store a batch's sketches; writing the same batch again replaces its own and no others."""
    rows = sketches.withColumn("batch", F.lit(batch))
    rows.coalesce(1).write.partitionBy("batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(root)


def read_sketches(spark: SparkSession, root: str, lg_k: int = LG_K) -> DataFrame:
    """``slot, rows, ids`` over all stored batches: ids that come back in a later batch count once."""
    stored = spark.read.schema(SLOTS).parquet(root)
    return stored.groupBy("slot").agg(F.sum("rows").alias("rows"), F.theta_union_agg("ids", F.lit(lg_k)).alias("ids"))


def window_estimates(sketches: DataFrame, runs: DataFrame, resolution: str = "day", lg_k: int = LG_K) -> DataFrame:
    """``run, extracted, distinct_estimate`` of every window, from its slots' sketches.

    Windows are ``[start, end)`` and must begin and end where slots do; one that does not raises an
    error. What is joined and united is bounded by the calendar.
    """
    step = F.make_dt_interval(secs=F.lit(RESOLUTIONS[resolution]))
    aligned = (F.col("window_start") == slot_of(F.col("window_start"), resolution)) & (F.col("window_end") == slot_of(F.col("window_end"), resolution))
    end = F.when(aligned, F.col("window_end")).otherwise(F.raise_error(F.lit(f"windows must begin and end at a full {resolution}")).cast("timestamp_ntz"))
    spans = runs.withColumn("_end", end).filter(F.col("window_start") < F.col("_end"))
    slots = spans.select("run", F.explode(F.sequence("window_start", F.col("_end") - step, step)).alias("slot"))
    found = slots.join(sketches, "slot").groupBy("run").agg(F.sum("rows").alias("extracted"), F.theta_sketch_estimate(F.theta_union_agg("ids", F.lit(lg_k))).alias("n"))
    return runs.select("run").join(found, "run", "left").select(
        "run", F.coalesce("extracted", F.lit(0)).cast("bigint").alias("extracted"), F.coalesce("n", F.lit(0)).cast("bigint").alias("distinct_estimate")
    )


def approximate_duplication(sketches: DataFrame, runs: DataFrame, resolution: str = "day", lg_k: int = LG_K) -> DataFrame:
    """Replayed rows, estimated distinct ids and their ratio (0 for an empty lake), one row."""
    rows = window_estimates(sketches, runs, resolution, lg_k).agg(F.coalesce(F.sum("extracted"), F.lit(0)).alias("rows_in_lake"))
    spans = runs.filter(F.col("window_start") < F.col("window_end"))
    step = F.make_dt_interval(secs=F.lit(RESOLUTIONS[resolution]))
    reached = spans.select(F.explode(F.sequence("window_start", F.col("window_end") - step, step)).alias("slot")).distinct()
    ids = sketches.join(reached, "slot", "left_semi").agg(F.coalesce(F.theta_sketch_estimate(F.theta_union_agg("ids", F.lit(lg_k))), F.lit(0)).alias("n")).scalar()
    return rows.withColumn("distinct_estimate", ids.cast("bigint")).withColumn(
        "duplication_factor", F.when(F.col("distinct_estimate") == 0, 0.0).otherwise(F.col("rows_in_lake") / F.col("distinct_estimate"))
    )


def cumulative_estimates(sketches: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """``slot, rows_so_far, distinct_estimate``: all that came up to each slot. One row per slot is windowed."""
    upto = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sketches.select(
        "slot",
        F.sum("rows").over(upto).alias("rows_so_far"),
        F.theta_sketch_estimate(F.theta_union_agg("ids", F.lit(lg_k)).over(upto)).cast("bigint").alias("distinct_estimate"),
    )
