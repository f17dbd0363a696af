"""Lake audits. Each returns a DataFrame; an empty or all-true result means the lake is sound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import path_date
from tidemark.operators.ledger import live_objects, missing_from, partition_rows
from tidemark.operators.ordered import with_previous


def rows_balance(writes: DataFrame) -> DataFrame:
    """Standing rows per dataset against rows written less rows overwritten."""
    objects = live_objects(writes).groupBy("dataset").agg(F.sum("rows").alias("standing_rows"))
    last = writes.groupBy("dataset", "key").agg(
        F.sum("rows").alias("written"), (F.sum("rows") - F.max_by("rows", "seq")).alias("overwritten")
    )
    flow = last.groupBy("dataset").agg(
        F.sum("written").alias("written_rows"), F.sum("overwritten").alias("overwritten_rows")
    )
    return objects.join(flow, "dataset").withColumn(
        "balanced", F.col("standing_rows") == F.col("written_rows") - F.col("overwritten_rows")
    )


def put_balance(writes: DataFrame) -> DataFrame:
    """PUTs counted from the log against the sum of per-object write counts, one row."""
    per_key = live_objects(writes).agg(
        F.sum("writes").alias("object_writes"), F.count(F.lit(1)).alias("objects")
    )
    puts = writes.agg(F.count(F.lit(1))).scalar()
    return per_key.withColumn("put_requests", puts).select(
        "put_requests",
        "object_writes",
        "objects",
        ((F.col("put_requests") == F.col("object_writes")) & (F.col("put_requests") >= F.col("objects"))).alias("balanced"),
    )


def distinct_bounds(lake: DataFrame, source: DataFrame, copies: str | None = None) -> DataFrame:
    """Rows, distinct ids, source ids and ids the source lacks, one row.

    ``copies`` names a column that says how often the lake holds a row, if rows stand for several.
    """
    unknown = missing_from(source, lake.select("id").distinct()).agg(F.count(F.lit(1))).scalar()
    rows = F.coalesce(F.sum(copies), F.lit(0)).cast("bigint") if copies else F.count(F.lit(1))
    totals = lake.agg(rows.alias("rows_in_lake"), F.count_distinct("id").alias("distinct_posts"))
    return totals.withColumns(
        {"source_posts": source.agg(F.count_distinct("id")).scalar(), "unknown_posts": unknown}
    ).withColumn(
        "sound",
        (F.col("distinct_posts") <= F.col("rows_in_lake"))
        & (F.col("distinct_posts") <= F.col("source_posts"))
        & (F.col("unknown_posts") == 0),
    )


def decreasing_steps(series: DataFrame, values: list[str], order: str | list[str] = "run") -> DataFrame:
    """Steps of a series where some value fell, with the values of the step before. Empty for a lake
    that never shrinks.

    A series may have a row per run or per post: it is compared range by range of ``order``, whose
    last column has to be unique.
    """
    back = with_previous(series, [order] if isinstance(order, str) else order, values)
    fell = F.lit(False)
    for value in values:
        fell = fell | F.coalesce(F.col(value) < F.col(f"previous_{value}"), F.lit(False))
    return back.filter(fell)


def lost_posts(lake: DataFrame, source: DataFrame, upto: Column) -> DataFrame:
    """Source posts before ``upto`` (the last good window end) that the lake lacks.

    Without duplicates a lake still may have lost data, so this is checked apart from the factor.
    """
    due = source.filter(F.coalesce(F.col("created_ts") < upto, F.lit(False)))
    return missing_from(lake, due)


def misplaced_posts(lake: DataFrame) -> DataFrame:
    """Rows whose ``partition`` path names another date than their own ``event_day``."""
    at = path_date(F.col("partition")).cast("string")
    return lake.filter(~at.eqNullSafe(F.nullif(F.col("event_day"), F.lit(""))))


def partition_skew(run_date_objects: DataFrame, event_date_objects: DataFrame) -> DataFrame:
    """Rows per partition path under both layouts, side by side."""
    a = partition_rows(run_date_objects).select("partition", F.col("rows").alias("run_date_rows"))
    b = partition_rows(event_date_objects).select("partition", F.col("rows").alias("event_date_rows"))
    return a.join(b, "partition", "full_outer").select(
        "partition",
        F.coalesce("run_date_rows", F.lit(0)).alias("run_date_rows"),
        F.coalesce("event_date_rows", F.lit(0)).alias("event_date_rows"),
    )


def small_files(inventory: DataFrame, overhead_bytes: float, small: int = 128 * 1024 * 1024) -> DataFrame:
    """Objects, bytes, undersized objects and the share of bytes that is fixed overhead, one row."""
    return inventory.agg(
        F.count(F.lit(1)).alias("objects"),
        F.sum("bytes").alias("total_bytes"),
        F.avg("bytes").alias("avg_bytes"),
        F.count_if(F.col("bytes") < small).alias("small_objects"),
        (F.count(F.lit(1)) * F.lit(overhead_bytes) / F.sum("bytes")).alias("overhead_share"),
    )
