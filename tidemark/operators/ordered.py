"""Running sums and neighbours over a whole table in order, without one task that sorts it all.

The rows are dealt out by ranges of their order and written once, so that a range keeps its number.
Each range is then worked on by itself; what it needs of the ranges before it (a sum, the last row)
is one row per range, and only those rows meet in one task. A range is sorted within its task, and
the order has to be total (end it with a unique column), or ties stand in no fixed order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle

_PART = "_part"


def ranges(df: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """``df`` in ranges of ``order``, numbered from first to last in ``_part``; nulls come first."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settle(df.repartitionByRange(n, *order).withColumn(_PART, F.spark_partition_id()), "ranges")


def _before(ranged: DataFrame, value: str) -> DataFrame:
    """Per range, its total and the total of all ranges before it."""
    totals = ranged.groupBy(_PART).agg(F.coalesce(F.sum(value), F.lit(0)).alias("_total"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))


def _local(order: list[str]) -> Window:
    return Window.partitionBy(_PART).orderBy(*order)


def running_sum(df: DataFrame, order: list[str], value: str, out: str = "running", parts: int | None = None) -> DataFrame:
    """Append the sum of ``value`` up to and including each row, all rows taken in ``order``; null adds nothing."""
    ranged = ranges(df, order, parts)
    upto = _local(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.coalesce(F.sum(value).over(upto), F.lit(0))
    return ranged.join(_before(ranged, value), _PART).withColumn(out, F.col("_before") + own).select(*df.columns, out)


def crossings(df: DataFrame, order: list[str], value: str, limits: list[int], parts: int | None = None) -> DataFrame:
    """For each limit the row at which the running sum of ``value`` (never negative) first passes it.

    Columns: ``passed_limit``, those of ``df``, ``position`` (rows up to and including this one) and
    ``running``. A limit that is never passed gives no row. Only the ranges in which a limit falls are
    sorted; of all others nothing but their totals is read.
    """
    ranged = ranges(df, order, parts)
    sized = ranged.groupBy(_PART).agg(F.coalesce(F.sum(value), F.lit(0)).alias("_total"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sized = sized.select(_PART, "_total", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("_total", "_rows")])
    wanted = sized.withColumn("passed_limit", F.explode(F.array(*[F.lit(x).cast("bigint") for x in limits])))
    wanted = wanted.filter((F.col("_total_before") <= F.col("passed_limit")) & (F.col("_total_before") + F.col("_total") > F.col("passed_limit")))
    upto = _local(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A range is summed once, however many limits fall into it.
    near = ranged.join(wanted.select(_PART).distinct(), _PART, "left_semi").withColumns(
        {"_own": F.coalesce(F.sum(value).over(upto), F.lit(0)), "_at": F.row_number().over(_local(order)), "_value": F.coalesce(F.col(value), F.lit(0))}
    )
    summed = near.join(wanted, _PART).withColumns({"running": F.col("_total_before") + F.col("_own"), "position": F.col("_rows_before") + F.col("_at")})
    passing = (F.col("running") > F.col("passed_limit")) & (F.col("running") - F.col("_value") <= F.col("passed_limit"))
    return summed.filter(passing).select("passed_limit", *df.columns, "position", "running")


def with_previous(df: DataFrame, order: list[str], values: list[str], prefix: str = "previous_", parts: int | None = None) -> DataFrame:
    """Append the values of the row before, all rows taken in ``order``; null at the first row."""
    ranged = ranges(df, order, parts)
    key = F.struct(*order)
    row = F.struct(*[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    lasts = ranged.groupBy(_PART).agg(F.max_by(row, key).alias("_last"))
    carried = lasts.select(_PART, F.lag("_last").over(Window.orderBy(_PART)).alias("_carried"))
    joined = ranged.join(carried, _PART)
    first = F.row_number().over(_local(order)) == 1

    def back(i: int, value: str) -> Column:
        return F.when(first, F.col("_carried").getField(f"v{i}")).otherwise(F.lag(value).over(_local(order)))

    return joined.select(*df.columns, *[back(i, v).alias(f"{prefix}{v}") for i, v in enumerate(values)])
