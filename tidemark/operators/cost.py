"""Object sizes, size fits and the bill."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import round_half_up

# Unit sizes of the price list and the assumed query load.
BYTES_PER_GB = 1e9
BYTES_PER_TB = 1e12
QUERIES_PER_MONTH = 1000


def size_segments(points: DataFrame) -> DataFrame:
    """Straight segments between measured points: ``[low_rows, high_rows)`` and their line.

    Below the first point the size is flat; past the last one the last slope goes on.
    """
    w = Window.partitionBy("dataset").orderBy("rows")
    laid = points.select(
        "dataset",
        "rows",
        "bytes",
        F.lead("rows").over(w).alias("next_rows"),
        F.lead("bytes").over(w).alias("next_bytes"),
        F.lag("rows").over(w).alias("prev_rows"),
        F.lag("bytes").over(w).alias("prev_bytes"),
        F.max("rows").over(Window.partitionBy("dataset")).alias("measured_to"),
    )
    rise = F.coalesce(F.col("next_bytes") - F.col("bytes"), F.col("bytes") - F.col("prev_bytes"))
    run = F.coalesce(F.col("next_rows") - F.col("rows"), F.col("rows") - F.col("prev_rows"))
    first = F.col("prev_rows").isNull()
    return laid.select(
        "dataset",
        F.when(first, F.lit(-(2**62))).otherwise(F.col("rows")).cast("bigint").alias("low_rows"),
        F.coalesce("next_rows", F.lit(2**62)).cast("bigint").alias("high_rows"),
        F.col("rows").alias("at_rows"),
        F.col("bytes").alias("at_bytes"),
        rise.alias("rise"),
        run.alias("run_rows"),
        "measured_to",
    )


def estimate_bytes(objects: DataFrame, points: DataFrame) -> DataFrame:
    """Adds ``bytes`` and ``extrapolated`` to objects that have ``dataset`` and ``rows``.

    The segments of a dataset are one array, joined by dataset name and searched inside the row: the
    joined table has one row per dataset, whatever the number of segments.
    """
    seg = size_segments(points).groupBy("dataset").agg(
        F.collect_list(F.struct("low_rows", "high_rows", "at_rows", "at_bytes", "rise", "run_rows", "measured_to")).alias("segments")
    )
    inside = F.filter("segments", lambda s: (F.col("rows") >= s["low_rows"]) & (F.col("rows") < s["high_rows"]))
    joined = objects.join(seg.withColumnRenamed("dataset", "_dataset"), F.col("dataset") == F.col("_dataset"), "left").withColumn("s", F.get(inside, F.lit(0)))
    past = F.greatest(F.col("rows") - F.col("s.at_rows"), F.lit(0))
    line = F.col("s.at_bytes") + past / F.col("s.run_rows") * F.col("s.rise")
    # The last segment goes on by slope, earlier ones by share of the way: same value, other rounding.
    beyond = F.col("s.at_bytes") + (F.col("s.rise") / F.col("s.run_rows")) * past
    size = round_half_up(F.when(F.col("s.at_rows") == F.col("s.measured_to"), beyond).otherwise(line))
    return joined.select(
        *[objects[c] for c in objects.columns],
        F.when(F.col("rows") <= 0, F.lit(0)).otherwise(size).cast("bigint").alias("bytes"),
        (F.col("rows") > F.col("s.measured_to")).alias("extrapolated"),
    )


def latest_sizes(measured: DataFrame) -> DataFrame:
    """One size per row count: the last measurement wins. ``measured`` is ``rows, bytes, seq``."""
    return measured.groupBy("rows").agg(F.max_by("bytes", "seq").alias("bytes"))


def fit_sizes(points: DataFrame) -> DataFrame:
    """Least-squares ``bytes = overhead + per_row * rows``, one row."""
    return points.agg(
        F.regr_intercept("bytes", "rows").alias("overhead_bytes"),
        F.regr_slope("bytes", "rows").alias("bytes_per_row"),
        F.count(F.lit(1)).alias("points"),
    )


def first_crossing(series: DataFrame, order: str, value: str, limit: float) -> DataFrame:
    """Where a growing series passes ``limit``, interpolated between its neighbours; one row.

    ``series`` has one row per step (a batch size or a run), not per post. Empty when the series
    never crosses; the first step itself when it already lies above.
    """
    w = Window.orderBy(order)
    steps = series.select(
        F.col(order).cast("double").alias("x"),
        F.col(value).cast("double").alias("y"),
        F.lag(F.col(order).cast("double")).over(w).alias("x0"),
        F.lag(F.col(value).cast("double")).over(w).alias("y0"),
    )
    at = F.when(F.col("x0").isNull(), F.col("x")).otherwise(
        F.col("x0") + (F.lit(float(limit)) - F.col("y0")) / (F.col("y") - F.col("y0")) * (F.col("x") - F.col("x0"))
    )
    over = steps.filter((F.col("y") > limit) & (F.col("x0").isNull() | (F.col("y0") <= limit)))
    return over.orderBy("x").limit(1).select(round_half_up(at).alias("crossing"))


def object_sizes(objects: DataFrame) -> DataFrame:
    """Objects, total bytes and average object size per dataset."""
    return objects.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("objects"),
        F.sum("bytes").alias("total_bytes"),
        (F.sum("bytes") / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("avg_bytes"),
    )


def cost_report(usage: DataFrame, price_list: DataFrame, queries_per_month: int = QUERIES_PER_MONTH) -> DataFrame:
    """The bill for usage rows with ``bytes, put_requests, scan_bytes``.

    The price list is turned into one row of columns and read as scalars, so no join is needed.
    """
    def price(name: str):
        return price_list.filter(F.col("name") == name).agg(F.max("value")).scalar()

    storage = F.col("bytes") / BYTES_PER_GB * price("storage_gb_month")
    puts = F.col("put_requests") * price("put_request")
    per_query = F.col("scan_bytes") / BYTES_PER_TB * price("scan_tb")
    return (
        usage.withColumn("storage_usd", storage)
        .withColumn("put_usd", puts)
        .withColumn("per_query_usd", per_query)
        .withColumn("query_usd", F.col("per_query_usd") * queries_per_month)
        .withColumn("total_usd", F.col("storage_usd") + F.col("put_usd") + F.col("query_usd"))
    )
