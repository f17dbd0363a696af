"""Comparing two results, two schemas, or two sets of names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def field_diff(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Keys on one side only, and fields that differ on matched keys: ``key, side, field``.

    ``side`` is ``left_only``, ``right_only`` or ``both``; ``field`` is null for the first two. A null
    key is a key like any other.
    """
    a = left.select(F.col(key).alias("a_key"), F.lit(True).alias("in_a"), *[F.col(f).alias(f"a_{f}") for f in fields])
    b = right.select(F.col(key).alias("b_key"), F.lit(True).alias("in_b"), *[F.col(f).alias(f"b_{f}") for f in fields])
    both = a.join(b, F.col("a_key").eqNullSafe(F.col("b_key")), "full_outer")
    side = F.when(F.col("in_b").isNull(), "left_only").when(F.col("in_a").isNull(), "right_only").otherwise("both")
    differing = F.array_compact(
        F.array(*[F.when(~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")), F.lit(f)) for f in fields])
    )
    named = F.when(side == "both", differing).otherwise(F.array(F.lit(None).cast("string")))
    return both.select(F.coalesce("a_key", "b_key").alias(key), side.alias("side"), F.explode(named).alias("field"))


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows left over on either side, counting repeats, with the side they are on."""
    right = right.select(*left.columns)
    only_left = left.exceptAll(right).withColumn("side", F.lit("left_only"))
    only_right = right.exceptAll(left).withColumn("side", F.lit("right_only"))
    return only_left.unionByName(only_right)


def schema_diff(schemas: DataFrame, baseline: DataFrame) -> DataFrame:
    """Columns of each file whose type differs from the baseline, or that one side lacks.

    ``schemas`` is ``file, column, type``; ``baseline`` is ``column, type``.
    """
    wanted = baseline.select("column", F.col("type").alias("baseline_type"))
    present = schemas.join(wanted, "column", "left")
    changed = present.filter(~F.col("type").eqNullSafe(F.col("baseline_type")))
    per_file = schemas.groupBy("file").agg(F.collect_set("column").alias("have"))
    names = baseline.agg(F.collect_set("column")).scalar()
    lacking = per_file.select("file", F.explode(F.array_except(names, F.col("have"))).alias("column"))
    lost = lacking.join(wanted, "column").select("file", "column", F.lit(None).cast("string").alias("type"), "baseline_type")
    return changed.select("file", "column", "type", "baseline_type").unionByName(lost)


def name_collisions(partition_paths: DataFrame, columns: DataFrame) -> DataFrame:
    """Names that are both a partition key in ``partition`` and a stored ``column``."""
    keys = partition_paths.select(
        F.explode(F.regexp_extract_all("partition", F.lit(r"([^/=]+)="), 1)).alias("name")
    )
    return keys.intersect(columns.select(F.col("column").alias("name")))
