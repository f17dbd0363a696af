"""Raw post files, batch or stream, over any Hadoop path.

Formats: ``jsonl`` (one post per line; splits anywhere, the one to use at scale), ``json`` (one
top-level array per file; a lone object counts as an array of one) and ``search`` (saved search
responses with the posts under ``data``). The last two are parsed as streams by Spark's JSON reader,
so a file of any size reads whole. Live HTTP search is left out: land the responses and read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.normalize import POST_FIELDS, normalize

# Every field stays a VARIANT: an absent key is null, a stored null is a variant null.
_FIELDS = [f"{name} variant" for name in POST_FIELDS]
_SCHEMAS = {
    "json": ", ".join([*_FIELDS, "_corrupt_record string"]),
    "search": f"data array<struct<{', '.join(f.replace(' ', ': ') for f in _FIELDS)}>>, _corrupt_record string",
}
FORMATS = ("jsonl", *_SCHEMAS)


def _lines(lines: DataFrame) -> DataFrame:
    return lines.filter(F.trim("value") != "").select(F.try_parse_json("value").alias("post"))


def _documents(documents: DataFrame, fmt: str) -> DataFrame:
    """A file that cannot be parsed gives one null post, which ``normalize`` flags."""
    bad = F.col("_corrupt_record").isNotNull()
    if fmt == "json":
        return documents.select(F.when(~bad, F.struct(*POST_FIELDS)).alias("post"))
    found = F.when(bad, F.array(F.lit(None).cast(documents.schema["data"].dataType.elementType))).otherwise(F.col("data"))
    return documents.select(F.explode(found).alias("post"))


def _check(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unknown post format {fmt!r}; use one of {', '.join(FORMATS)}")


def read_raw(spark: SparkSession, path: str, fmt: str = "jsonl") -> DataFrame:
    """One ``post`` column: a VARIANT for lines, a struct of VARIANT fields for documents."""
    _check(fmt)
    if fmt == "jsonl":
        return _lines(spark.read.text(path))
    return _documents(spark.read.schema(_SCHEMAS[fmt]).option("multiLine", True).json(path), fmt)


def stream_raw(spark: SparkSession, path: str, fmt: str = "jsonl", files_per_batch: int = 1000) -> DataFrame:
    """The streaming counterpart of ``read_raw``."""
    _check(fmt)
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    if fmt == "jsonl":
        return _lines(reader.text(path))
    return _documents(reader.schema(_SCHEMAS[fmt]).option("multiLine", True).json(path), fmt)


def read_posts(spark: SparkSession, path: str, fmt: str = "jsonl", strict: bool = False) -> DataFrame:
    """Normalised posts from files of one format."""
    return normalize(read_raw(spark, path, fmt), strict=strict)


def cap_posts(posts: DataFrame, requested: int) -> DataFrame:
    """The first ``requested`` posts by time and id, with how many were asked for and available."""
    available = posts.agg(F.count(F.lit(1))).scalar()
    return (
        posts.orderBy("created_at", "id")
        .limit(requested)
        .withColumns({"requested": F.lit(requested).cast("bigint"), "available": available})
    )
