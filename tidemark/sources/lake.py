"""Reading a Parquet lake: as a table, as loose files, and as an inventory of objects."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lake(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Partition-aware read: directory values become columns and filters on them prune files."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(root)


def read_lake_flat(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The same files with partition discovery off, so only stored columns come back."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if schema:
        reader = reader.schema(schema)
    return reader.parquet(root)


def object_rows(spark: SparkSession, path: str) -> int:
    """Rows in one object; answered from the footer."""
    return spark.read.parquet(path).count()


def listing(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """``key, bytes`` of every object below ``root``, from the listing alone."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return found.select(F.col("path").alias("key"), F.col("length").alias("bytes"))


def object_inventory(spark: SparkSession, root: str, schema: T.StructType | None = None, glob: str = "*.parquet") -> DataFrame:
    """``key, partition, rows, bytes`` per object: the listing, with row counts; an empty object has 0."""
    # The scan spells its paths as URIs, the listing as they are.
    spelt = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    counted = read_lake_flat(spark, root, schema).groupBy(spelt.alias("at")).agg(F.count(F.lit(1)).alias("rows"))
    folder = F.regexp_extract("key", r"((?:[^/=]+=[^/]*/)+)[^/]*$", 1)
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")  # noqa: E731  the two spell local paths differently
    found = listing(spark, root, glob)
    return found.join(counted, plain("key") == plain("at"), "left").select(
        "key", F.rtrim(folder, F.lit("/")).alias("partition"), F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), "bytes"
    )


def _open(uri: str):
    from urllib.parse import unquote, urlparse

    import pyarrow.fs as pafs

    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), unquote(urlparse(uri).path)
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq

    for batch in batches:
        out = []
        for uri in batch["path"]:
            filesystem, path = _open(uri)
            for field in pq.read_schema(path, filesystem=filesystem):
                out.append((uri, field.name, str(field.type)))
        yield pd.DataFrame(out, columns=["file", "column", "type"])


def file_schemas(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """``file, column, type`` of every object, from its footer.

    Spark has no per-file schema view, so the tasks read footers, spread over the listed files.
    Only paths are taken from the listing; file bodies are not loaded.
    """
    return listing(spark, root, glob).select(F.col("key").alias("path")).mapInPandas(_footers, "file string, column string, type string")


def lake_layouts(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """``layout, keys, paths, sample``: which directories hold files of which column layout.

    ``keys`` are the names of the directories' partition keys. A directory whose files agree stands for
    them; only where files of one directory disagree are they named one by one.
    """
    found = file_schemas(spark, root, glob).groupBy("file").agg(F.md5(F.to_json(F.sort_array(F.collect_list(F.struct("column", "type"))))).alias("layout"))
    folder = F.regexp_replace("file", "/[^/]*$", "")
    below = F.regexp_extract_all("file", F.lit(r"/([^/=]+)=[^/]*(?=/)"), 1)
    placed = found.select("file", "layout", folder.alias("folder"), below.alias("keys"))
    by_folder = placed.groupBy("folder", "keys").agg(F.count_distinct("layout").alias("n"), F.min("layout").alias("layout"), F.min("file").alias("sample"))
    pure = by_folder.filter("n = 1").select("layout", "keys", F.col("folder").alias("path"), "sample")
    mixed = placed.join(by_folder.filter("n > 1").select("folder"), "folder").select("layout", "keys", F.col("file").alias("path"), F.col("file").alias("sample"))
    return pure.union(mixed).groupBy("layout", "keys").agg(F.collect_list("path").alias("paths"), F.min("sample").alias("sample"))


def read_drifted(spark: SparkSession, root: str, schema: T.StructType, glob: str = "*.parquet") -> DataFrame:
    """Read a lake whose files disagree on types, each group of like files cast to ``schema``.

    Spark's scan wants one physical type per column. The footers say which column layouts there are
    (as many as writers had versions, not as files); each layout is one Spark scan over the
    directories that have it, with ``root`` as its base: partition columns come from the directories,
    and filters on them prune. The scans are united. The driver sees directories, as it does for any
    scan. A cast that would lose a value fails under ANSI rules; a column that a layout lacks is null.
    """
    wanted = {f.name: f for f in schema}
    scans = []
    for row in lake_layouts(spark, root, glob).collect():
        physical = [f for f in spark.read.parquet(row["sample"]).schema if f.name not in row["keys"]]
        keys = [wanted.get(k, T.StructField(k, T.StringType())) for k in row["keys"]]
        rows = spark.read.schema(T.StructType([*physical, *keys])).option("basePath", root).option("pathGlobFilter", glob).parquet(*row["paths"])
        have = {f.name for f in (*physical, *keys)}
        scans.append(rows.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]))
    if not scans:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, scans)


def read_probe(name: str, action: Callable[[], object]) -> dict[str, object]:
    """Run one read and record whether it worked, with the error class when it did not."""
    try:
        return {"reader": name, "ok": True, "detail": str(action()), "error_class": None}
    except Exception as exc:  # noqa: BLE001  the error is the measurement
        get = getattr(exc, "getCondition", None) or getattr(exc, "getErrorClass", None)
        condition = get() if get else None
        return {"reader": name, "ok": False, "detail": None, "error_class": condition or type(exc).__name__}
