"""Session helpers: a UTC Spark session, the shared scratch folder, input spreading."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Stored texts take about half the room they take under Spark's default codec.
CODEC = "zstd"
#: A job's shuffle files go when it ends, not when the driver happens to collect its garbage.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package is tuned for; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # A week of post ids does not fit the heap; RocksDB keeps streaming state on disk.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        # Call-site capture costs driver round trips for every column expression.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for tables written between jobs.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, which has no other
    machine to share with, may fall back to a folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root
    if not spark.sparkContext.master.partition("[")[0] == "local":
        raise RuntimeError(f"{CHECKPOINT_DIR} must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(CHECKPOINT_DIR, root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Session settings for one step; what was set before is set again after it."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that was written between jobs, on whatever file system it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def spread(scan: DataFrame) -> DataFrame:
    """Deal a scan over all cores when its files give fewer splits than cores.

    Only an input smaller than (cores x split size) can come out short, so the shuffle is bounded;
    a large input keeps its own splits and is never shuffled here. Rows are dealt in turn, not by
    key, so what follows plans the same exchanges as on a large input.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores)


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table from driver values, as a local relation whose size Spark knows."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    columns = list(zip(*rows)) if rows else [[] for _ in arrow]
    data = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(data, schema=arrow))


def settle(df: DataFrame, name: str = "settled", files: int | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and read it back, as ``files`` files at most if given.

    For a small aggregate that several branches of a plan use: the big scan behind it then runs
    once, and a lost executor rereads the table instead of repeating the scan. ``files`` should grow
    with the rows: without it a table has one for every shuffle partition, however few its rows are.
    """
    path = scratch_path(df.sparkSession, name)
    few = df if files is None else df.coalesce(files)
    few.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
