"""Writers for the posts and daily_summary datasets. A target is any path Spark can write.

The event-date layout is partitioned by ``event_date`` (a date) and keeps ``event_day`` (a string)
inside the file, so no stored column shares its name with a directory.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators.dedupe import last_per_key
from tidemark.schema import DAILY_SUMMARY, ENRICHED, conform
from tidemark.session import CODEC, TIDY, discard, scratch_path, settings, settle
from tidemark.sources.lake import listing

# How many days a task keeps open at a time (rows of further days are sorted first), the
# bytes it holds of each before they are written out, and how much of a column is packed together, how hard.
OPEN_DAYS = 40
ROW_GROUP, PAGE, LEVEL = 16 * 1024 * 1024, 4 * 1024 * 1024, 6
MANY_OPEN = {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_DAYS)}
COMPACT = {
    "compression": CODEC, "parquet.compression.codec.zstd.level": str(LEVEL),
    "parquet.block.size": str(ROW_GROUP), "parquet.page.size": str(PAGE),
}


def write_days(rows: DataFrame, root: str, mode: str = "append", **options: str) -> None:
    """One directory per ``event_date``, written where the rows are.

    Whole texts are neither shuffled nor sorted by day: every task keeps the days it meets open. So a
    day has at most as many files as the batch has tasks.
    """
    with settings(rows.sparkSession, MANY_OPEN | TIDY):
        rows.write.options(**COMPACT, **options).partitionBy("event_date").mode(mode).parquet(root)


def write_event_date(enriched: DataFrame, root: str, mode: str = "append", extra: tuple[str, ...] = ()) -> None:
    """Declared-schema write, one directory per post date. The default layout."""
    write_days(conform(enriched, ENRICHED, extra), root, mode)


def write_run_date(enriched: DataFrame, root: str, run_ts: dt.datetime) -> None:
    """Compatibility layout: ``year=/month=/day=`` of the run's date, whatever days the posts have."""
    rows = conform(enriched, ENRICHED)
    stamped = rows.withColumns(
        {
            "year": F.lit(f"{run_ts:%Y}"),
            "month": F.lit(f"{run_ts:%m}"),
            "day": F.lit(f"{run_ts:%d}"),
        }
    )
    stamped.write.options(**COMPACT).partitionBy("year", "month", "day").mode("append").parquet(root)


def append_posts(enriched: DataFrame, root: str, run_ts: dt.datetime) -> None:
    """Append one run's rows stamped with ``run_ts``. Repeating a run repeats its rows."""
    stamped = enriched.withColumn("run_ts", F.lit(run_ts.replace(tzinfo=None)).cast("timestamp_ntz"))
    write_event_date(stamped, root, "append", extra=("run_ts",))


def overwrite_days(enriched: DataFrame, root: str) -> None:
    """Replace exactly the days present in the batch. Repeating it changes nothing.

    Right only for batches that hold whole days; otherwise use ``merge_posts``.
    """
    write_days(conform(enriched, ENRICHED), root, "overwrite", partitionOverwriteMode="dynamic")


def merge_summary(summary: DataFrame, root: str, run_date: dt.date) -> None:
    """Replace the days of ``summary`` in the run date's directory; its other days stay."""
    fresh = conform(summary, DAILY_SUMMARY)
    stored = existing(summary.sparkSession, f"{root}/run_date={run_date}", DAILY_SUMMARY)
    if stored is None:
        return write_summary(fresh, root, run_date)
    # Written apart first, as the directory that is read is the one replaced. One row per day.
    kept = stored.join(fresh.select("event_day"), "event_day", "left_anti").select(*fresh.columns)
    write_summary(settle(kept.unionByName(fresh), "summary"), root, run_date)


def write_summary(summary: DataFrame, root: str, run_date: dt.date) -> None:
    """One directory per run date; a repeated run replaces its own."""
    rows = conform(summary, DAILY_SUMMARY).withColumn("run_date", F.lit(run_date))
    (
        rows.write.partitionBy("run_date")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(root)
    )


# What an absent and a null id are stored as. Such posts have no identity.
NO_ID = ("", "None")


def has_id() -> Column:
    return F.coalesce(~F.col("id").isin(*NO_ID), F.lit(False))


def existing(spark, root: str, schema=ENRICHED) -> DataFrame | None:
    """The dataset at ``root``, or None if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def touched(lake: DataFrame, batch: DataFrame) -> DataFrame:
    """Existing rows in the batch's days: the range of days prunes directories, a semi-join the rest."""
    # Settled, so that Spark knows how few days there are and sends them to the rows.
    days = settle(batch.select("event_date").distinct(), "days")
    low, high, undated = days.agg(F.min("event_date"), F.max("event_date"), F.count_if(F.col("event_date").isNull())).first()
    near = F.lit(False) if low is None else F.col("event_date").between(F.lit(low), F.lit(high))
    if undated:
        near = near | F.col("event_date").isNull()
    return lake.filter(near).join(days, lake["event_date"].eqNullSafe(days["event_date"]), "left_semi")


# Fixed value: up to so many ids that a batch repeats are sent to its rows.
FEW_IDS = 200_000


def _same_post(a: DataFrame, b: DataFrame) -> Column:
    return (a["id"] == b["id"]) & a["event_date"].eqNullSafe(b["event_date"])


def latest(batch: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """One post of each id and day, the one with the largest ``order``; posts without an id all stay.

    The default order is engagement, then a hash of the row. Pass the time of ingestion if there is one.
    """
    order = order or [F.col("engagement_total")]
    known = batch.filter(has_id())
    again = known.groupBy("id", "event_date").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id", "event_date")
    again = settle(again, "repeated-ids")
    n = again.count()
    if n == 0:
        return batch
    if n > FEW_IDS:
        return last_per_key(known, ["id", "event_date"], order).unionByName(batch.filter(~has_id()))
    few = F.broadcast(again)
    repeated, single = (batch.join(few, _same_post(batch, again), how) for how in ("left_semi", "left_anti"))
    return last_per_key(repeated, ["id", "event_date"], order).unionByName(single)


# Fixed value: up to so many bitmaps (4 KB each) of replaced rows are sent to the rows, whatever Spark's own bound.
FEW_MAPS = 5_000


def _without(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of a lake with an id that ``batch`` does not have in that day.

    Only ids and places of rows (file, number in it) are shuffled. What is to go becomes one bit a row,
    which Spark sends to the rows as long as that is small, so no stored text is moved.
    """
    at = old.select("id", "event_date", F.col("_metadata.file_path").alias("file"), (F.col("_metadata.row_index") + 1).alias("row"))
    at = at.filter(has_id())
    ids = batch.filter(has_id()).select("id", "event_date")
    gone = at.join(ids, _same_post(at, ids), "left_semi").groupBy("file", F.bitmap_bucket_number("row").alias("part"))
    gone = settle(gone.agg(F.bitmap_construct_agg(F.bitmap_bit_position("row")).alias("bits")), "replaced-rows")
    if gone.count() <= FEW_MAPS:
        gone = F.broadcast(gone)
    row = F.col("_metadata.row_index") + 1
    placed = old.filter(has_id()).select("*", F.col("_metadata.file_path").alias("file"), F.bitmap_bucket_number(row).alias("part"), F.bitmap_bit_position(row).alias("bit"))
    byte = F.conv(F.hex(F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    kept = F.col("bits").isNull() | (F.expr("cast(bit % 8 as int)").isNotNull() & (byte.bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) == 0))
    return placed.join(gone, ["file", "part"], "left").filter(kept).select(*old.columns)


def _as_often(fresh: DataFrame, old: DataFrame) -> DataFrame:
    """Rows without an id, each as often as the side that has it more often: merging again adds none."""
    both = fresh.withColumns({"_new": F.lit(1), "_old": F.lit(0)}).unionByName(old.withColumns({"_new": F.lit(0), "_old": F.lit(1)}))
    counted = both.groupBy(*fresh.columns).agg(F.greatest(F.sum("_new"), F.sum("_old")).alias("_n"))
    return counted.select(*fresh.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_i")).drop("_i")


def _digest(columns: list[str]) -> Column:
    """SHA-256 of a whole row, in hex: each column as its length and its text, so that no two rows read alike."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def changed_days(old: DataFrame, batch: DataFrame) -> DataFrame:
    """The days of a batch in which merging it would change a row of ``old``; whole rows are compared, by digest.

    Such a day has a post that is not stored, or is stored otherwise or more than once, or that the batch
    has in two versions, or a post without an id more often than it is stored. No text is shuffled.
    """

    def marked(rows: DataFrame, fresh: int) -> DataFrame:
        rows = rows.select("event_date", "id", _digest(rows.columns).alias("row"))
        half = [F.conv(F.substring("row", at, 15), 16, 10).cast("bigint").alias(name) for at, name in ((1, "a"), (16, "b"))]
        return rows.select("event_date", has_id().alias("known"), F.when(has_id(), F.col("id")).otherwise(F.col("row")).alias("key"), *half, F.lit(fresh).alias("fresh"))

    versions = [f(c).alias(f"{f.__name__}_{c}") for c in "ab" for f in (F.min, F.max)]
    posts = marked(batch, 1).unionAll(marked(old, 0)).groupBy("event_date", "known", "key").agg(F.sum("fresh").alias("new"), F.sum(1 - F.col("fresh")).alias("old"), *versions)
    stored = (F.col("old") == 1) & (F.col("min_a") == F.col("max_a")) & (F.col("min_b") == F.col("max_b"))
    return posts.filter((F.col("new") > 0) & ~F.when(F.col("known"), stored).otherwise(F.col("new") <= F.col("old"))).select("event_date").distinct()


def in_days(days: list[dt.date | None]) -> Column:
    return F.col("event_date").isin([day for day in days if day is not None]) | (F.col("event_date").isNull() if None in days else F.lit(False))


# Stored bytes of the days that a merge writes at a time, and their files.
MERGE_BYTES, MERGE_FILES = 1024**3, FEW_MAPS


def _by_size(root: str, changed: DataFrame) -> list[list[dt.date | None]]:
    """Changed days in order, in groups of up to ``MERGE_BYTES`` stored, or of one day."""
    name = F.regexp_extract("key", r"/event_date=([^/]+)/[^/]*$", 1)
    stored = listing(changed.sparkSession, root).groupBy(name.alias("name")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("files"))
    named = changed.withColumn("name", F.coalesce(F.col("event_date").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
    sized = named.join(stored, "name", "left").orderBy("event_date").select("event_date", F.coalesce("bytes", F.lit(0)), F.coalesce("files", F.lit(0)))
    groups, bytes_, files = [], 0, 0
    for day, more, n in sized.collect():  # days are directories, which the driver lists anyway
        if not groups or bytes_ + more > MERGE_BYTES or files + n > MERGE_FILES:
            groups.append([])
            bytes_ = files = 0
        groups[-1].append(day)
        bytes_, files = bytes_ + more, files + n
    return groups


@contextmanager
def _held(rows: DataFrame, name: str, by_day: bool = False) -> Iterator[DataFrame]:
    """Whole posts in the shared folder, for as long as the block lasts."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, name)
    try:
        if by_day:
            write_days(rows, path)
        else:
            with settings(spark, TIDY):
                rows.write.options(**COMPACT).parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        discard(spark, path)


def merge_posts(batch: DataFrame, root: str, order: list[Column] | None = None, settled: bool = False) -> None:
    """Merge by id into the days the batch touches; the batch wins, other days are left alone.

    ``created_at`` of a post does not change, so an id stays in one day. Of several rows of one id in
    the batch the ``latest`` wins. Posts without an id are told apart by their whole row, and exact
    repeats of one are counted. A batch may hold part of a day, and merging it again gives the
    same lake. Existing rows are only filtered, not sorted or aggregated.
    ``settled`` says that the batch is a plain read of files already and need not be written again.

    Days that the batch leaves as they are, row by row, are not written. The others are written some at
    a time, and what each replaces goes before the next: beside the lake and the batch there is disk
    for ``MERGE_BYTES`` or one day. A merge that fails midway has merged some days; merge it again.
    """
    with ExitStack() as as_given, ExitStack() as by_day:
        given = conform(batch, ENRICHED)
        if not settled:
            given = as_given.enter_context(_held(given, "merge-batch"))
        lake = existing(batch.sparkSession, root)
        if lake is None:
            return overwrite_days(latest(given, order), root)
        old = touched(lake, given)
        with settings(batch.sparkSession, TIDY):
            groups = _by_size(root, settle(changed_days(old, given), "changed-days"))
        if len(groups) > 1:
            given = by_day.enter_context(_held(given.filter(in_days(sum(groups, []))), "merge-days", by_day=True))
            as_given.close()
        for days in groups:
            fresh, stored = given.filter(in_days(days)), old.filter(in_days(days))
            kept = _without(stored, fresh)
            anonymous = _as_often(fresh.filter(~has_id()), stored.filter(~has_id()))
            overwrite_days(latest(fresh.filter(has_id()), order).unionByName(kept).unionByName(anonymous), root)


def write_with_receipt(enriched: DataFrame, write, root: str) -> dict[str, object]:
    """Run ``write(df)`` and return what went through it, counted during the write itself.

    An empty batch still gives a receipt, with zero posts.
    """
    seen = Observation("receipt")
    watched = enriched.observe(
        seen,
        F.count(F.lit(1)).alias("post_count"),
        F.coalesce(F.sum("engagement_total"), F.lit(0)).alias("total_engagement"),
        F.min("event_day").alias("first_day"),
        F.max("event_day").alias("last_day"),
    )
    write(watched)
    return {"location": root, **seen.get}
