"""One run: read posts, enrich, write posts and the daily summary, return a receipt."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.enrich import LEXICON_SCORER, Scorer, enrich
from tidemark.operators.summary import daily_summary
from tidemark.schema import ENRICHED
from tidemark.session import settle
from tidemark.sinks import lake as sink
from tidemark.sources.lake import read_lake
from tidemark.sources.posts import read_posts

MODES = ("merge", "overwrite", "append", "run_date")


def write_posts(enriched: DataFrame, root: str, run_ts: dt.datetime, mode: str) -> None:
    if mode == "merge":
        sink.merge_posts(enriched, root, settled=True)
    elif mode == "overwrite":
        sink.overwrite_days(enriched, root)
    elif mode == "append":
        sink.append_posts(enriched, root, run_ts)
    elif mode == "run_date":
        sink.write_run_date(enriched, root, run_ts)
    else:
        raise ValueError(f"mode must be one of {MODES}")


def run_etl(
    spark: SparkSession,
    source: str,
    target: str,
    run_ts: dt.datetime,
    fmt: str = "jsonl",
    mode: str = "merge",
    scorer: Scorer = LEXICON_SCORER,
) -> dict[str, object]:
    """Run once. ``run_ts`` is the scheduled instant, not the wall clock, so a replay is repeatable.

    The enriched batch is written to the shared folder and read from there by all that follows; a
    lost executor repeats one step. Lines and files that hold no post go to ``rejects`` with their
    flags; the run date's rejects are those of its last run, none included. In the modes that replace
    days the batch keeps the latest row of each id, and the summary is taken from the days it touched as
    the lake holds them then; days that other runs of the same date summarised stay. So receipt, lake
    and summary agree. The receipt counts during the write.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    posts_root, summary_root, rejects_root = (f"{target}/{name}" for name in ("posts", "daily_summary", "rejects"))
    posts = read_posts(spark, source, fmt)
    bad = F.array_contains("quality_flags", "bad_json")
    flagged = settle(enrich(posts, scorer).withColumn("bad", bad), "etl-batch")
    rejects = flagged.filter("bad").drop("bad")
    rejected = rejects.count()
    held = f"{rejects_root}/run_date={run_ts.date()}"
    if rejected or sink.existing(spark, held, rejects.schema) is not None:
        rejects.write.mode("overwrite").parquet(held)
    batch = flagged.filter("not bad").drop("bad", "quality_flags")
    if mode in ("merge", "overwrite"):
        batch = settle(sink.latest(batch), "etl-latest")
    receipt = {"post_count": 0}
    days = settle(batch.select("event_date").distinct(), "days")
    if not batch.isEmpty():
        receipt = sink.write_with_receipt(batch, lambda df: write_posts(df, posts_root, run_ts, mode), posts_root)
        if mode in ("merge", "overwrite"):
            lake = read_lake(spark, posts_root, ENRICHED)
            summary = daily_summary(lake.join(days, lake["event_date"].eqNullSafe(days["event_date"]), "left_semi"))
            sink.merge_summary(summary, summary_root, run_ts.date())
        else:
            sink.write_summary(daily_summary(batch), summary_root, run_ts.date())
    return {
        "post_count": receipt["post_count"],
        "rejected": rejected,
        "summary_days": batch.select("event_day").distinct().count(),
        "locations": {"posts": posts_root, "daily_summary": summary_root, "rejects": rejects_root},
        "scorer": scorer.name,
        "run_ts": run_ts.isoformat(),
    }
