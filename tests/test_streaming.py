"""Streaming: restarts, duplicates, late rows, idempotent merge."""

import json
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SAMPLE_POSTS
from tidemark.schema import ENRICHED
from tidemark.sources.posts import stream_raw
from tidemark.streaming import dedupe_stream, dropped_rows, enrich_stream, merge_stream, run_available, tumbling_summary


def land(folder, name, posts):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.jsonl").write_text("\n".join(json.dumps(p) for p in posts))


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for i in range(found.size()) if (name := found.apply(i).name()).startswith("shuffle_")}


@pytest.fixture
def landing(tmp_path):
    land(tmp_path / "in", "a", SAMPLE_POSTS[:3])
    return tmp_path


def at(post, created_at, ident=None):
    return {**post, "created_at": created_at, "id": ident or post["id"]}


def test_dedupe_holds_across_a_restart(spark, landing):
    out, state = str(landing / "out"), str(landing / "state")

    def start():
        posts = enrich_stream(stream_raw(spark, str(landing / "in")))
        return run_available(dedupe_stream(posts).drop("created_ts", "event_time"), out, state, "event_date")

    start()
    land(landing / "in", "b", SAMPLE_POSTS[1:])
    start()
    start()
    lake = spark.read.schema(ENRICHED).parquet(out)
    assert sorted(r["id"][-1] for r in lake.select("id").collect()) == list("12345")


def test_days_come_out_after_the_watermark_and_late_posts_are_dropped(spark, landing):
    out, state = str(landing / "out"), str(landing / "state")

    def start():
        posts = enrich_stream(stream_raw(spark, str(landing / "in")))
        return run_available(tumbling_summary(posts, delay="1 day"), out, state)

    start()
    land(landing / "in", "b", [at(SAMPLE_POSTS[3], "2026-01-20T00:00:00.000Z")])
    start()
    land(landing / "in", "c", [at(SAMPLE_POSTS[4], "2026-01-15T01:00:00.000Z"), at(SAMPLE_POSTS[4], "2026-01-30T00:00:00.000Z", "6")])
    last = start()
    rows = {r["event_day"]: (r["post_count"], r["total_engagement"], r["positive"]) for r in spark.read.parquet(out).collect()}
    assert rows == {"2026-01-15": (3, 82038, 1), "2026-01-20": (1, 72390, 1)}
    assert dropped_rows(last) == 1


def test_merge_stream_is_idempotent_from_scratch(spark, landing):
    out = str(landing / "lake")
    land(landing / "in", "b", SAMPLE_POSTS)
    for i in range(2):
        merge_stream(enrich_stream(stream_raw(spark, str(landing / "in"), files_per_batch=1)), out, str(landing / f"s{i}"))
    lake = spark.read.schema(ENRICHED).parquet(out)
    assert lake.count() == 5 and lake.select("id").distinct().count() == 5
    assert lake.agg(F.sum("engagement_total")).first()[0] == 161736


def test_a_stream_merged_anew_writes_nothing_and_leaves_no_shuffle_files(spark, landing):
    out, before = landing / "lake", shuffle_files(spark)
    posts = enrich_stream(stream_raw(spark, str(landing / "in"))).repartition(3, "id")
    merge_stream(posts, str(out), str(landing / "s0"))
    first = {str(p) for p in out.rglob("part-*.parquet")}
    merge_stream(posts, str(out), str(landing / "s1"))
    assert first and {str(p) for p in out.rglob("part-*.parquet")} == first
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


def test_posts_without_id_or_time_are_landed(spark, landing):
    from tidemark.streaming import land_stream

    odd = [
        {"id": "t1", "created_at": "whenever", "text": "no time"},
        {"id": None, "created_at": "2026-01-15T08:00:00.000Z", "text": "null id"},
        {"created_at": "2026-01-15T08:00:00.000Z", "text": "no id"},
        {"created_at": "2026-01-15T08:00:00.000Z", "text": "no id either"},
        {"created_at": "2026-01-15T08:00:00.000Z", "text": "no id either"},
    ]
    land(landing / "in", "b", odd)
    for _ in range(2):
        land_stream(enrich_stream(stream_raw(spark, str(landing / "in"))), str(landing / "out"), str(landing / "state"))
    landed = spark.read.parquet(str(landing / "out"))
    posts = landed.filter("arrival = 'post'")
    assert sorted(r["text"] for r in posts.filter("id in ('', 'None')").collect()) == ["no id", "no id either", "null id"]
    assert posts.count() == 6
    rest = {(r["arrival"], r["text"]) for r in landed.filter("arrival <> 'post'").collect()}
    assert rest == {("untimed", "no time"), ("repeat", "no id either")} and landed.count() == 8


def test_every_row_arrives_once_over_batches_and_restarts(spark, landing):
    """Repeats, late rows, wild dates and untimed rows, a file a batch, with a start between any two files."""
    from tidemark.streaming import land_stream

    out, state = str(landing / "out"), str(landing / "state")

    def post(ident, created_at):
        return {"id": ident, "created_at": created_at, "text": f"{ident} at {created_at}"}

    batches = [
        [post("a", "2026-02-01T00:00:00.000Z"), post("n", "no date"), post("w", "9021-01-01T00:00:00.000Z")],
        [post("b", "2026-02-02T00:00:00.000Z"), post("a", "2026-02-01T00:00:00.000Z"), post("n", "no date")],
        [post("c", "2026-02-09T00:00:00.000Z"), post("b", "2026-02-02T00:00:00.000Z")],
        [post("d", "2026-02-02T00:00:00.000Z"), post("e", "2026-02-06T00:00:00.000Z"), post("a", "2026-02-01T00:00:00.000Z"), post("n", "no date"), post("c", "2026-02-09T00:00:00.000Z")],
        [post("n", "no date")],
    ]
    for i, rows in enumerate(batches):
        land(landing / "in", f"f{i}", rows)
        land_stream(enrich_stream(stream_raw(spark, str(landing / "in"), files_per_batch=1)), out, state, delay_days=4)
    got = sorted((r["arrival"], r["id"]) for r in spark.read.parquet(out).filter("length(id) = 1").collect())
    # ``n`` is forgotten four days of the stream after its first row; its next row counts as the first again.
    want = [("post", x) for x in "abce"] + [("late", "a"), ("late", "d"), ("repeat", "a"), ("repeat", "b"), ("repeat", "c"), ("repeat", "n"), ("repeat", "n"), ("untimed", "n"), ("untimed", "n"), ("untimed", "w")]
    assert sorted(x for x in got if x[1] != "n") == sorted(x for x in want if x[1] != "n")
    assert sum(map(len, batches)) == len(got) and sum(x == ("untimed", "n") for x in got) <= 2


def test_sliding_windows_as_a_stream(spark, landing):
    from tidemark.operators.windows import sliding_counts
    from tidemark.streaming import sliding_stream

    out, state = str(landing / "out"), str(landing / "state")
    days = [f"2026-01-{d:02d}T{h:02d}:30:00.000Z" for d in range(1, 20) for h in (0, 9)]
    for i, some in enumerate((days[:15], days[15:16], days[16:])):
        land(landing / "in", f"s{i}", [at(SAMPLE_POSTS[0], t, f"{i}-{k}") for k, t in enumerate(some)])
        posts = enrich_stream(stream_raw(spark, str(landing / "in"), files_per_batch=1))
        run_available(sliding_stream(posts, 7, "1 day"), out, state)
    got = {(r["window_start"], r["window_end"], r["post_count"]) for r in spark.read.parquet(out).collect()}
    batch = spark.createDataFrame([(t[:19],) for t in [p["created_at"] for p in SAMPLE_POSTS[:3]] + days], "t string").selectExpr("cast(t as timestamp_ntz) as created_ts")
    want = {tuple(r) for r in sliding_counts(batch).collect()}
    closed = {w for w in want if str(w[1]) <= "2026-01-18 09:30:00"}
    assert got == closed and len(got) > 10


@pytest.mark.parametrize("fmt", ["json", "search"])
def test_array_files_stream(spark, tmp_path, fmt):
    (tmp_path / "in").mkdir()
    body = SAMPLE_POSTS if fmt == "json" else {"data": SAMPLE_POSTS}
    (tmp_path / "in" / "a.json").write_text(json.dumps(body))
    posts = enrich_stream(stream_raw(spark, str(tmp_path / "in"), fmt))
    run_available(posts.drop("created_ts"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.schema(ENRICHED).parquet(str(tmp_path / "out")).agg(F.sum("like_count")).first()[0] == 135920


def test_landed_days_are_read_apart(spark, monkeypatch):
    """A big day lands as several files, in order of days, and a batch takes the files of four days."""
    from tidemark.plans.queries import streams

    monkeypatch.setattr(streams, "FILE_BYTES", 1)
    posts = spark.range(0, 24, 1, 3).select(
        (F.col("id") % 6).cast("int").alias("batch"), F.col("id").cast("string").alias("id"), F.lit("2026-01-01").alias("created_at"),
        F.lit("text").alias("text"), F.lit("s").alias("source"), F.col("id").alias("like_count"))
    pattern, files = streams._landed(spark, posts, "landed-test")
    read = spark.read.text(pattern).select(F.col("_metadata.file_path").alias("at"), F.get_json_object("value", "$.id").cast("int").alias("id"))
    rows = read.select(F.regexp_extract("at", r"/(\d+)/[^/]*$", 1).cast("int").alias("day"), "id", "at").collect()
    assert sorted(r["id"] for r in rows) == list(range(24)) and all(r["id"] % 6 == r["day"] for r in rows)
    per_day = [len({r["at"] for r in rows if r["day"] == d}) for d in range(6)]
    assert min(per_day) > 1 and files == 4 * min(per_day)
