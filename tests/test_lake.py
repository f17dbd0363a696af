"""Sinks, scans, drift, probes and the end-to-end run."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SAMPLE_POSTS
from tidemark.operators.dedupe import first_per_key, last_per_key
from tidemark.operators.enrich import enrich
from tidemark.operators.parity import field_diff, multiset_diff, name_collisions, schema_diff
from tidemark.operators.summary import daily_summary
from tidemark.plans.etl import run_etl, write_posts
from tidemark.plans.queries.enrichment import stored_rows
from tidemark.schema import ENRICHED, conform
from tidemark.sinks import lake as sink
from tidemark.sources import lake as scan

RUN = dt.datetime(2026, 1, 17, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def rows(sample):
    return enrich(sample).cache()


def ids(df):
    return sorted(r["id"][-1] for r in df.select("id").collect())


def test_event_date_layout_puts_posts_under_their_own_day(spark, rows, tmp_path):
    root = str(tmp_path / "posts")
    sink.write_event_date(rows, root)
    assert sorted(p.name for p in (tmp_path / "posts").glob("event_date=*")) == ["event_date=2026-01-15", "event_date=2026-01-16"]
    lake = scan.read_lake(spark, root, ENRICHED)
    assert ids(lake) == list("12345")
    assert lake.filter(F.col("event_day") != F.col("event_date").cast("string")).count() == 0
    flat = scan.read_lake_flat(spark, root)
    assert "event_date" not in flat.columns and flat.count() == 5


def test_one_day_read_prunes_directories(spark, rows, tmp_path):
    root = str(tmp_path / "posts")
    sink.write_event_date(rows, root)
    day = scan.read_lake(spark, root, ENRICHED).filter(F.col("event_date") == F.lit("2026-01-16").cast("date")).select("id")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "ReadSchema: struct<id:string>" in plan
    assert ids(day) == list("45")


def test_run_date_layout_collapses_all_days(spark, rows, tmp_path):
    root = str(tmp_path / "posts")
    sink.write_run_date(rows, root, RUN)
    files = [str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.parquet")]
    assert files and all(f.startswith("posts/year=2026/month=01/day=17/") for f in files)


def test_append_repeats_and_overwrite_does_not(spark, rows, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    for hour in (0, 1):
        sink.append_posts(rows, a, RUN + dt.timedelta(hours=hour))
        sink.overwrite_days(rows, b)
    assert scan.read_lake(spark, a).count() == 10
    assert scan.read_lake(spark, a).select("run_ts").distinct().count() == 2
    assert scan.read_lake(spark, b, ENRICHED).count() == 5
    sink.overwrite_days(rows.filter("event_day = '2026-01-16'").limit(1), b)
    assert ids(scan.read_lake(spark, b, ENRICHED))[:3] == list("123")
    assert scan.read_lake(spark, b, ENRICHED).count() == 4


def test_merge_keeps_the_rest_of_a_day_and_updates_by_id(spark, rows, tmp_path):
    root = str(tmp_path / "m")
    sink.merge_posts(rows.filter("event_day = '2026-01-15'"), root)
    part = rows.filter(F.col("id").endswith("2")).withColumn("like_count", F.lit(1))
    for _ in range(2):
        sink.merge_posts(part, root)
    sink.merge_posts(rows.filter("event_day = '2026-01-16'"), root)
    lake = scan.read_lake(spark, root, ENRICHED)
    assert ids(lake) == list("12345")
    assert lake.filter(F.col("id").endswith("2")).select("like_count").first()[0] == 1
    dated = rows.filter(F.col("id").endswith("5")).withColumn("event_date", F.lit(None).cast("date")).withColumn("id", F.lit("9"))
    sink.merge_posts(dated, root)
    sink.merge_posts(dated, root)
    assert ids(scan.read_lake(spark, root, ENRICHED)) == list("123459")


def test_merge_keeps_posts_without_an_id(spark, rows, tmp_path):
    root = str(tmp_path / "m")
    nameless = rows.withColumn("id", F.when(F.col("id").endswith("1"), "").when(F.col("id").endswith("4"), "None").otherwise(F.col("id")))
    twice = nameless.unionByName(nameless.filter(F.col("id") == ""))
    for _ in range(2):
        sink.merge_posts(twice, root)
    assert sorted(r["id"][-1:] for r in scan.read_lake(spark, root, ENRICHED).select("id").collect()) == ["", "", "2", "3", "5", "e"]
    sink.merge_posts(nameless.filter(F.col("id") == "").withColumn("text", F.lit("another")), root)
    assert scan.read_lake(spark, root, ENRICHED).count() == 7


def test_merge_plan_sorts_no_whole_rows(rows):
    plan = sink.latest(rows)._jdf.queryExecution().executedPlan().toString()
    heavy = [line for line in plan.splitlines() if "SortAggregate" in line and "text" in line.split("functions=")[0]]
    assert heavy == [] and "Window" not in plan


def test_only_a_missing_lake_counts_as_none(spark, rows, tmp_path):
    assert sink.existing(spark, str(tmp_path / "nothing")) is None
    with pytest.raises(Exception):
        sink.existing(spark, "nosuchscheme://x/y")


def test_merge_of_repeated_ids_in_one_batch(spark, rows, tmp_path):
    root = str(tmp_path / "m")
    louder = rows.withColumn("engagement_total", F.col("engagement_total") + 1)
    sink.merge_posts(rows.unionByName(louder).unionByName(rows), root)
    lake = scan.read_lake(spark, root, ENRICHED)
    assert ids(lake) == list("12345")
    assert lake.agg(F.sum("engagement_total")).first()[0] == rows.agg(F.sum("engagement_total")).first()[0] + 5


def test_summary_rewrites_its_run_date_only(spark, rows, tmp_path):
    root = str(tmp_path / "s")
    for day in (17, 17, 18):
        sink.write_summary(daily_summary(rows), root, dt.date(2026, 1, day))
    assert scan.read_lake(spark, root).groupBy("run_date").count().orderBy("run_date").collect()[0]["count"] == 2


def test_receipt_counts_the_write_and_survives_an_empty_batch(rows, tmp_path):
    got = sink.write_with_receipt(rows, lambda df: sink.write_event_date(df, str(tmp_path / "r")), "r")
    assert (got["post_count"], got["total_engagement"], got["first_day"]) == (5, 161736, "2026-01-15")
    none = sink.write_with_receipt(rows.filter("false"), lambda df: sink.write_event_date(df, str(tmp_path / "e")), "e")
    assert none["post_count"] == 0 and none["total_engagement"] == 0


@pytest.mark.parametrize("mode,expected", [("merge", 5), ("overwrite", 5), ("append", 10), ("run_date", 10)])
def test_run_twice_end_to_end(spark, sample_dir, tmp_path, mode, expected):
    target = str(tmp_path)
    for _ in range(2):
        receipt = run_etl(spark, f"{sample_dir}/json", target, RUN, fmt="json", mode=mode)
    assert receipt["post_count"] == 5 and receipt["summary_days"] == 2 and receipt["scorer"] == "lexicon"
    assert spark.read.parquet(receipt["locations"]["posts"]).count() == expected
    assert spark.read.parquet(receipt["locations"]["daily_summary"]).count() == 2


def test_run_without_posts_writes_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("[]")
    receipt = run_etl(spark, str(tmp_path / "in"), str(tmp_path / "out"), RUN, fmt="json")
    assert receipt["post_count"] == 0 and not (tmp_path / "out").exists()
    with pytest.raises(ValueError):
        write_posts(None, "x", RUN, "nope")


def test_inventory_and_single_object(spark, rows, tmp_path):
    root = str(tmp_path / "posts")
    sink.write_event_date(rows, root)
    found = scan.object_inventory(spark, root, ENRICHED).orderBy("partition").collect()
    assert {r["partition"] for r in found} == {"event_date=2026-01-15", "event_date=2026-01-16"}
    assert sum(r["rows"] for r in found) == 5 and all(r["bytes"] > 0 for r in found)
    assert scan.object_rows(spark, found[0]["key"]) == found[0]["rows"]


def test_drifted_files_are_described_and_read(spark, tmp_path):
    import pandas as pd

    typical = pd.DataFrame({"id": ["a", "b"], "like_count": [1, 2], "source": ["web", "app"]})
    no_source = typical.assign(id=["c", "d"], source=None)
    one_missing = typical.assign(id=["e", "f"], like_count=[None, 4.0])
    for name, frame in {"t": typical, "n": no_source, "m": one_missing}.items():
        frame.to_parquet(tmp_path / f"{name}.parquet", index=False)
    typical[["id"]].assign(id="g").to_parquet(tmp_path / "z.parquet", index=False)
    schemas = scan.file_schemas(spark, str(tmp_path)).cache()
    base = schemas.filter(F.col("file").endswith("/t.parquet")).select("column", "type")
    diff = {(r["file"].rsplit("/", 1)[1][0], r["column"], r["type"]) for r in schema_diff(schemas, base).collect()}
    assert diff == {("n", "source", "null"), ("m", "like_count", "double"), ("z", "like_count", None), ("z", "source", None)}
    declared = T.StructType.fromDDL("id string, like_count bigint, source string")
    got = {r["id"]: (r["like_count"], r["source"]) for r in scan.read_drifted(spark, str(tmp_path), declared).collect()}
    assert got == {"a": (1, "web"), "b": (2, "app"), "c": (1, None), "d": (2, None), "e": (None, "web"), "f": (4, "app"), "g": (None, None)}


def test_colliding_day_key_breaks_the_filter_and_ours_does_not(spark, rows, tmp_path):
    clash = str(tmp_path / "clash")
    rows.select("id", F.lit(28).alias("day")).write.partitionBy("day").parquet(clash)
    bad = scan.read_probe("filter", lambda: scan.read_lake(spark, clash).filter(F.col("day") == "2026-01-15").count())
    assert not bad["ok"] and bad["error_class"] == "CAST_INVALID_INPUT"
    root = str(tmp_path / "ok")
    sink.write_event_date(rows, root)
    good = scan.read_probe("filter", lambda: scan.read_lake(spark, root, ENRICHED).filter("event_day = '2026-01-15'").count())
    assert good == {"reader": "filter", "ok": True, "detail": "3", "error_class": None}


def test_name_collisions(spark):
    paths = spark.createDataFrame([("x/posts/year=2026/month=01/day=15",)], "partition string")
    columns = spark.createDataFrame([("day",), ("id",)], "column string")
    assert [r[0] for r in name_collisions(paths, columns).collect()] == ["day"]


def test_parity_reports(spark):
    a = spark.createDataFrame([("x", 1, None), ("y", 2, 2), ("z", 3, 3)], "k string, p int, q int")
    b = spark.createDataFrame([("x", 1, None), ("y", 2, 9), ("w", 3, 3)], "k string, p int, q int")
    assert {tuple(r) for r in field_diff(a, b, "k", ["p", "q"]).collect()} == {
        ("y", "both", "q"), ("z", "left_only", None), ("w", "right_only", None)
    }
    nulls = a.unionByName(spark.createDataFrame([(None, 5, 5)], a.schema))
    assert {tuple(r) for r in field_diff(nulls, nulls.withColumn("q", F.col("q") + 1), "k", ["q"]).collect()} == {
        (k, "both", "q") for k in ("y", "z", None)
    }
    assert {tuple(r) for r in field_diff(nulls, a, "k", ["q"]).collect()} == {(None, "left_only", None)}
    twice = a.unionByName(a)
    assert multiset_diff(twice, a).count() == 3 and multiset_diff(a, a).count() == 0


def test_dedupe_keeps_first_and_last_of_a_hot_id(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    first = {r["k"]: r["v"] for r in first_per_key(df, ["k"], [F.col("v")]).collect()}
    last = {r["k"]: r["v"] for r in last_per_key(df, ["k"], [F.col("v")]).collect()}
    assert first[-1] == 0 and last[-1] == 2997 and len(first) == len(last) == 2001
    plan = first_per_key(df, ["k"], [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min(" in plan


def test_landed_lines_survive_blank_and_broken_ones(spark, tmp_path):
    from tidemark.sources import read_posts

    (tmp_path / "a.jsonl").write_text(json.dumps(SAMPLE_POSTS[0]) + "\n\nnot json\n")
    rows = read_posts(spark, str(tmp_path)).collect()
    assert sorted(len(r["quality_flags"]) for r in rows) == [0, 1]


def test_receipt_lake_and_summary_agree(spark, tmp_path):
    """Repeated ids, absent and null ids, a post without a time and broken lines."""
    posts = [
        {"id": "a", "created_at": "2031-05-01T10:00:00Z", "text": "first", "public_metrics": {"like_count": 1}},
        {"id": "a", "created_at": "2031-05-01T10:00:00Z", "text": "later", "public_metrics": {"like_count": 5}},
        {"created_at": "2031-05-01T11:00:00Z", "text": "nobody"},
        {"created_at": "2031-05-01T11:00:00Z", "text": "nobody"},
        {"id": None, "created_at": "2031-05-02T11:00:00Z", "text": "null id"},
        {"id": "t", "text": "no time"},
    ]
    (tmp_path / "in.jsonl").write_text("\n".join([*map(json.dumps, posts), "{broken", "also broken"]))
    for _ in range(2):
        receipt = run_etl(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "lake"), RUN)
    lake = spark.read.schema(ENRICHED).parquet(receipt["locations"]["posts"])
    summary = spark.read.parquet(receipt["locations"]["daily_summary"])
    assert receipt["post_count"] == 5 == lake.count() == summary.agg(F.sum("post_count")).first()[0]
    assert receipt["rejected"] == 2 == spark.read.parquet(receipt["locations"]["rejects"]).count()
    assert lake.filter("id = 'a'").first()["text"] == "later"
    more = tmp_path / "more.jsonl"
    more.write_text(json.dumps({"id": "b", "created_at": "2031-05-01T12:00:00Z", "text": "same day"}))
    receipt = run_etl(spark, str(more), str(tmp_path / "lake"), RUN + dt.timedelta(days=1))
    day = spark.read.parquet(receipt["locations"]["daily_summary"]).filter("run_date = '2026-01-18' and event_day = '2031-05-01'").first()
    assert receipt["post_count"] == 1 and day["post_count"] == 4


def test_inventory_counts_rows_under_odd_names(spark, tmp_path):
    names = ["a b", "x:y", "p+q", "50%", "ü/é", "plain", "[z]", None]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names) for _ in range(i + 1)], "id int, k string")
    rows.write.partitionBy("k").parquet(str(tmp_path / "odd lake"))
    got = scan.object_inventory(spark, str(tmp_path / "odd lake")).groupBy("partition").agg(F.sum("rows")).collect()
    assert sorted(r[1] for r in got) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert {r[0] for r in got} >= {"k=a b", "k=x%3Ay", "k=p+q", "k=50%25", "k=plain"}


def test_drifted_read_keeps_partition_columns_and_prunes(spark, rows, tmp_path):
    """Two types of a column over whole days, within one day, and below no directory at all."""
    root = str(tmp_path / "lake")
    sink.write_event_date(rows, root)
    other = rows.withColumn("like_count", F.col("like_count").cast("double")).drop("scorer")
    later = other.withColumn("event_date", F.date_add("event_date", 10))
    both = other.filter("event_day = '2026-01-16'")
    for part in (later, both):
        part.write.partitionBy("event_date").mode("append").parquet(root)
    lake = scan.read_drifted(spark, root, ENRICHED)
    assert lake.schema == ENRICHED
    got = {(str(r["event_date"]), r["n"], r["likes"]) for r in lake.groupBy("event_date").agg(F.count("*").alias("n"), F.sum("like_count").alias("likes")).collect()}
    days = {str(r["event_date"]): (r["n"], r["likes"]) for r in rows.groupBy("event_date").agg(F.count("*").alias("n"), F.sum("like_count").alias("likes")).collect()}
    (n15, l15), (n16, l16) = days["2026-01-15"], days["2026-01-16"]
    assert got == {("2026-01-15", n15, l15), ("2026-01-16", 2 * n16, 2 * l16), ("2026-01-25", n15, l15), ("2026-01-26", n16, l16)}
    one = lake.filter(F.col("event_date") == F.lit("2026-01-25").cast("date"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(event_date") == plan.count("FileScan") >= 2
    assert one.count() == n15 and one.filter("scorer is not null").count() == 0
    layouts = scan.lake_layouts(spark, root).collect()
    assert len(layouts) == 2 and sum(p.endswith(".parquet") for r in layouts for p in r["paths"]) == 2


def test_two_runs_of_one_date_leave_lake_summary_and_rejects_in_step(spark, tmp_path):
    out = str(tmp_path / "out")

    def start(name, posts, *broken):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.jsonl").write_text("\n".join([*map(json.dumps, posts), *broken]))
        return run_etl(spark, str(folder), out, RUN)

    def summary():
        return {(r["event_day"], r["post_count"]) for r in spark.read.parquet(f"{out}/daily_summary").collect()}

    start("one", SAMPLE_POSTS[:3], "{broken", "also broken")
    assert spark.read.parquet(f"{out}/rejects").count() == 2 and summary() == {("2026-01-15", 3)}
    start("two", SAMPLE_POSTS[3:])
    assert spark.read.parquet(f"{out}/rejects").count() == 0
    assert summary() == {("2026-01-15", 3), ("2026-01-16", 2)}
    again = {**SAMPLE_POSTS[0], "id": "77"}
    receipt = start("three", [again], "{broken")
    assert receipt["rejected"] == 1 and spark.read.parquet(f"{out}/rejects").count() == 1
    assert summary() == {("2026-01-15", 4), ("2026-01-16", 2)}
    lake = scan.read_lake(spark, f"{out}/posts", ENRICHED)
    assert {(r["event_day"], r["count"]) for r in lake.groupBy("event_day").count().collect()} == summary()


def test_dedupe_shuffles_twice_and_sorts_no_aggregate(spark, rows):
    # Without broadcasts, so that the plan is the one of large tables.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = last_per_key(rows, ["id", "event_date"], [F.col("engagement_total")])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2 and "SortAggregate" not in plan and "Window" not in plan


@pytest.mark.parametrize("pick, best", [(first_per_key, min), (last_per_key, max)])
def test_dedupe_against_a_plain_pick(spark, pick, best):
    import random

    rng = random.Random(9)
    data = [(rng.choice(["a", "b", "", None]), rng.choice([1, 2, None]), rng.choice([None, -(2**63), 2**63 - 1, 0, 5, -5]), rng.choice("xyz")) for _ in range(300)]
    df = spark.createDataFrame(data, "k string, j int, o bigint, v string").repartition(5)
    got = pick(df, ["k", "j"], [F.col("o")], copies="n").collect()
    low = lambda o: -(2**63) - 1 if o is None else o
    groups = {}
    for k, j, o, v in data:
        groups.setdefault((k, j), []).append((low(o), o, v))
    assert len(got) == len(groups)
    for r in got:
        mine = groups[r["k"], r["j"]]
        assert low(r["o"]) == best(mine)[0] and r["n"] == len(mine) and (low(r["o"]), r["o"], r["v"]) in mine
    # Ties fall the same way whatever the order of rows.
    again = pick(df.repartition(2), ["k", "j"], [F.col("o")], copies="n").collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_a_run_on_another_file_system(spark, tmp_path):
    """The same code path over ``viewfs``, a Hadoop scheme of its own, mounted on a local folder."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(map(json.dumps, SAMPLE_POSTS)))
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("fs.viewfs.mounttable.store.link./data", f"file://{tmp_path}")
    root = "viewfs://store/data"
    for _ in range(2):
        receipt = run_etl(spark, f"{root}/in", f"{root}/out", RUN)
    assert receipt["post_count"] == 5 and receipt["locations"]["posts"] == f"{root}/out/posts"
    lake = scan.read_lake(spark, f"{root}/out/posts", ENRICHED)
    assert ids(lake) == list("12345") and (tmp_path / "out" / "posts").is_dir()
    assert sorted(r["rows"] for r in scan.object_inventory(spark, f"{root}/out/posts", ENRICHED).collect()) == [2, 3]


def _numbered(spark, n, parts=3, likes="id"):
    """``n`` posts on two days, in ``parts`` tasks."""
    day = F.date_add(F.lit("2026-01-15").cast("date"), (F.col("id") % 2).cast("int"))
    posts = spark.range(0, n, 1, parts).select(
        F.col("id").cast("string").alias("id"), day.cast("string").alias("created_at"), F.lit("text").alias("text"), F.expr(likes).cast("bigint").alias("like_count"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("retweet_count", "reply_count", "quote_count")], F.lit("s").alias("source"),
        F.expr(likes).cast("bigint").alias("engagement_total"), F.lit(0.0).alias("sentiment_score"), F.lit("neutral").alias("sentiment_label"),
        day.cast("string").alias("event_day"), F.lit("none").alias("scorer"), F.lit("1").alias("scorer_version"), day.alias("event_date"))
    return posts


def test_days_are_written_where_the_rows_are(spark, tmp_path):
    import pyarrow.parquet as pq

    sink.write_event_date(_numbered(spark, 30), str(tmp_path / "days"))
    files = sorted((tmp_path / "days").rglob("part-*.parquet"))
    assert len(files) == 6  # two days in each of three tasks: no row went to another task
    assert {pq.ParquetFile(f).metadata.row_group(0).column(2).compression for f in files} == {"ZSTD"}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_merge_moves_no_stored_text(spark, tmp_path):
    """A file of more rows than one bitmap covers; first and last rows of bitmaps replaced."""
    root, n = str(tmp_path / "merge"), 140_000
    sink.merge_posts(_numbered(spark, n, 1), root)
    update = _numbered(spark, n, 2, likes="id + 1000000").filter("int(id) < 2 or int(id) between 65530 and 65545 or int(id) >= 139998")
    for _ in range(2):
        sink.merge_posts(update, root)
    lake = scan.read_lake(spark, root, ENRICHED)
    changed = lake.filter(F.col("like_count") >= 1000000)
    assert lake.count() == n and lake.select("id").distinct().count() == n
    assert sorted(int(r[0]) for r in changed.select("id").collect()) == [0, 1, *range(65530, 65546), 139998, 139999]
    plan = sink._without(sink.touched(lake, update), update)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("few", [200_000, 0])
def test_latest_of_repeated_ids(spark, monkeypatch, few):
    monkeypatch.setattr(sink, "FEW_IDS", few)
    once = _numbered(spark, 6)
    again = once.filter("id in ('1', '2')").withColumn("engagement_total", F.lit(50).cast("bigint"))
    undated = once.filter("id = '3'").withColumn("event_date", F.lit(None).cast("date"))
    nameless = once.filter("id = '4'").withColumn("id", F.lit(""))
    batch = once.union(again).union(once.filter("id = '5'")).union(undated).union(undated).union(nameless).union(nameless)
    found = sorted((r["id"], str(r["event_date"]), r["engagement_total"]) for r in sink.latest(batch).collect())
    a, b = "2026-01-15", "2026-01-16"
    assert found == [("", a, 4), ("", a, 4), ("0", a, 0), ("1", b, 50), ("2", a, 50), ("3", b, 3), ("3", "None", 3), ("4", a, 4), ("5", b, 5)]


def test_posts_of_a_document_are_written_next_to_each_other(spark, tmp_path):
    """Few documents, which Spark would send to the posts: the text of each is written in one stretch."""
    sf = str(tmp_path)
    spark.range(9).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.concat(F.lit("text "), "id").alias("text")).write.parquet(f"{sf}/documents.parquet")
    spark.range(3000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 100).alias("ts"), F.col("id").alias("user_id"),
        F.lit("click").alias("event_type"), F.lit(1.5).alias("value"), F.lit('{"k": 1}').alias("props"),
    ).write.parquet(f"{sf}/events.parquet")
    posts = stored_rows(spark, sf).select(F.spark_partition_id().alias("task"), "text").collect()
    stretches = 1 + sum(a != b for a, b in zip(posts, posts[1:]))
    assert len(posts) == 3000 and stretches == 9


def test_a_write_packs_texts_and_leaves_no_shuffle_files(spark, tmp_path):
    import random
    import time

    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(6000)]
    often = [1 / (1 + i) for i in range(len(words))]
    texts = spark.createDataFrame([(str(i), " ".join(rng.choices(words, often, k=1500))) for i in range(600)], "id string, said string").coalesce(1)
    posts = _numbered(spark, 600, 1).join(F.broadcast(texts), "id").withColumn("text", F.col("said")).drop("said")
    held = lambda: {b.name() for b in _blocks(spark) if b.name().startswith("shuffle_")}
    before = held()
    sink.write_event_date(posts.repartition(1, "source"), str(tmp_path / "days"))
    until = time.time() + 20
    while held() - before and time.time() < until:
        time.sleep(0.2)
    assert not held() - before
    posts.repartition(1, "source").write.option("compression", "zstd").partitionBy("event_date").parquet(str(tmp_path / "plain"))
    size = {name: sum(f.stat().st_size for f in (tmp_path / name).rglob("part-*.parquet")) for name in ("days", "plain")}
    assert size["days"] < 0.985 * size["plain"]
    assert multiset_diff(scan.read_lake(spark, str(tmp_path / "days"), ENRICHED), conform(posts, ENRICHED)).count() == 0


def _blocks(spark):
    """Files of the running session's block manager: shuffles, broadcasts, cached rows."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return [files.apply(i) for i in range(files.size())]


def _rows_of(df):
    return sorted((tuple(r) for r in df.select(*ENRICHED.names).collect()), key=repr)


@pytest.mark.parametrize("at_a_time", [0, 2**40])
def test_merges_against_a_plain_merge(spark, tmp_path, monkeypatch, at_a_time):
    """Updates, repeated ids, posts without an id or a day and unchanged days, some days at a time or all together."""
    import random
    from collections import Counter

    monkeypatch.setattr(sink, "MERGE_BYTES", at_a_time)
    rng, root = random.Random(11), str(tmp_path / "lake")

    def post(ident, day, n):
        date = None if day is None else dt.date(2026, 1, day)
        return (ident, str(date), f"text {n}", n, 0, 0, 0, rng.choice(["s", None]), n, 0.5, "neutral", str(date), "x", "1", date)

    def batch():
        known = [post(str(i), None if i % 7 == 0 else 1 + i % 5, rng.randint(0, 9)) for i in rng.sample(range(40), 15)]
        again = [(*p[:2], p[2] + "!", *p[3:8], p[8] + 1, *p[9:]) for p in rng.sample(known, 3)] + rng.sample(known, 3)
        return known + again + [post(rng.choice(["", "None", None]), rng.choice([None, 1, 3]), rng.randint(0, 1)) for _ in range(6)]

    model = Counter()
    for rows in [first := batch(), batch(), batch(), first, first]:
        sink.merge_posts(spark.createDataFrame(rows, ENRICHED).repartition(3), root)
        win = {}
        for p in rows:
            if p[0] not in ("", "None", None) and ((p[0], p[14]) not in win or p[8] > win[p[0], p[14]][8]):
                win[p[0], p[14]] = p
        nameless = Counter(p for p in rows if p[0] in ("", "None", None))
        kept = Counter({p: n for p, n in model.items() if p[0] in ("", "None", None) or (p[0], p[14]) not in win})
        model = (kept | nameless) + Counter(win.values())
        assert _rows_of(spark.read.schema(ENRICHED).parquet(root)) == sorted(model.elements(), key=repr)


def test_a_merge_writes_changed_days_some_at_a_time_and_clears_its_batch(spark, tmp_path, monkeypatch):
    root, n = str(tmp_path / "lake"), 20
    days = F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int") % 5)
    posts = _numbered(spark, n).withColumns({"event_date": days, "event_day": days.cast("string")})
    sink.merge_posts(posts, root)
    files = lambda: {str(p.relative_to(root)) for p in (tmp_path / "lake").rglob("part-*.parquet")}
    first, written, tables = files(), [], []
    whole, path = sink.overwrite_days, sink.scratch_path
    monkeypatch.setattr(sink, "MERGE_BYTES", 0)
    monkeypatch.setattr(sink, "overwrite_days", lambda rows, at: (written.append({r[0] for r in rows.select("event_day").distinct().collect()}), whole(rows, at)))
    monkeypatch.setattr(sink, "scratch_path", lambda *a: (tables.append(path(*a)), tables[-1])[1])
    sink.merge_posts(posts, root)
    assert written == [] and files() == first
    update = posts.withColumn("like_count", F.when(F.col("event_day") < "2026-01-04", F.col("like_count") + 1).otherwise(F.col("like_count")))
    sink.merge_posts(update, root)
    assert written == [{"2026-01-01"}, {"2026-01-02"}, {"2026-01-03"}]
    same = {f for f in first if "event_date=2026-01-04" in f or "event_date=2026-01-05" in f}
    assert same and files() & first == same
    assert _rows_of(scan.read_lake(spark, root, ENRICHED)) == _rows_of(update)
    assert len(tables) == 3 and not any((tmp_path / t).exists() for t in tables)


def test_what_changes_a_day(spark):
    base = _numbered(spark, 1).select(*ENRICHED.names).first().asDict()

    def days(batch, stored):
        rows = lambda some: spark.createDataFrame([tuple({**base, **p}[c] for c in ENRICHED.names) for p in some], ENRICHED)
        return [r[0] for r in sink.changed_days(rows(stored), rows(batch)).collect()]

    a, nameless = {"id": "a"}, {"id": ""}
    undated, day = {"id": "a", "event_date": None}, base["event_date"]
    for batch, stored, want in [
        ([a], [a], []), ([a, a], [a], []), ([a], [a, {"id": "b"}], []), ([], [a], []), ([undated], [undated, a], []),
        ([a], [], [day]), ([a], [a, a], [day]), ([a, {**a, "like_count": 9}], [a], [day]), ([undated], [a], [None]),
        ([{**a, "source": None}], [a], [day]), ([{**a, "source": "", "text": "x"}], [{**a, "source": "x", "text": ""}], [day]),
        ([{**a, "source": None, "text": "x"}], [{**a, "source": "x", "text": None}], [day]), ([{**a, "text": "Text"}], [a], [day]),
        ([nameless], [nameless], []), ([nameless], [nameless, nameless], []), ([nameless, nameless], [nameless], [day]),
        ([{"id": None}], [nameless], [day]), ([{**nameless, "text": "other"}], [nameless], [day]),
    ]:
        assert days(batch, stored) == want, (batch, stored)
