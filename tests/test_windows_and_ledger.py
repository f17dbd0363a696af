"""Run windows, write logs, attempts, sizes and cost, against plain-Python recounts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import event_partition_path, path_date, posts_partition_path, run_stamp, summary_partition_path
from tidemark.operators import attempts as att
from tidemark.operators import audit, cost, ledger
from tidemark.operators import windows as win
from tidemark.sources.reference import POSTS_SIZES, SUMMARY_SIZES, prices, size_points

DAY = dt.timedelta(days=1)
START = dt.datetime(2026, 1, 1)


def make_posts(seed=3, days=12, per_day=9):
    """Random instants, some exactly at midnight, some ids on several days."""
    rng = random.Random(seed)
    out = []
    for d in range(days):
        for k in range(per_day):
            at = START + d * DAY + dt.timedelta(seconds=rng.randint(0, 86399))
            if rng.random() < 0.15:
                at = START + d * DAY
            ident = f"p{d}-{k}" if rng.random() < 0.7 else f"hot{rng.randint(0, 3)}"
            out.append((ident, at))
    return out


@pytest.fixture(scope="module")
def stream(spark):
    rows = make_posts()
    return rows, spark.createDataFrame(rows, "id string, created_ts timestamp_ntz").cache()


def test_replay_finds_windows_of_any_length_and_bounds(spark, stream):
    rows, posts = stream
    hour = dt.timedelta(hours=1)
    spans = [(0, START, START + 12 * DAY), (1, START + 5 * hour, START + 9 * DAY + 7 * hour), (2, START + 2 * DAY, START + 2 * DAY + hour), (3, START, START)]
    runs = spark.createDataFrame([(r, b, a, b) for r, a, b in spans], "run bigint, run_ts timestamp_ntz, window_start timestamp_ntz, window_end timestamp_ntz")
    for closed in ("left", "right"):
        got = {}
        for r in win.replay(posts, runs, closed=closed).select("run", "id").collect():
            got.setdefault(r["run"], []).append(r["id"])
        want = {r: sorted(i for i, t in rows if inside(t, a, b, closed)) for r, a, b in spans}
        assert {k: sorted(x) for k, x in got.items()} == {k: x for k, x in want.items() if x}
        counts = {r["run"]: (r["extracted"], r["distinct_extracted"]) for r in win.run_extracts(posts, runs, closed).collect()}
        assert counts == {r: (len(x), len(set(x))) for r, x in want.items()}


def test_counts_over_windows_at_any_instant(spark, stream):
    """Edges at minutes, on posts' own instants, in one hour together; windows that nest, repeat or miss all posts."""
    rows, posts = stream
    rng = random.Random(8)
    instants = sorted(t for _, t in rows)
    minute = dt.timedelta(minutes=1)
    spans = [(r, START + rng.randint(-500, 18_000) * minute, START + rng.randint(0, 18_000) * minute) for r in range(40)]
    spans += [(40, instants[5], instants[50]), (41, instants[5], instants[50]), (42, instants[7], instants[7]), (43, START - 9 * DAY, START - 8 * DAY), (44, START + 300 * minute, START + 330 * minute)]
    runs = spark.createDataFrame([(r, b, a, b) for r, a, b in spans], "run bigint, run_ts timestamp_ntz, window_start timestamp_ntz, window_end timestamp_ntz")
    for closed in ("left", "right"):
        want = {r: [i for i, t in rows if inside(t, a, b, closed)] for r, a, b in spans}
        counts = {r["run"]: (r["extracted"], r["distinct_extracted"]) for r in win.run_extracts(posts, runs, closed).collect()}
        assert counts == {r: (len(x), len(set(x))) for r, x in want.items()}
        reached = [i for x in want.values() for i in x]
        total = win.duplication_factor(posts, runs, closed).first()
        assert (total["rows_in_lake"], total["distinct_posts"]) == (len(reached), len(set(reached)))
        copies = sorted((r["id"], r["created_ts"], r["copies"]) for r in win.window_copies(posts, runs, closed).collect())
        assert copies == sorted((i, t, n) for i, t in rows if (n := sum(inside(t, a, b, closed) for _, a, b in spans)))
    none = runs.limit(0)
    assert win.run_extracts(posts, none).collect() == [] and win.duplication_factor(posts, none).first()["rows_in_lake"] == 0
    assert [r["extracted"] for r in win.run_extracts(posts.limit(0), runs.filter("run < 3")).collect()] == [0, 0, 0]


def inside(t, start, end, closed):
    return start <= t < end if closed == "left" else start < t <= end


@pytest.mark.parametrize("closed", ["left", "right"])
def test_replay_and_counts_match_a_recount(stream, closed):
    rows, posts = stream
    runs = win.schedule(posts)
    spans = [tuple(r) for r in runs.select("run", "window_start", "window_end").orderBy("run").collect()]
    assert spans[0] == (0, START - 6 * DAY, START + DAY) and len(spans) == 12
    want = {r: [i for i, t in rows if inside(t, a, b, closed)] for r, a, b in spans}
    got = {}
    for r in win.replay(posts, runs, closed=closed).select("run", "id").collect():
        got.setdefault(r["run"], []).append(r["id"])
    assert {k: sorted(x) for k, x in got.items()} == {k: sorted(x) for k, x in want.items()}
    counts = {r["run"]: (r["extracted"], r["distinct_extracted"]) for r in win.run_extracts(posts, runs, closed).collect()}
    assert counts == {r: (len(x), len(set(x))) for r, x in want.items()}
    total = win.duplication_factor(posts, runs, closed).first()
    reached = [i for x in want.values() for i in x]
    assert (total["rows_in_lake"], total["distinct_posts"]) == (len(reached), len(set(reached)))


def test_replay_is_a_hash_join(stream):
    _, posts = stream
    plan = win.replay(posts, win.schedule(posts))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_duplication_of_nothing_is_zero(stream):
    _, posts = stream
    row = win.duplication_factor(posts.filter("false"), win.schedule(posts)).first()
    assert (row["rows_in_lake"], row["distinct_posts"], row["duplication_factor"]) == (0, 0, 0.0)


def test_seven_day_overlap_without_failures_exceeds_five(spark):
    posts = spark.range(0, 90 * 12).select(
        F.col("id").cast("string").alias("id"),
        F.expr("timestamp_ntz'2026-01-01 01:00:00' + make_dt_interval(cast(id div 12 as int), cast(id % 12 as int))").alias("created_ts"),
    )
    row = win.duplication_factor(posts, win.schedule(posts)).first()
    assert row["distinct_posts"] == 1080 and 6.7 < row["duplication_factor"] < 6.8


STATES = ["success", "failed", "failed", "success", "success", "failed", "success", "success", "failed", "success", "failed", "failed"]


def with_states(spark, runs):
    states = spark.createDataFrame(list(enumerate(STATES)), "run bigint, state string")
    return runs.join(states, "run")


def test_high_water_and_incremental_reads_lose_nothing(spark, stream):
    rows, posts = stream
    runs = with_states(spark, win.schedule(posts))
    marks = [r["high_water"] for r in win.high_water(runs).orderBy("run").collect()]
    want, last = [], None
    for i, state in enumerate(STATES):
        want.append(last)
        last = START + (i + 1) * DAY if state == "success" else last
    assert marks == want
    inc = win.incremental_windows(runs)
    spans = {r["run"]: (r["window_start"], r["window_end"]) for r in inc.collect()}
    assert spans[0] == (START, START + DAY) and spans[3] == (START + DAY, START + 4 * DAY)
    counts = {r["run"]: r["extracted"] for r in win.run_extracts(posts, inc).collect()}
    assert counts == {r: sum(inside(t, a, b, "left") for _, t in rows) for r, (a, b) in spans.items()}
    newer = win.newer_than_last_good(posts, runs).count()
    assert newer == sum(t >= START + 10 * DAY for _, t in rows)
    assert win.newer_than_last_good(posts, runs.withColumn("state", F.lit("failed"))).count() == len(rows)
    assert att.last_good_run(runs).first()["run"] == 9


def build_logs(spark, stream, layout, deterministic, windows):
    rows, posts = stream
    tries = spark.createDataFrame([(r, a) for r in range(12) for a in range(1, 2 + (r % 3 == 0))], "run bigint, attempt bigint")
    return ledger.lake_writes(win.slot_counts(posts), windows, tries, layout, deterministic, prefix="raw")


def recount(writes):
    """Last write wins, in time order, with a snapshot after every run."""
    objects, puts, series, replaced = {}, {}, {}, {}
    for w in sorted(writes, key=lambda w: w["seq"]):
        replaced[(w["key"], w["seq"])] = w["key"] in objects
        objects[w["key"]] = w
        puts[w["key"]] = puts.get(w["key"], 0) + 1
        rows = sum(o["rows"] for o in objects.values() if o["dataset"] == "posts")
        series[w["run"]] = (rows, sum(puts.values()), len(objects))
    return objects, puts, series, replaced


@pytest.mark.parametrize("layout,deterministic", [("run_date", False), ("run_date", True), ("event_date", False), ("event_date", True)])
def test_write_logs_account_like_a_store_of_keys(spark, stream, layout, deterministic):
    _, posts = stream
    runs = with_states(spark, win.schedule(posts))
    windows = win.incremental_windows(runs) if deterministic else runs
    log = build_logs(spark, stream, layout, deterministic, windows).cache()
    objects, puts, series, replaced = recount([r.asDict() for r in log.collect()])
    live = {r["key"]: (r["rows"], r["writes"]) for r in ledger.live_objects(log).collect()}
    assert live == {k: (o["rows"], puts[k]) for k, o in objects.items()}
    assert {(r["key"], r["seq"]): r["replaced"] for r in ledger.flag_replaced(log).collect()} == replaced
    got = {r["run"]: (r["rows_in_lake"], r["put_requests"], r["objects"]) for r in ledger.cumulative_lake(log).collect()}
    assert got == series
    assert all(r["balanced"] for r in audit.rows_balance(log).collect())
    balance = audit.put_balance(log).first()
    assert balance["balanced"] and balance["put_requests"] == sum(puts.values())
    counts = ledger.put_counts(log).agg(F.sum("put_requests"), F.sum("objects"), F.sum("overwritten")).first()
    assert tuple(counts) == (sum(puts.values()), len(objects), sum(puts.values()) - len(objects))
    paths = [r["partition"] for r in ledger.partition_rows(ledger.live_objects(log)).collect()]
    assert paths == sorted({o["partition"] for o in objects.values() if o["dataset"] == "posts"})
    if not deterministic:
        assert not any(replaced.values())
    if layout == "event_date" and deterministic:
        total = sum(o["rows"] for o in objects.values() if o["dataset"] == "posts")
        assert total == len(make_posts())  # every post exactly once
    assert audit.decreasing_steps(ledger.cumulative_lake(log), ["put_requests"]).count() == 0


def test_decrease_is_found(spark):
    series = spark.createDataFrame([(0, 5), (1, 7), (2, 6)], "run int, rows int")
    assert [r["run"] for r in audit.decreasing_steps(series, ["rows"]).collect()] == [2]


def test_cumulative_distinct_counts_an_id_at_its_first_loaded_run(spark, stream):
    rows, posts = stream
    runs = win.schedule(posts)
    loaded = spark.createDataFrame([(2,), (5,), (11,)], "run bigint")
    got = {r["run"]: r["distinct_posts"] for r in ledger.cumulative_distinct(posts, runs, loaded, win.slot_date(F.col("created_ts"))).collect()}
    seen, want = set(), {}
    for run in (2, 5, 11):
        end = START + (run + 1) * DAY
        seen |= {i for i, t in rows if end - 7 * DAY <= t < end}
        want[run] = len(seen)
    assert got == want


def test_running_partition_rows_count_writes(spark):
    log = spark.createDataFrame(
        [("k1", "posts", "p", 5, 0, 1, 1), ("k1", "posts", "p", 5, 0, 2, 2), ("k2", "posts", "p", 3, 2, 1, 201)],
        "key string, dataset string, partition string, rows bigint, run bigint, attempt bigint, seq bigint",
    )
    got = [(r["run"], r["running_rows"], r["running_writes"]) for r in ledger.partition_running_rows(log).orderBy("run").collect()]
    assert got == [(0, 10, 2), (2, 13, 3)]
    top = ledger.largest_partition(ledger.live_objects(log)).first()
    assert (top["partition"], top["rows"]) == ("p", 8)


def test_lost_unknown_and_misplaced_posts(spark):
    source = spark.createDataFrame([(str(i), START + i * DAY) for i in range(5)], "id string, created_ts timestamp_ntz")
    lake = spark.createDataFrame([("0", "2026-01-01", "x/posts/year=2026/month=01/day=01"), ("0", "2026-01-01", "x/posts/year=2026/month=01/day=02"),
                                  ("9", "", "x/posts/none"), ("2", "2026-01-03", "x/posts/year=2026/month=13/day=03")],
                                 "id string, event_day string, partition string")
    lost = audit.lost_posts(lake, source, F.lit(START + 3 * DAY).cast("timestamp_ntz"))
    assert [r["id"] for r in lost.collect()] == ["1"]
    assert audit.lost_posts(lake, source, F.lit(None).cast("timestamp_ntz")).count() == 0
    assert sorted(r["id"] for r in audit.misplaced_posts(lake).collect()) == ["0", "2"]
    bounds = audit.distinct_bounds(lake, source).first()
    assert (bounds["rows_in_lake"], bounds["distinct_posts"], bounds["unknown_posts"], bounds["sound"]) == (4, 3, 1, False)


def test_backfill_collapses_or_spreads(spark):
    posts = spark.range(0, 90 * 12).select(
        F.col("id").cast("string").alias("id"),
        F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(cast(id div 12 as int), 3)").alias("created_ts"),
    )
    run = win.backfill_run(posts)
    tries = spark.createDataFrame([(0, 1)], "run bigint, attempt bigint")
    counts = win.slot_counts(posts)
    flat = ledger.live_objects(ledger.lake_writes(counts, run, tries))
    spread = ledger.live_objects(ledger.lake_writes(counts, run, tries, ledger.EVENT_DATE, True))
    assert [r["rows"] for r in ledger.partition_rows(flat).collect()] == [1080]
    assert [r["rows"] for r in ledger.partition_rows(spread).collect()] == [12] * 90
    skew = audit.partition_skew(flat, spread)
    assert skew.agg(F.sum("run_date_rows"), F.sum("event_date_rows"), F.max("event_date_rows")).first()[:] == (1080, 1080, 12)


def test_paths_and_stamps(spark):
    stamps = ["2031-03-09 17:45:10", "2030-10-31 00:00:00", "2029-06-30 23:00:59", "2032-02-28 12:30:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").withColumn("t", F.col("s").cast("timestamp_ntz"))
    rows = df.select("s", posts_partition_path("lake/raw", F.col("t")).alias("p"), summary_partition_path("raw", F.col("t")).alias("d"),
                     run_stamp(F.col("t")).alias("k"), event_partition_path("x", F.substring("s", 1, 10)).alias("e")).collect()
    for r in rows:
        at = dt.datetime.strptime(r["s"], "%Y-%m-%d %H:%M:%S")
        assert r["p"] == f"lake/raw/posts/year={at:%Y}/month={at:%m}/day={at:%d}"
        assert r["d"] == f"raw/daily_summary/run_date={at:%Y-%m-%d}"
        assert r["k"] == at.strftime("%Y%m%dT%H%M%SZ")
        assert r["e"] == f"x/posts/year={at:%Y}/month={at:%m}/day={at:%d}"
    odd = spark.createDataFrame([("",), ("2031-03",)], "d string").select(event_partition_path("x", F.col("d")).alias("p"), path_date(event_partition_path("x", F.col("d"))).alias("back"))
    assert [tuple(r) for r in odd.collect()] == [("x/posts/year=/month=/day=", None), ("x/posts/year=2031/month=03/day=", None)]


def test_attempt_log(spark):
    log = [
        (0, "extract", 1, 1, "up_for_retry", 3), (0, "extract", 1, 2, "success", 4), (0, "transform", 2, 1, "success", 2),
        (0, "load", 3, 1, "success", 5), (1, "extract", 1, 1, "up_for_retry", 1), (1, "extract", 1, 2, "up_for_retry", 1),
        (1, "extract", 1, 3, "failed", 1),
    ]
    df = spark.createDataFrame(log, "run bigint, task string, task_ord bigint, attempt bigint, state string, duration_min bigint")
    got = {r["run"]: (r["attempts"], r["retries"], r["state"], r["duration_min"]) for r in att.attempt_rollup(df).collect()}
    assert got == {0: (4, 1, "success", 16), 1: (3, 2, "failed", 7)}
    starts = [r["start_min"] for r in att.attempt_offsets(df).orderBy("run", "task_ord", "attempt").collect()]
    assert starts == [0, 5, 9, 11, 0, 3, 6]
    totals = att.attempt_totals(df).first()
    assert (totals["runs"], totals["failed_runs"], totals["attempts"], totals["retries"], totals["short_runs"]) == (2, 1, 7, 3, 0)


def test_size_curve_hits_points_interpolates_and_extends(spark):
    probes = [r for r, _ in POSTS_SIZES] + [0, 3, 75, 5001, 100000]
    df = spark.createDataFrame([(str(i), "posts", r) for i, r in enumerate(probes)] + [("s", "daily_summary", 6), ("t", "daily_summary", 90)],
                               "key string, dataset string, rows bigint")
    got = {(r["dataset"], r["rows"]): (r["bytes"], r["extrapolated"]) for r in cost.estimate_bytes(df, size_points(spark)).collect()}
    assert len(got) == len(probes) + 2
    for rows, size in POSTS_SIZES:
        assert got[("posts", rows)] == (size, False)
    assert got[("posts", 0)] == (0, False)
    assert got[("posts", 3)] == (8026, False) and got[("posts", 75)] == (10596, False)
    slope = (128675 - 68094) / 2500
    assert got[("posts", 100000)] == (int(128675 + slope * 95000 + 0.5), True)
    assert got[("daily_summary", 6)] == (4714, False) and got[("daily_summary", 90)][1]


def test_published_fits(spark):
    for points, (a, b) in ((POSTS_SIZES, (8371.478, 24.0283)), (SUMMARY_SIZES, (4577.747, 22.9341))):
        row = cost.fit_sizes(spark.createDataFrame(points, "rows bigint, bytes bigint")).first()
        assert (round(row["overhead_bytes"], 3), round(row["bytes_per_row"], 4)) == (a, b)
    last = cost.latest_sizes(spark.createDataFrame([(1, 5, 0), (1, 6, 1), (2, 7, 0)], "rows bigint, bytes bigint, seq int"))
    assert {tuple(r) for r in last.collect()} == {(1, 6), (2, 7)}


def test_bill(spark):
    usage = spark.createDataFrame([(2_000_000_000, 1000, 500_000_000_000)], "bytes bigint, put_requests bigint, scan_bytes bigint")
    row = cost.cost_report(usage, prices(spark)).first()
    assert row["storage_usd"] == pytest.approx(0.046, abs=1e-12) and row["put_usd"] == pytest.approx(0.005, abs=1e-12)
    assert row["per_query_usd"] == pytest.approx(2.5) and row["query_usd"] == pytest.approx(2500)
    assert row["total_usd"] == pytest.approx(2500.051)


def test_crossing(spark):
    df = spark.createDataFrame([(10, 100.0), (20, 300.0), (30, 900.0)], "posts int, size double")
    assert [r[0] for r in cost.first_crossing(df, "posts", "size", 400).collect()] == [22]
    assert [r[0] for r in cost.first_crossing(df, "posts", "size", 50).collect()] == [10]
    assert cost.first_crossing(df, "posts", "size", 900).count() == 0


def test_object_sizes_and_small_files(spark):
    objects = spark.createDataFrame([("posts", 100, 10), ("posts", 300, 20), ("daily_summary", 50, 1)], "dataset string, bytes bigint, rows bigint")
    got = {r["dataset"]: (r["objects"], r["total_bytes"], r["avg_bytes"]) for r in cost.object_sizes(objects).collect()}
    assert got == {"posts": (2, 400, 200.0), "daily_summary": (1, 50, 50.0)}
    row = audit.small_files(objects, overhead_bytes=45, small=120).first()
    assert (row["objects"], row["total_bytes"], row["small_objects"], row["overhead_share"]) == (3, 450, 2, 0.3)
