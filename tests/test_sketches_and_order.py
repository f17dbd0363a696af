"""Sketches against exact counts, and ordered work range by range against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit, ordered
from tidemark.operators import sketches as sk
from tidemark.operators import windows as win
from tidemark.session import scratch_path

START = dt.datetime(2026, 3, 1)
DAY = dt.timedelta(days=1)


@pytest.fixture(scope="module")
def stream(spark):
    rng = random.Random(6)
    rows = [(f"p{rng.randint(0, 9_000)}", START + dt.timedelta(seconds=rng.randint(0, 9 * 86_400))) for _ in range(30_000)]
    rows += [(None, START), ("untimed", None)]
    return rows, spark.createDataFrame(rows, "id string, created_ts timestamp_ntz").cache()


def exact(rows, a, b):
    held = [i for i, t in rows if t is not None and a <= t < b]
    return len(held), len({i for i in held if i is not None})


def test_estimates_keep_their_bound(spark, stream):
    rows, posts = stream
    root = scratch_path(spark, "sketches")
    even = F.hash("id", "created_ts") % 2 == 0
    for _ in range(2):  # a batch that is written again replaces itself
        sk.write_sketches(sk.slot_sketches(posts.filter(even)), root, "a")
    sk.write_sketches(sk.slot_sketches(posts.filter(~even)), root, "b")
    stored = sk.read_sketches(spark, root)
    runs = win.schedule(posts.filter("created_ts is not null"))
    got = {r["run"]: r for r in sk.window_estimates(stored, runs).collect()}
    for r in runs.collect():
        n, ids = exact(rows, r["window_start"], r["window_end"])
        assert got[r["run"]]["extracted"] == n and abs(got[r["run"]]["distinct_estimate"] - ids) <= sk.error_bound() * ids
    far = [r for r in sk.cumulative_estimates(stored).orderBy("slot").collect()]
    for r in far:
        n, ids = exact(rows, START, r["slot"] + DAY)
        assert r["rows_so_far"] == n and abs(r["distinct_estimate"] - ids) <= sk.error_bound() * ids
    assert len(far) == 9 and far[-1]["distinct_estimate"] > 4096
    total, dup = win.duplication_factor(posts, runs).first(), sk.approximate_duplication(stored, runs).first()
    # A null id is one of the exact operator's keys, and none of the sketch's.
    assert dup["rows_in_lake"] == total["rows_in_lake"] and abs(dup["duplication_factor"] / total["duplication_factor"] - 1) <= sk.error_bound()


def test_small_sketches_are_exact_and_hours_work(spark, stream):
    rows, posts = stream
    few = posts.filter("created_ts < '2026-03-01 05:00:00'")
    hour = dt.timedelta(hours=1)
    spans = [(0, START + hour, START + 4 * hour), (1, START, START + 2 * hour), (2, START + 20 * DAY, START + 21 * DAY), (3, START, START)]
    runs = spark.createDataFrame([(r, b, a, b) for r, a, b in spans], "run bigint, run_ts timestamp_ntz, window_start timestamp_ntz, window_end timestamp_ntz")
    got = {r["run"]: (r["extracted"], r["distinct_estimate"]) for r in sk.window_estimates(sk.slot_sketches(few, "hour"), runs, "hour").collect()}
    assert got == {r: exact(rows, a, b) if r < 2 else (0, 0) for r, a, b in spans}
    with pytest.raises(Exception, match="full day"):
        sk.window_estimates(sk.slot_sketches(few), runs).collect()
    with pytest.raises(ValueError):
        sk.slot_of(F.col("created_ts"), "week")
    empty = sk.approximate_duplication(sk.slot_sketches(posts.limit(0)), runs.limit(0)).first()
    assert tuple(empty) == (0, 0, 0.0)


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(7)
    rows = [(i, rng.randint(0, 40), rng.choice([None, rng.randint(0, 9), rng.randint(0, 9)])) for i in range(2_000)]
    return sorted(rows, key=lambda r: (r[1], r[0])), spark.createDataFrame(rows, "id int, at int, v bigint").repartition(6)


def test_running_sum_and_previous(series):
    rows, df = series
    total, want, before, last = 0, {}, {}, None
    for i, _, v in rows:
        total += v or 0
        want[i], before[i], last = total, last, v
    assert {r["id"]: r["running"] for r in ordered.running_sum(df, ["at", "id"], "v", parts=7).collect()} == want
    assert {r["id"]: r["previous_v"] for r in ordered.with_previous(df, ["at", "id"], ["v"], parts=7).collect()} == before
    assert {r["id"]: r["running"] for r in ordered.running_sum(df, ["at", "id"], "v", parts=1).collect()} == want
    assert ordered.running_sum(df.limit(0), ["at", "id"], "v").collect() == []


def test_crossings_and_their_plan(series):
    rows, df = series
    limits = [0, 1, 17, 500, 501, 4_000, 10**9]
    got = {r["passed_limit"]: (r["id"], r["position"], r["running"]) for r in ordered.crossings(df, ["at", "id"], "v", limits, parts=9).collect()}
    want = {}
    for limit in limits:
        total = 0
        for n, (i, _, v) in enumerate(rows, 1):
            total += v or 0
            if total > limit:
                want[limit] = (i, n, total)
                break
    assert got == want and 10**9 not in got
    plan = ordered.running_sum(df, ["at", "id"], "v")._jdf.queryExecution().executedPlan().toString()
    # What is gathered in one task is one row per range.
    assert plan.count("SinglePartition") == 1 and "HashAggregate" in plan[: plan.index("SinglePartition") + 2_000]


def test_decreasing_steps_over_many_rows(series):
    rows, df = series
    want = [(i, v, p) for (i, _, v), (_, _, p) in zip(rows[1:], rows) if v is not None and p is not None and v < p]
    got = sorted((r["id"], r["v"], r["previous_v"]) for r in audit.decreasing_steps(df, ["v"], ["at", "id"]).collect())
    assert got == sorted(want) and len(got) > 100
