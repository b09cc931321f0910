import random
from collections import deque
from datetime import date, datetime, timedelta

import pytest

from zonecast.operators import usage as U
from zonecast.operators.admission import bursts, replay_admission

START = datetime(2024, 1, 1)
LOG = "request_id bigint, client string, ts timestamp_ntz"


def test_usage_accumulates_per_client_endpoint_and_day(spark):
    rows = [
        ("a", "/predict", datetime(2024, 1, 1, 0), 1),
        ("a", "/predict", datetime(2024, 1, 1, 23, 59), 1),
        ("a", "/batch", datetime(2024, 1, 1), 10),
        ("a", "/predict", datetime(2024, 1, 2), 1),
        ("b", "/batch", datetime(2024, 1, 2), 5),
    ]
    daily = U.usage_daily(spark.createDataFrame(rows, "client string, endpoint string, ts timestamp_ntz, records bigint"))
    assert {tuple(r) for r in daily.collect()} == {
        ("a", "/predict", date(2024, 1, 1), 2, 2),
        ("a", "/batch", date(2024, 1, 1), 1, 10),
        ("a", "/predict", date(2024, 1, 2), 1, 1),
        ("b", "/batch", date(2024, 1, 2), 1, 5),
    }
    assert [r["date"].day for r in U.usage_report(daily).collect()] == [2, 2, 1, 1]
    assert {r["client"] for r in U.usage_report(daily, "b").collect()} == {"b"}


def test_keep_latest(spark):
    rows = [("x", 1, None), ("x", 3, "c"), ("x", 2, "b"), ("y", 1, "d")]
    df = spark.createDataFrame(rows, "k string, seq int, v string")
    assert {tuple(r) for r in U.dedup_latest(df, ["k"], ["seq"]).collect()} == {("x", 3, "c"), ("y", 1, "d")}


def test_request_metrics(spark):
    rows = [
        ("/p", "200", None, 0.01, 0.0),
        ("/p", "200", None, 0.3, 7.0),
        ("/p", "422", "unsupported_zone", 0.02, None),
        ("/b", "500", None, 9.0, None),
    ]
    log = spark.createDataFrame(rows, "endpoint string, status string, reason string, latency_s double, predicted double")
    assert {tuple(r) for r in U.request_counts(log).collect()} == {("/p", "200", 2), ("/p", "422", 1), ("/b", "500", 1)}
    assert [tuple(r) for r in U.rejection_counts(log).collect()] == [("unsupported_zone", 1)]
    assert U.error_count(log).first()["errors"] == 1
    lat = {(r["endpoint"], r["le"]): r["observations"] for r in U.latency_histogram(log).collect()}
    assert [lat["/p", e] for e in (0.01, 0.025, 0.25, 0.5, float("inf"))] == [1, 2, 2, 3, 3]
    assert (lat["/b", 5.0], lat["/b", float("inf")]) == (0, 1)
    pred = {r["le"]: r["observations"] for r in U.prediction_histogram(log).collect()}
    assert (pred[0.0], pred[5.0], pred[10.0], pred[float("inf")]) == (1, 1, 2, 2)


def brute(rows, limit, seconds):
    windows, out = {}, {}
    for rid, client, ts in sorted(rows, key=lambda r: (r[2], r[0])):
        w = windows.setdefault(client, deque())
        while w and w[0] < ts - timedelta(seconds=seconds):
            w.popleft()
        out[rid] = len(w) < limit
        if out[rid]:
            w.append(ts)
    return out


def replay(spark, rows, limit, seconds=60):
    out = replay_admission(spark.createDataFrame(rows, LOG).repartition(5), limit, seconds).collect()
    assert len(out) == len(rows)
    return {r["request_id"]: r["admitted"] for r in out}


def test_known_replay(spark):
    rows = [(i, "a", START + timedelta(seconds=s)) for i, s in enumerate((0, 1, 2, 3, 61))]
    assert [replay(spark, rows, 3)[i] for i in range(5)] == [True, True, True, False, True]
    # Exactly 60 s later the first entry still counts.
    rows[-1] = (4, "a", START + timedelta(seconds=60))
    assert not replay(spark, rows, 3)[4]


@pytest.mark.parametrize("seed,limit", [(1, 3), (2, 1), (3, 10), (4, 5)])
def test_replay_equals_a_plain_loop(spark, seed, limit):
    rng = random.Random(seed)
    rows, rid = [], 0
    for client, mean in (("hot", 2.0), ("steady", 15.0), ("calm", 200.0)):
        t = START
        for _ in range({"hot": 1500, "steady": 700, "calm": 200}[client]):
            gap = rng.expovariate(1 / mean) if rng.random() > 0.03 else rng.uniform(0, 600)
            t += timedelta(seconds=round(gap, rng.choice([0, 3])))
            rows.append((rid, client, t))
            rid += 1
    assert replay(spark, rows, limit) == brute(rows, limit, 60)


def test_calm_logs_have_no_bursts_and_lead_ins_are_kept(spark):
    calm = spark.createDataFrame([(i, "a", START + timedelta(minutes=i)) for i in range(30)], LOG)
    assert bursts(calm, 2).where("busy").isEmpty()
    # 59.9 s: the calm minute before the burst decides its first requests.
    rows = [(0, "a", START + timedelta(seconds=59.9))] + [(i, "a", START + timedelta(seconds=60 + i)) for i in range(1, 6)]
    assert replay(spark, rows, 3) == brute(rows, 3, 60)


def test_rate_equals_a_plain_loop(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("aab"), START + timedelta(seconds=rng.choice([60, 1, 0.5]) * rng.randrange(600))) for i in range(900)]
    want = {
        i: sum(1 for _, d, u in rows if d == c and t - timedelta(seconds=60) <= u <= t) for i, c, t in rows
    }
    got = {r["request_id"]: r["recent"] for r in U.request_rate(spark.createDataFrame(rows, LOG)).collect()}
    assert got == want
