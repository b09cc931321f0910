"""Usage upserts and quality of revised pairs, against batch jobs over the same rows in several orders."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import follow
from zonecast.operators.quality import match_actuals, with_actuals
from zonecast.operators.usage import usage_daily
from zonecast.streaming import revisions as R

START = datetime(2024, 1, 1)
PREDICTIONS = "prediction_id string, zone_id bigint, hour_ts timestamp_ntz, predicted_value double, created_at timestamp_ntz"
ACTUALS = "seq bigint, prediction_id string, zone_id bigint, hour_ts timestamp_ntz, actual_value double, observed_at timestamp_ntz"
USAGE = "client string, endpoint string, ts timestamp_ntz, records bigint"


def _rows(rng):
    """Hours with one to three predictions; submissions by id, by hour, corrected ones, unknown ones, and rows without a match."""
    predictions, actuals = [], []
    for i in range(60):
        zone, hour = i % 5 + 1, START + timedelta(hours=i // 5 * 7)
        for k in range(rng.randrange(1, 4)):
            predictions.append((f"p{i}.{k}", zone, hour, rng.randrange(12) / 2, hour - timedelta(hours=5 - k)))
        seen = hour + timedelta(hours=2)
        for _ in range(rng.randrange(4)):
            by_id = rng.random() < 0.5
            key = (f"p{i}.{rng.randrange(3)}", None, None) if by_id else (None, zone, hour)
            actuals.append((len(actuals), *key, float(rng.randrange(8)), seen + timedelta(hours=len(actuals) % 30)))
    actuals.append((len(actuals), "unknown", None, None, 1.0, START))
    actuals.append((len(actuals), None, 99, START, 1.0, START))
    actuals.append((len(actuals), None, None, None, 1.0, START))
    return predictions, actuals


def _plain_windows(pairs):
    out = {}
    for p, y, at in pairs:
        day = datetime(at.year, at.month, at.day)
        for back in range(2):
            out.setdefault(day - timedelta(days=back), []).append((p, y))
    return out


@pytest.mark.parametrize("order", [0, 1, 2])
def test_revised_quality_is_the_batch_result_in_any_order(spark, tmp_path, order):
    rng = random.Random(4)
    predictions, actuals = _rows(rng)
    log, given = spark.createDataFrame(predictions, PREDICTIONS), spark.createDataFrame(actuals, ACTUALS)
    pairs = with_actuals(log, match_actuals(log, given)).where("actual_value IS NOT NULL").collect()
    want = _plain_windows([(r["predicted_value"], r["actual_value"], r["created_at"]) for r in pairs])
    random.Random(order).shuffle(predictions)
    random.Random(order + 9).shuffle(actuals)
    p = follow(spark, tmp_path, [predictions[:50], predictions[50:70], predictions[70:]], PREDICTIONS, "p")
    a = follow(spark, tmp_path, [actuals[:20], actuals[20:21], actuals[21:]], ACTUALS, "a")
    root = str(tmp_path / "state")
    out = {r["window_start"]: r for r in R.revised_quality(p, a, root, str(tmp_path / "ck"), window="2 days", required=5).collect()}
    assert {w: r["matched_pairs"] for w, r in out.items()} == {w: len(x) for w, x in want.items()}
    for w, own in want.items():
        if len(own) < 5:
            assert out[w]["status"] == "insufficient_matched_pairs" and out[w]["mae"] is None
            continue
        sized = [2 * abs(p - y) / (p + y) for p, y in own if p + y]
        assert out[w]["status"] == "ok"
        assert out[w]["mae"] == pytest.approx(sum(abs(p - y) for p, y in own) / len(own))
        assert out[w]["rmse"] == pytest.approx((sum((p - y) ** 2 for p, y in own) / len(own)) ** 0.5)
        assert out[w]["smape"] == pytest.approx(100 * sum(sized) / len(sized) if sized else 0)
    signs = {r["sign"] for r in spark.read.schema(R._DELTA).parquet(f"{root}/pairs").collect()}
    assert -1 in signs and R.late_rows(spark, root).count() == 0


def test_a_repeated_batch_changes_nothing_and_late_rows_are_counted(spark, tmp_path):
    root, keep, hour = str(tmp_path / "state"), timedelta(days=2), START + timedelta(days=9)
    events = lambda p, a: R.quality_events(spark.createDataFrame(p, PREDICTIONS), spark.createDataFrame(a, ACTUALS))
    first = events([("a", 1, hour, 2.0, hour)], [(1, "a", None, None, 5.0, hour)])
    second = events([("b", 1, hour, 3.0, hour + timedelta(hours=1))], [(2, "a", None, None, 4.0, hour), (3, None, 1, hour, 7.0, hour)])
    old = events([("c", 2, START, 1.0, START)], [(4, "a", None, None, 9.0, hour - timedelta(days=3))])
    for batch_id, rows in enumerate([first, second, second, old]):
        R.revise_pairs(rows, min(batch_id, 1) if batch_id < 3 else 2, root, keep)
    pairs = spark.read.schema(R._DELTA).parquet(f"{root}/pairs").groupBy(*R._PAIR).agg(F.sum("sign").alias("n")).where("n <> 0")
    assert {(r["prediction_id"], r["actual_value"], r["n"]) for r in pairs.collect()} == {("a", 4.0, 1), ("b", 7.0, 1)}
    assert {(r["prediction_id"], r["batch"]) for r in R.late_rows(spark, root).collect()} == {("c", 2), ("a", 2)}


def test_a_batch_is_stored_once(spark, tmp_path, monkeypatch):
    """No copy of a micro-batch beside the state, whose ids take little more than their bits."""
    monkeypatch.setattr(R, "materialize", lambda *_: pytest.fail("a copy of the batch"))
    root, n = tmp_path / "state", 20_000
    made = spark.range(n).selectExpr("md5(CAST(id AS STRING)) AS prediction_id", "1L AS zone_id", "TIMESTAMP_NTZ'2024-01-05 00:00:00' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS hour_ts")
    made = made.selectExpr("*", "1D AS predicted_value", "TIMESTAMP_NTZ'2024-01-05 00:00:00' AS created_at")
    sent = made.selectExpr("1L AS seq", "prediction_id", "CAST(NULL AS BIGINT) AS zone_id", "CAST(NULL AS TIMESTAMP_NTZ) AS hour_ts", "3D AS actual_value", "created_at AS observed_at")
    R.revise_pairs(R.quality_events(made, sent), 0, str(root), timedelta(days=5))
    pairs = spark.read.schema(R._DELTA).parquet(f"{root}/pairs")
    assert pairs.join(made, "prediction_id", "left_semi").where("sign = 1 AND actual_value = 3").count() == n
    size = lambda at: sum(f.stat().st_size for f in (root / at).rglob("*.parquet"))
    assert size("events") < 2 * n * 26 and size("pairs") < n * 26


def test_state_reads_no_day_behind_the_horizon(spark, tmp_path):
    root = str(tmp_path / "state")
    hours = [START + timedelta(days=d) for d in range(0, 20, 4)]
    for batch_id, hour in enumerate(hours):
        R.revise_pairs(R.quality_events(spark.createDataFrame([(f"p{batch_id}", 1, hour, 1.0, hour)], PREDICTIONS), spark.createDataFrame([], ACTUALS)), batch_id, root, timedelta(days=5))
    state = R._since(spark, f"{root}/events", R._EVENT, hours[-1] - timedelta(days=5), 99)
    assert state.count() == 2
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_usage_upserts_are_the_daily_rollup(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"c{rng.randrange(4)}", rng.choice("ab"), START + timedelta(minutes=rng.randrange(6000)), rng.choice([None, 1, 5])) for _ in range(300)]
    parts = [rows[:90], rows[90:91], rows[91:]]
    stream = follow(spark, tmp_path, parts, USAGE).withColumn("source", F.col("_metadata.file_name"))
    path = str(tmp_path / "daily")
    order = lambda df: sorted(map(tuple, df.select("client", "endpoint", "date", "request_count", "total_records").collect()), key=str)
    want = order(usage_daily(spark.createDataFrame(rows, USAGE)))
    assert order(R.usage_upserts(stream, path, str(tmp_path / "ck"))) == want
    for own in (["f0"], ["f1", "f2"]):  # sources of a batch of their own; the second time they replace themselves
        for _ in range(2):
            for name in own:
                R.merge_usage(spark.createDataFrame([("new", "z", START + timedelta(days=400), 2)], USAGE).withColumn("source", F.lit(name)), path)
    got = [r for r in order(R.stored_usage(spark, path)) if r[0] == "new"]
    assert [r[3:] for r in got] == [(3, 6)]
    R.merge_usage(spark.createDataFrame([], USAGE).withColumn("source", F.lit("none")), path)
    assert len(order(R.stored_usage(spark, path))) == len(want) + 1


def test_a_merge_rewrites_only_touched_days(spark, tmp_path):
    path = tmp_path / "daily"
    day = lambda d: spark.createDataFrame([("c", "e", START + timedelta(days=d), 1)], USAGE)
    R.merge_usage(day(0).withColumn("source", F.lit("a")), str(path))
    before = {p.name: p.stat().st_mtime_ns for p in path.glob("date=2024-01-01/*.parquet")}
    R.merge_usage(day(1).withColumn("source", F.lit("b")), str(path))
    assert {p.name: p.stat().st_mtime_ns for p in path.glob("date=2024-01-01/*.parquet")} == before
    assert R.stored_usage(spark, str(path)).count() == 2
