from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_usage import brute
from zonecast.operators import drift as D
from zonecast.operators.history import hourly_demand
from zonecast.operators.usage import usage_daily
from zonecast.streaming import jobs as J

START = datetime(2024, 1, 1)
TRIPS = "zone_id bigint, ts timestamp_ntz, fare double, distance double"


def follow(spark, tmp_path, parts, schema, name="in"):
    """Each list of rows becomes one file, read one per micro-batch in order."""
    path = str(tmp_path / name)
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(df, tmp_path, name="out"):
    return J.run_available(df, str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"))


def test_closed_hours_equal_batch(spark, tmp_path):
    rows = [(z, START + timedelta(minutes=11 * i), float(i), 1.0) for i in range(120) for z in (1, 2)]
    out = run(J.hourly_stream(follow(spark, tmp_path, [rows[:90], rows[90:]], TRIPS)), tmp_path)
    last = max(r[1] for r in rows) - timedelta(hours=2)
    batch = hourly_demand(spark.createDataFrame(rows, TRIPS)).where(F.col("hour_ts") + F.expr("interval 1 hour") <= F.lit(last))
    batch = batch.select(out.columns)
    assert out.count() > 0 and out.exceptAll(batch).isEmpty() and batch.exceptAll(out).isEmpty()


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    first = [(1, START + timedelta(hours=h), 1.0, 1.0) for h in range(10)]
    late = [(1, START, 1.0, 1.0), (1, START + timedelta(hours=8), 1.0, 1.0), (1, START + timedelta(hours=20), 1.0, 1.0)]
    # Lateness is judged by the watermark of the batch before.
    parts = [first, [(1, START + timedelta(hours=9), 1.0, 1.0)], late]
    got = {r["hour_ts"].hour: r["trip_count"] for r in run(J.hourly_stream(follow(spark, tmp_path, parts, TRIPS)), tmp_path).collect()}
    assert got[0] == 1 and got[8] == 2


def test_usage_counters(spark, tmp_path):
    schema = "client string, endpoint string, ts timestamp_ntz, records bigint"
    rows = [(c, "/p", START + timedelta(hours=5 * i), i) for i in range(30) for c in "ab"]
    out = run(J.usage_stream(follow(spark, tmp_path, [rows[:20], rows[20:]], schema)), tmp_path)
    closed = usage_daily(spark.createDataFrame(rows, schema)).where("date <= DATE'2024-01-05'").select(out.columns)
    assert out.exceptAll(closed).isEmpty() and closed.exceptAll(out).isEmpty()


def test_log_appends_served_predictions_once(spark, tmp_path):
    schema = "zone_id bigint, hour_ts timestamp_ntz, predicted_count double"
    stream = follow(spark, tmp_path, [[(1, START, 2.0)], [(2, START, None), (3, START, 4.0)]], schema)
    for _ in range(2):
        J.prediction_log_stream(stream, str(tmp_path / "log"), str(tmp_path / "ck"), START).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "log")).collect()
    assert {(r["zone_id"], r["predicted_value"]) for r in rows} == {(1, 2.0), (3, 4.0)} and len(rows) == 2


def test_quality_windows_equal_plain_sums(spark, tmp_path):
    preds = [(f"p{i}", float(i), START + timedelta(hours=3 * i)) for i in range(64)]
    acts = [(f"p{i}", float(i + i % 4), START + timedelta(hours=3 * i + 2)) for i in range(64) if i % 5]
    p = follow(spark, tmp_path, [preds], "prediction_id string, predicted_value double, created_at timestamp_ntz", "p")
    a = follow(spark, tmp_path, [acts], "prediction_id string, actual_value double, observed_at timestamp_ntz", "a")
    out = run(J.quality_stream(p, a, "2 days", "1 day", "1 day"), tmp_path).collect()
    truth, made = {k: v for k, v, _ in acts}, {k: (v, t) for k, v, t in preds}
    assert len(out) >= 3
    for r in out:
        errs = [v - truth[k] for k, (v, t) in made.items() if k in truth and r["window_start"] <= t < r["window_end"]]
        assert r["matched_pairs"] == len(errs)
        assert r["mae"] == pytest.approx(sum(map(abs, errs)) / len(errs))
        assert r["rmse"] == pytest.approx((sum(e * e for e in errs) / len(errs)) ** 0.5)


def test_quality_has_open_windows_and_late_actuals(spark, tmp_path):
    """Every pair is in each window of its prediction, the last and the late ones too."""
    preds = [(f"p{i}", float(i), START + timedelta(hours=3 * i)) for i in range(64)]
    acts = [(f"p{i}", float(i + i % 4), START + timedelta(hours=3 * i + (200 if i % 7 == 0 else 2))) for i in range(64) if i % 5]
    p = follow(spark, tmp_path, [preds[:40], preds[40:]], "prediction_id string, predicted_value double, created_at timestamp_ntz", "p")
    a = follow(spark, tmp_path, [acts[30:], acts[:30]], "prediction_id string, actual_value double, observed_at timestamp_ntz", "a")
    out = J.quality_latest(p, a, str(tmp_path / "pairs"), str(tmp_path / "pairs-checkpoint"), "2 days", "1 day").collect()
    truth, want = {k: v for k, v, _ in acts}, {}
    for k, v, t in preds:
        for back in range(2):
            if k in truth:
                want.setdefault(datetime(t.year, t.month, t.day) - timedelta(days=back), []).append(v - truth[k])
    assert {r["window_start"]: r["matched_pairs"] for r in out} == {w: len(errs) for w, errs in want.items()}
    for r in out:
        errs = want[r["window_start"]]
        assert r["mae"] == pytest.approx(sum(map(abs, errs)) / len(errs))


def test_quality_pairs_over_batches_equal_plain_loops(spark, tmp_path):
    """Repeated, missing and unusual ids on both sides, in any order; no copy of a row beside the one stored with a packed id."""
    ids = ["616263" * 5 + "64", "616263", "abc", "ABCDEF0123456789abcdef0123456789", "", None, *[f"{i:032x}" for i in range(20)]]
    preds = [(ids[i % 26], float(i), START + timedelta(hours=i)) for i in range(60)] + [(ids[7], 1.0, None)]
    acts = [(ids[i * 7 % 26], float(i % 9), START + timedelta(hours=i // 2 + 20)) for i in range(80)] + [(ids[7], 1.0, None)]
    p = follow(spark, tmp_path, [preds[40:], preds[:25], preds[25:40]], "prediction_id string, predicted_value double, created_at timestamp_ntz", "p")
    a = follow(spark, tmp_path, [acts[:10], acts[50:], acts[10:50]], "prediction_id string, actual_value double, observed_at timestamp_ntz", "a")
    out = J.quality_latest(p, a, str(tmp_path / "pairs"), str(tmp_path / "ck"), "2 days", "2 days").collect()
    want = [v - w for k, v, t in preds for j, w, u in acts if k is not None and k == j and t and u and u >= t]
    assert want and sum(r["matched_pairs"] for r in out) == len(want)
    assert sum(r["matched_pairs"] * r["mae"] for r in out) == pytest.approx(sum(map(abs, want)))
    assert not (tmp_path / "ck/state").exists()


def test_packed_ids_are_one_to_one(spark):
    ids = ["61" * 16, "a" * 16, "616263", "abc", "AB" * 16, "ab" * 16, "\x00" * 17, "", "zz" * 16, "\x00" * 16 + "a", None]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i string").select(J.packed_id("i")).collect()]
    assert got[-1] is None and len({bytes(b) for b in got[:-1]}) == len(ids) - 1
    assert len(got[0]) == 16


def test_stream_quality_matches_every_pair(spark):
    """Against a batch join: windows of two days hold every matched prediction twice."""
    from zonecast.operators.history import densify
    from zonecast.plans import catalog as C

    sf = "/root/testdata/sf0.001"
    C.use_utc(spark)
    log, _ = C.log_and_actuals(spark, sf)
    truth = densify(C.hourly(spark, sf), C.CONFIG.start, C.CONFIG.end)
    seen = truth.select(C._prediction_id("slot_mean").alias("prediction_id"), (F.col("hour_ts") + F.expr("interval 1 hour")).alias("observed_at"))
    pairs = log.join(seen, "prediction_id").where("observed_at >= created_at").count()
    got = C.QUERIES["stream_quality"](spark, sf).agg(F.sum("matched_pairs")).first()[0]
    assert pairs > 0 and got == 2 * pairs


def test_admission_state_survives_batches(spark, tmp_path):
    rows = [(i, "ab"[i % 2], START + timedelta(seconds=4 * i)) for i in range(90)]
    schema = "request_id bigint, client string, ts timestamp_ntz"
    stream = follow(spark, tmp_path, [rows[:30], rows[30:47], rows[47:]], schema)
    got = {r["request_id"]: r["admitted"] for r in run(J.admission_stream(stream, 3), tmp_path).collect()}
    assert got == brute(rows, 3, 60)


def test_drift_buffer_rolls_over_batches(spark, tmp_path):
    features = ["a", "b"]
    schema = "request_id bigint, scored_at timestamp_ntz, a double, b double"
    rows = [(i, START + timedelta(minutes=i), float(i % 10), float(i)) for i in range(300)]
    parts = [rows[:100], rows[200:], rows[100:200]]
    stream = follow(spark, tmp_path, parts, schema)
    dist = D.long_values(spark.createDataFrame(rows, schema), features)

    def evaluate(buffer):
        return D.ks_statistic(dist, D.long_values(buffer, features))

    J.drift_stream(stream, evaluate, str(tmp_path / "buf"), str(tmp_path / "rep"), str(tmp_path / "ck"), maxlen=150).awaitTermination()
    last = {r["request_id"] for r in spark.read.parquet(str(tmp_path / "buf/batch=2")).collect()}
    assert last == set(range(150, 300))
    report = spark.read.parquet(str(tmp_path / "rep"))
    assert {(r["batch"], r["n_cur"]) for r in report.select("batch", "n_cur").distinct().collect()} == {(0, 100), (1, 150), (2, 150)}


def test_open_hours_are_there_in_update_mode(spark, tmp_path):
    rows = [(z, START + timedelta(minutes=11 * i), float(i), 1.0) for i in range(120) for z in (1, 2)]
    stream = J.hourly_stream(follow(spark, tmp_path, [rows[:90], rows[90:]], TRIPS))
    out = J.run_latest(stream, ["zone_id", "hour_ts"], str(tmp_path / "latest"), str(tmp_path / "latest-checkpoint"))
    batch = hourly_demand(spark.createDataFrame(rows, TRIPS)).select(out.columns)
    assert out.count() == batch.count() and out.exceptAll(batch).isEmpty()


def test_creation_time_is_that_of_the_batch(spark):
    import time

    from zonecast.operators.quality import log_entries

    scored = spark.createDataFrame([(1, START, 2.0)], "zone_id bigint, hour_ts timestamp_ntz, predicted_count double")
    entries = log_entries(scored)
    first = entries.first()["created_at"]
    time.sleep(0.01)
    assert entries.first()["created_at"] > first
