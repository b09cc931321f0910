import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.operators import baselines as B
from zonecast.operators import checks, metrics
from zonecast.operators import evaluation as E

PREDS = (
    "zone_id bigint, zone_name string, hour_of_day bigint, is_weekend bigint, trip_count bigint, a double, b double, b_raw double"
)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    out = []
    for zone in range(1, 24):
        for h in range(48):
            y = int(rng.poisson(zone % 5 * (h % 24) / 6))
            raw = y + float(rng.normal(0, 2))
            out.append((zone, f"Z{zone}", h % 24, int(h >= 24), y, float(y + zone % 3), max(raw, 0.0), raw))
    return out


@pytest.fixture(scope="module")
def preds(spark, rows):
    return spark.createDataFrame(rows, PREDS).cache()


def test_metrics_by_formula(preds, rows):
    y, a, b, raw = (np.array([r[i] for r in rows], dtype=float) for i in (4, 5, 6, 7))
    got = {r["model"]: r.asDict() for r in metrics.model_metrics(preds, ["a", "b"]).collect()}
    for m, p, n_neg in (("a", a, 0), ("b", b, int((raw < 0).sum()))):
        d = np.abs(y) + np.abs(p)
        ok = d > 0
        r = got[m]
        assert r["mae"] == pytest.approx(np.mean(np.abs(y - p)))
        assert r["rmse"] == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
        assert r["smape"] == pytest.approx(100 * np.mean(2 * np.abs(y - p)[ok] / d[ok]))
        assert (r["n_predictions"], r["n_clipped"]) == (len(y), n_neg)
        assert r["pct_clipped"] == pytest.approx(round(100 * n_neg / len(y), 2))
        assert (r["mean_pred"], r["std_pred"]) == (pytest.approx(p.mean()), pytest.approx(p.std()))


def test_smape_edges(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 0.0)], "trip_count bigint, m double")
    assert metrics.model_metrics(df, ["m"]).first()["smape"] == 0.0
    df = spark.createDataFrame([(0, 5.0), (0, 0.0)], "trip_count bigint, m double")
    assert metrics.model_metrics(df, ["m"]).first()["smape"] == 200.0
    empty = metrics.model_metrics(df.limit(0), ["m"]).first()
    assert (empty["smape"], empty["n_predictions"], empty["pct_clipped"]) == (0.0, 0, 0.0)


def test_deltas_skip_zero_baselines(spark):
    df = spark.createDataFrame([("x", 2.0), ("y", 4.0), ("z", 0.0)], "model string, mae double")
    got = {r["baseline"]: r["delta_pct"] for r in metrics.model_deltas(df, "x").collect()}
    assert got == {"y": -50.0}


def test_hardest_zones(preds, rows):
    err = {}
    for r in rows:
        err.setdefault(r[0], []).append(abs(r[4] - r[6]))
    want = sorted(err, key=lambda z: (-np.mean(err[z]), z))[:5]
    got = E.hardest_zones(E.zone_totals(preds, ["a", "b"]), "b").collect()
    assert [r["zone_id"] for r in got] == want
    assert got[0]["mae"] == pytest.approx(np.mean(err[want[0]])) and got[0]["zone_name"] == f"Z{want[0]}"


def test_segments_by_formula(preds, rows):
    means = {}
    for r in rows:
        means.setdefault(r[0], []).append(r[4])
    means = {z: np.mean(v) for z, v in means.items()}
    ordered = sorted(means.values())
    low, high = ordered[round((len(ordered) - 1) * 0.1)], ordered[round((len(ordered) - 1) * 0.9)]
    inside = {
        "sparse_zones": lambda r: means[r[0]] < low,
        "dense_zones": lambda r: means[r[0]] > high,
        "late_night": lambda r: r[2] <= 5,
        "peak_hours": lambda r: r[2] in (7, 8, 9, 17, 18, 19),
        "weekend": lambda r: r[3] == 1,
        "weekday": lambda r: r[3] == 0,
        "zero_demand": lambda r: r[4] == 0,
    }
    totals = E.zone_totals(preds, ["a", "b"]).cache()
    got = {r["segment"]: r for r in E.segment_mae(totals, ["a", "b"]).collect()}
    want = {k: [r for r in rows if f(r)] for k, f in inside.items()}
    assert set(got) == {k for k, v in want.items() if v}
    for k, r in got.items():
        assert r["n_rows"] == len(want[k])
        assert r["a_mae"] == pytest.approx(np.mean([abs(x[4] - x[5]) for x in want[k]]))
        assert r["b_mae"] == pytest.approx(np.mean([abs(x[4] - x[6]) for x in want[k]]))
    deltas = {r["segment"]: r["delta_pct"] for r in E.segment_deltas(E.segment_mae(totals, ["a", "b"]), "b", "a").collect()}
    assert deltas["weekend"] == pytest.approx((got["weekend"]["b_mae"] - got["weekend"]["a_mae"]) / got["weekend"]["a_mae"] * 100)


def test_empty_segments_are_left_out(preds):
    weekday = preds.where("is_weekend = 0 AND trip_count > 0 AND hour_of_day = 12")
    got = {r["segment"] for r in E.segment_mae(E.zone_totals(weekday, ["a"]), ["a"]).collect()}
    assert got & {"weekend", "late_night", "peak_hours", "zero_demand"} == set() and "weekday" in got


def test_slot_means_and_fallback(spark):
    train = spark.createDataFrame(
        [(1, 8, 0, 4), (1, 8, 0, 6), (1, 9, 0, 2), (2, 8, 0, 8)], "zone_id bigint, hour_of_day bigint, day_of_week bigint, trip_count bigint"
    )
    ask = spark.createDataFrame([(1, 8, 0), (2, 8, 0), (9, 8, 0)], "zone_id bigint, hour_of_day bigint, day_of_week bigint")
    slots = B.fit_slot_means(train)
    got = {r["zone_id"]: r["slot_mean"] for r in B.predict_slot_means(ask, slots).collect()}
    assert got == {1: 5.0, 2: 8.0, 9: 5.0}
    empty = B.predict_slot_means(ask, B.fit_slot_means(train.limit(0)))
    assert {r["slot_mean"] for r in empty.collect()} == {0.0}


def test_slots_in_a_small_file_are_not_broadcast(spark, tmp_path):
    """A file's size says little about its rows: 168,000 slots with one mean take some 20 KB."""
    slots = spark.range(168_000).selectExpr(
        "id DIV 168 AS zone_id", "id % 24 AS hour_of_day", "id DIV 24 % 7 AS day_of_week", "2L AS slot_total", "1L AS slot_rows", "2D AS slot_mean"
    )
    slots.write.parquet(str(tmp_path / "slots"))
    stored = spark.read.parquet(str(tmp_path / "slots"))
    ask = stored.select(*B.SLOT_KEYS)
    out = B.predict_slot_means(ask, stored)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("slot_mean = 2").count() == 168_000


def test_naive_is_last_week(spark):
    df = spark.createDataFrame([(7.0,)], "lag_168h double")
    assert B.predict_seasonal_naive(df).first()["seasonal_naive"] == 7.0


def test_sparse_zone_warning(spark):
    start = datetime(2024, 1, 1)
    rows = [(z, start + timedelta(hours=h), z * 10) for z in range(1, 21) for h in range(3)]
    means = checks.zone_means(spark.createDataFrame(rows, "zone_id bigint, hour_ts timestamp_ntz, trip_count bigint"))
    got = checks.sparse_zones(means).collect()
    # Positional rule: sorted[int(20 * 10 / 100)] is the third smallest mean.
    assert {(r["zone_id"], r["threshold"]) for r in got} == {(1, 30.0), (2, 30.0)}
    assert checks.sparse_zones(means.where("zone_id = 5")).isEmpty()


def test_extreme_predictions(spark):
    hist = spark.createDataFrame([(1, 10), (1, 4), (2, 0)], "zone_id bigint, trip_count bigint")
    preds = spark.createDataFrame([(1, 50.0), (1, 50.1), (2, 99.0), (3, 99.0)], "zone_id bigint, predicted_count double")
    got = [(r["zone_id"], r["predicted_count"], r["max_seen"]) for r in checks.extreme_predictions(preds, hist).collect()]
    assert got == [(1, 50.1, 10)]


def test_long_report(preds):
    totals = E.zone_totals(preds, ["a"]).cache()
    report = E.long_report(metrics.model_metrics(preds, ["a"]), E.segment_mae(totals, ["a"]), E.hardest_zones(totals, "a"))
    assert {r["section"] for r in report.collect()} == {"model_comparison", "segments", "hardest_zones"}
    value = report.where((F.col("metric") == "n_predictions") & (F.col("key") == "a")).first()["value"]
    assert value == 23 * 48 and not math.isnan(value)
