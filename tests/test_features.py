from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import demand
from zonecast.config import FEATURES
from zonecast.functions.skew import key_counts
from zonecast.operators import features as X
from zonecast.operators import splits as S

COLUMNS = [c for c in FEATURES if c != "zone_id"]


def served(df):
    return {r["request_id"]: r.asDict() for r in df.collect()}


def requests(spark, rows):
    return spark.createDataFrame(rows, "request_id string, zone_id bigint, hour_ts timestamp_ntz")


def test_values_by_formula(history, cfg):
    feats = X.engineer_features(history, cfg)
    rows = feats.where("zone_id = 2").orderBy("hour_ts").collect()
    assert feats.count() == 3 * 1440 and rows[0]["hour_ts"] == datetime(2024, 1, 1)
    for r in rows[:: 97]:
        t = r["hour_ts"]
        assert r["lag_1h"] == demand(2, t - timedelta(hours=1))
        assert r["lag_24h"] == demand(2, t - timedelta(hours=24))
        assert r["lag_168h"] == demand(2, t - timedelta(hours=168))
        assert r["rolling_mean_24h"] == sum(demand(2, t - timedelta(hours=k)) for k in range(1, 25)) / 24
        assert (r["hour_of_day"], r["day_of_week"], r["month"]) == (t.hour, t.weekday(), t.month)
        assert r["is_weekend"] == int(t.weekday() >= 5)
    assert {"zone_name", "avg_fare", "avg_distance"} <= set(feats.columns)
    assert not feats.where(F.col("hour_ts") == F.lit(datetime(2024, 2, 29, 23))).isEmpty()


def test_incomplete_windows_are_null(spark):
    rows = [(1, datetime(2024, 1, 1) + timedelta(hours=i), i) for i in range(30)]
    df = spark.createDataFrame(rows, "zone_id bigint, hour_ts timestamp_ntz, trip_count bigint")
    out = X.add_lags(df, (1, 24), (3, 24)).orderBy("hour_ts").collect()
    assert [r["rolling_mean_3h"] for r in out[:5]] == [None, None, None, 1.0, 2.0]
    assert out[23]["rolling_mean_24h"] is None and out[24]["rolling_mean_24h"] == 11.5
    assert out[0]["lag_1h"] is None and out[23]["lag_24h"] is None and out[24]["lag_24h"] == 0.0


def test_other_lags_and_windows(history, cfg):
    out = X.engineer_features(history, cfg.with_(lags=(2,), rolling_windows=(6, 12)))
    assert {"lag_2h", "rolling_mean_6h", "rolling_mean_12h"} <= set(out.columns)
    assert "lag_1h" not in out.columns


@pytest.mark.parametrize("bulk", [False, True])
def test_request_cases(spark, history, cfg, bulk):
    cases = [
        ("ok", 1, datetime(2024, 2, 20, 14)),
        ("zone", 99, datetime(2024, 2, 20, 14)),
        ("zone_first", 99, datetime(2030, 1, 1)),
        ("before", 1, datetime(2023, 12, 31, 23)),
        ("start", 1, datetime(2024, 1, 1)),
        ("last", 1, datetime(2024, 2, 29, 23)),
        ("end", 1, datetime(2024, 3, 1)),
        ("off_hour", 1, datetime(2024, 2, 20, 14, 30)),
        ("off_hour_last", 1, datetime(2024, 2, 29, 23, 59)),
    ]
    got = served(X.serve_features(requests(spark, cases), history, cfg, bulk=bulk))
    assert {k: r["reason"] for k, r in got.items()} == {
        "ok": None,
        "zone": "unsupported_zone",
        "zone_first": "unsupported_zone",
        "before": "unsupported_timestamp",
        "start": None,
        "last": None,
        "end": "unsupported_timestamp",
        "off_hour": None,
        "off_hour_last": None,
    }
    assert got["ok"]["lag_1h"] == 13 + 1 and got["ok"]["day_of_week"] == 1
    assert all(got["zone"][c] is None for c in COLUMNS)
    assert [got["off_hour"][c] for c in cfg.lag_columns + cfg.rolling_columns] == [0.0] * 4
    assert got["off_hour"]["hour_of_day"] == 14


@pytest.mark.parametrize("bulk", [False, True])
def test_same_features_as_batch(spark, history, cfg, bulk):
    strict = X.engineer_features(history, cfg).select("zone_id", "hour_ts", *COLUMNS)
    asked = strict.select("zone_id", "hour_ts")
    again = X.serve_features(asked, history, cfg, bulk=bulk).select(strict.columns)
    assert strict.exceptAll(again).isEmpty() and again.exceptAll(strict).isEmpty()


def test_holes_give_partial_means_both_ways(spark, history, cfg):
    t = datetime(2024, 2, 20, 14)
    drop = [t - timedelta(hours=k) for k in (1, 5, 6, 24)]
    holed = history.where(~((F.col("zone_id") == 1) & F.col("hour_ts").isin([F.lit(d) for d in drop])))
    asked = requests(spark, [("a", 1, t), ("b", 1, t + timedelta(hours=1)), ("c", 1, drop[0])])
    probe, bulk = (served(X.serve_features(asked, holed, cfg, bulk=b)) for b in (False, True))
    assert probe == bulk
    left = [demand(1, t - timedelta(hours=k)) for k in range(1, 25) if t - timedelta(hours=k) not in drop]
    assert probe["a"]["lag_1h"] == 0.0 and probe["a"]["rolling_mean_24h"] == sum(left) / len(left)


def test_blocks_of_other_lags_and_windows(spark, history, cfg):
    other = cfg.with_(lags=(1, 5, 24, 30, 49), rolling_windows=(6, 24, 36))
    assert X.block_days(other) == [3, 2, 1, 0] and X.block_days(cfg) == [7, 1, 0]
    t = datetime(2024, 2, 20, 14)
    holed = history.where(~((F.col("zone_id") == 2) & F.col("hour_ts").isin([F.lit(t - timedelta(hours=k)) for k in (2, 30, 31)])))
    asked = requests(spark, [(str(h), 2, t - timedelta(hours=h)) for h in range(60)])
    assert served(X.serve_features(asked, holed, other)) == served(X.serve_features(asked, holed, other, bulk=True))


def test_day_without_rows_still_has_a_block(spark, history, cfg):
    gone = datetime(2024, 2, 20)
    holed = history.where((F.col("zone_id") != 1) | (F.to_date("hour_ts") != F.lit(gone.date())))
    blocks = X.day_blocks(holed, cfg).where(f"zone_id = 1 AND day = '{gone.date()}'").collect()
    slots = blocks[0]["slots"]
    assert len(blocks) == 1 and len(slots) == 72 and slots[48:] == [None] * 24
    assert slots[24:48] == [demand(1, gone + timedelta(hours=h - 24)) for h in range(24)]
    assert slots[:24] == [demand(1, gone + timedelta(hours=h - 168)) for h in range(24)]
    got = served(X.serve_features(requests(spark, [("a", 1, gone + timedelta(hours=10))]), holed, cfg))["a"]
    left = [demand(1, gone - timedelta(hours=k)) for k in range(1, 15)]
    assert got["lag_1h"] == 0.0 and got["rolling_mean_24h"] == sum(left) / len(left)


def test_stored_tables_replace_the_history(spark, history, cfg, tmp_path):
    X.day_blocks(history, cfg).write.parquet(f"{tmp_path}/blocks")
    X.zone_facts(history).write.parquet(f"{tmp_path}/zones")
    blocks, zones = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("blocks", "zones"))
    asked = requests(spark, [("a", 1, datetime(2024, 2, 20, 14)), ("b", 99, datetime(2024, 2, 20, 14)), ("c", 2, datetime(2024, 3, 1)), ("d", None, None)])
    assert served(X.serve_features(asked, None, cfg, zones=zones, blocks=blocks)) == served(X.serve_features(asked, history, cfg))


def test_empty_requests_and_history(spark, history, cfg):
    none = requests(spark, [])
    assert X.serve_features(none, history, cfg).count() == 0
    got = served(X.serve_features(requests(spark, [("a", 1, datetime(2024, 2, 20, 14))]), history.where("false"), cfg))
    assert got["a"]["reason"] == "unsupported_zone" and got["a"]["lag_1h"] is None


def test_look_ups_join_once_without_copies_of_the_keys(spark, history, cfg):
    keys = history.select("zone_id", "hour_ts")
    blocks = spark.range(1).selectExpr("id AS zone_id", "date'2024-01-01' AS day", "array(1L) AS slots")
    plan = X._block_features(keys, blocks, cfg)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Generate" not in plan


def test_bulk_reads_the_cells_once(history, cfg):
    counts = key_counts(X.with_cells(history.select("zone_id", "hour_ts")), X.CELL_KEYS)
    cells = X.cell_features(counts, history, cfg, bulk=True, zones=history.select("zone_id", F.col("hour_ts").alias("last_hour")))
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    # The only join looks for known zones; features need none back to the cells, and no grouping of cells and history.
    assert plan.count("Join") == 1 and plan.count("count(1)") == 1


def test_bulk_takes_odd_rows_as_single_look_ups_do(spark, cfg):
    t = datetime(2024, 2, 20, 14)
    back = [(1, t - timedelta(hours=k), k) for k in range(1, 31)] + [(2, t - timedelta(hours=24), 5)]
    odd = [(1, t - timedelta(hours=1), 90), (1, t - timedelta(hours=1), 90), (1, t - timedelta(hours=2), None), (1, t - timedelta(hours=3), 1), (1, t, 7), (None, t, 9), (None, None, 9)]
    held = spark.createDataFrame([(z, f"Zone {z}", h, n) for z, h, n in back + odd], "zone_id bigint, zone_name string, hour_ts timestamp_ntz, trip_count bigint")
    asked = [("a", 1, t), ("twice", 1, t), ("half", 1, t + timedelta(minutes=30)), ("old", 1, t - timedelta(hours=29)), ("b", 2, t), ("zone", None, t), ("hour", 1, None), ("none", None, None), ("late", 1, t + timedelta(days=9))]
    single, bulk = (served(X.serve_features(requests(spark, asked), held, cfg, bulk=b)) for b in (False, True))
    assert single == bulk and len(bulk) == len(asked)
    # The larger of repeated counts, once: 90 for the hour before, 2 and 3 for the next, then 4 to 24.
    assert bulk["a"]["lag_1h"] == 90.0 and bulk["a"]["rolling_mean_24h"] == (90 + sum(range(2, 25))) / 24
    assert bulk["half"]["rolling_mean_24h"] == 0.0 and bulk["b"]["rolling_mean_24h"] == 5.0
    assert bulk["zone"]["reason"] == "unsupported_zone" and bulk["hour"]["lag_1h"] is None


def test_zoned_instants_become_utc(spark, history, cfg):
    asked = spark.createDataFrame([("a", 1)], "request_id string, zone_id bigint").withColumn(
        "hour_ts", F.to_timestamp(F.lit("2024-02-01T14:00:00+02:00"))
    )
    naive = requests(spark, [("a", 1, datetime(2024, 2, 1, 12))])
    assert served(X.serve_features(asked, history, cfg)) == served(X.serve_features(naive, history, cfg))


def test_hot_request_key_is_whole(spark, history, cfg):
    hot = spark.range(5000).select(
        F.col("id").cast("string").alias("request_id"),
        F.lit(2).cast("bigint").alias("zone_id"),
        F.lit("2024-02-20 14:00:00").cast("timestamp_ntz").alias("hour_ts"),
    )
    out = X.serve_features(hot, history, cfg)
    assert out.count() == 5000 and out.select("lag_1h").distinct().count() == 1


def test_splits_are_half_open_and_complete(history, cfg):
    feats = X.engineer_features(history, cfg).cache()
    parts = S.split_from_config(feats, cfg)
    assert [p.count() for p in parts] == [3 * 744, 3 * 336, 3 * 360]
    assert sum(p.count() for p in parts) == feats.count()
    iso = S.temporal_split(feats, "2024-01-01T00:00:00", datetime(2024, 2, 1), "2024-02-15", "2024-03-01")
    assert [p.count() for p in iso] == [p.count() for p in parts]
    counts = {r["split"]: r["n_rows"] for r in S.split_counts(feats, cfg.split).collect()}
    assert counts == {"train": 2232, "val": 1008, "test": 1080}
    edge = parts[1].agg(F.min("hour_ts")).first()[0]
    assert edge == datetime(2024, 2, 1)


def test_stored_column_order_is_checked():
    X.require_schema(list(FEATURES))
    with pytest.raises(ValueError, match="retrain"):
        X.require_schema(list(reversed(FEATURES)))
