from datetime import datetime

import pytest
from pyspark.sql import functions as F

from zonecast.operators import contracts as C
from zonecast.operators.features import engineer_features


def broken(report):
    return {r["rule"]: r["violations"] for r in report.collect() if r["violations"]}


def test_good_tables_pass_with_coercion(history, cfg):
    narrow = history.withColumn("zone_id", F.col("zone_id").cast("int")).withColumn("note", F.lit("x"))
    out = C.enforce(narrow, C.history_contract())
    assert dict(out.dtypes)["zone_id"] == "bigint" and "note" in out.columns
    C.enforce(engineer_features(history, cfg), C.feature_contract())


def test_every_violation_is_named(history):
    bad = history.limit(10).withColumns(
        {
            "zone_id": F.lit(0).cast("bigint"),
            "trip_count": F.lit(-1).cast("bigint"),
            "zone_name": F.lit(None).cast("string"),
        }
    )
    assert broken(C.contract_report(bad, C.history_contract())) == {
        "not_null_zone_name": 10,
        "min_zone_id": 10,
        "min_trip_count": 10,
    }
    with pytest.raises(C.ContractError, match="min_trip_count"):
        C.enforce(bad, C.history_contract())


def test_duplicate_keys_raise(history):
    twice = history.unionByName(history.where("zone_id = 1").limit(3))
    assert broken(C.contract_report(twice, C.history_contract())) == {"unique_zone_id_hour_ts": 3}
    with pytest.raises(C.ContractError, match="unique"):
        C.enforce(twice, C.history_contract())


def test_unfit_values_raise(spark):
    bad = spark.createDataFrame([("x", datetime(2024, 1, 1), 1.0)], "zone_id string, hour_ts timestamp_ntz, predicted_count double")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        C.enforce(bad, C.prediction_contract())


def test_feature_ranges(history, cfg):
    feats = engineer_features(history, cfg).limit(5)
    for column, value in {"hour_of_day": 24, "day_of_week": 7, "is_weekend": 2, "month": 0}.items():
        bad = feats.withColumn(column, F.lit(value).cast("bigint"))
        assert f"range_{column}" in broken(C.row_violations(bad, C.feature_contract()))
    nulls = feats.withColumn("lag_168h", F.lit(None).cast("double"))
    assert broken(C.row_violations(nulls, C.feature_contract())) == {"not_null_lag_168h": 5}


def test_predictions_must_not_be_negative(spark):
    rows = [(1, datetime(2024, 1, 1), -0.1), (1, datetime(2024, 1, 1), 0.0)]
    df = spark.createDataFrame(rows, "zone_id bigint, hour_ts timestamp_ntz, predicted_count double")
    assert broken(C.contract_report(df, C.prediction_contract())) == {"min_predicted_count": 1}
    found = C.violating_rows(df, C.prediction_contract()).collect()
    assert [r["broken_rules"] for r in found] == [["min_predicted_count"]]


def test_grid_checks(history, cfg):
    assert broken(C.grid_report(history, cfg.start, cfg.end, cfg.split.train_start)) == {}
    late = history.where(F.col("hour_ts") >= F.lit(cfg.split.train_start))
    assert broken(C.grid_report(late, cfg.start, cfg.end, cfg.split.train_start)) == {
        "no_hour_gaps": 3 * 744,
        "warmup_present": 1,
    }


def test_metric_gate(spark):
    rows = spark.createDataFrame([("a", 3.1, 1.0), ("b", 3.3, 0.0), ("c", 1.0, 5.0)], "model string, mae double, pct_clipped double")
    C.require_metric(rows, "a")
    for model in ("b", "c", "missing"):
        with pytest.raises(C.ContractError):
            C.require_metric(rows, model)
