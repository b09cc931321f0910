"""Shape of physical plans, and the prepare job."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from zonecast.config import preset
from zonecast.functions.skew import key_counts, spread_join
from zonecast.operators.contracts import ContractError
from zonecast.operators.checks import extreme_predictions
from zonecast.operators.features import serve_features
from zonecast.plans import catalog as C
from zonecast.plans.prepare import prepare
from zonecast.session import clear_stages, materialize, path_exists, scratch_root
from zonecast.sources import register_source

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_trip_filter_and_columns_reach_the_scan(spark):
    text = plan(C.hourly(spark, SF))
    for pushed in ("IsNotNull(user_id)", "GreaterThanOrEqual(user_id,1)", "GreaterThanOrEqual(value,0.0)", "LessThan(ts,2024-01-31T00:00)"):
        assert pushed in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double,props:string>" in text


@needs_tables
def test_features_scan_once_and_shuffle_twice(spark):
    text = plan(C.feature_rows(spark, SF))
    assert text.count("events.parquet") == 1
    assert text.count("Exchange hashpartitioning") == 2
    # Partial aggregation before the first shuffle; windows share the second.
    assert "partial_count(1)" in text and text.count("hashpartitioning(zone_id") == 2


@needs_tables
def test_no_windows_over_all_rows(spark):
    """Windows without keys may run over hours or models, never over rows."""
    for name in ("lag_rolling_features", "sparse_zones", "segment_mae", "request_rate", "rate_limit_replay", "ks_sample"):
        text = plan(C.QUERIES[name](spark, SF))
        assert "Exchange SinglePartition" not in text or "Window" not in text.split("Exchange SinglePartition")[0]


def test_stages_land_in_the_shared_folder(spark, history):
    stored = materialize(history, "probe")
    assert stored.count() == 6552
    (path, *_) = stored.inputFiles()
    assert scratch_root(spark).removeprefix("file:") in path
    assert "PushedFilters: [IsNotNull(zone_id), EqualTo(zone_id,1)]" in plan(stored.where("zone_id = 1"))


def test_stages_can_be_cleared(spark, history):
    stored = materialize(history.limit(5), "probe")
    (path, *_) = stored.inputFiles()
    assert path_exists(spark, path)
    assert clear_stages(spark) >= 1 and not path_exists(spark, path)
    assert clear_stages(spark) == 0


def test_prepare_stores_checked_tables(spark, history, tmp_path):
    register_source("taxi_fixture")(lambda spark_, root, cfg: history)
    cfg = preset("taxi").with_(name="taxi_fixture")
    paths = prepare(spark, "", str(tmp_path / "ok"), cfg)
    assert spark.read.parquet(paths["features"]).count() == 3 * 1440
    assert sorted(r["zone_id"] for r in spark.read.parquet(paths["universe"]).collect()) == [1, 2, 3]
    first = spark.read.parquet(paths["features"]).agg(F.min("hour_ts")).first()[0]
    assert first == datetime(2024, 1, 1)

    audit = {r["step"]: r["rows"] for r in spark.read.parquet(paths["audit"]).collect()}
    assert audit == {"grid": history.count()}

    register_source("taxi_none")(lambda spark_, root, cfg: history.where("false"))
    with pytest.raises(ValueError, match="filtered out"):
        prepare(spark, "", str(tmp_path / "none"), cfg.with_(name="taxi_none"))

    register_source("taxi_broken")(lambda spark_, root, cfg: history.withColumn("trip_count", -F.col("trip_count") - 1))
    with pytest.raises(ContractError):
        prepare(spark, "", str(tmp_path / "bad"), cfg.with_(name="taxi_broken"))
    assert not os.path.exists(tmp_path / "bad/history")


@pytest.fixture
def no_coalescing(spark):
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_requests(spark):
    """60,000 requests: a third for one zone and hour, the others spread over 600 hours."""
    hot = F.col("id") % 3 == 0
    other = F.lit(datetime(2024, 2, 1)) + F.make_dt_interval(hours=(F.col("id") % 600).cast("int"))
    return spark.range(0, 60000, 1, 8).select(
        F.col("id").alias("request_id"),
        F.when(hot, 2).otherwise(1 + F.col("id") % 3).cast("bigint").alias("zone_id"),
        F.when(hot, F.lit(datetime(2024, 2, 20, 14))).otherwise(other).cast("timestamp_ntz").alias("hour_ts"),
    )


def largest_partition(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("bulk", [False, True])
def test_hot_requests_are_spread_and_whole(spark, history, cfg, no_coalescing, bulk):
    out = serve_features(hot_requests(spark), history, cfg, bulk=bulk)
    assert largest_partition(out) < 12000
    got = {r["request_id"]: r for r in out.collect()}
    assert len(got) == 60000 and all(r["reason"] is None for r in got.values())
    assert {got[i]["lag_1h"] for i in range(0, 60000, 3)} == {27.0}


def test_spread_join_equals_a_plain_join(spark, no_coalescing):
    left = spark.range(0, 20000, 1, 6).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 1999 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 900)).alias("a"),
        (F.col("id") % 3 != 0).cast("int").alias("b"),
    )
    values = key_counts(left, ["a", "b"]).withColumns({"v": F.md5(F.coalesce("a", F.lit("null"))), "w": F.col("n") * 2})
    right = values.where("a IS NULL OR a <> 'k7'")
    out = spread_join(left, right, ["a", "b"])
    plain = left.alias("l").join(right.alias("r"), F.expr("l.a <=> r.a AND l.b <=> r.b"), "left").select("l.id", "l.a", "l.b", "r.v", "r.w")
    assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()
    assert largest_partition(out) < 4000


def test_hot_zone_in_extreme_predictions(spark, history, no_coalescing):
    preds = hot_requests(spark).select("request_id", "zone_id", (F.col("request_id") * 1.0).alias("predicted_count"))
    peaks = {r[0]: r[1] for r in history.groupBy("zone_id").agg(F.max("trip_count")).collect()}
    got = {r["request_id"] for r in extreme_predictions(preds, history).collect()}
    assert got == {r["request_id"] for r in preds.collect() if r["predicted_count"] > 5 * peaks[r["zone_id"]]}


def test_a_cluster_without_a_shared_folder_is_refused():
    from zonecast.session import is_local

    assert is_local("local") and is_local("local[4]") and not is_local("local-cluster[2,1,512]") and not is_local("spark://x:7077")


def test_spread_join_with_equal_rows_and_a_map(spark, no_coalescing):
    rows = spark.range(0, 6000, 1, 8).select(F.lit(1).cast("bigint").alias("k"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    right = materialize(key_counts(rows, ["k"]).withColumn("v", F.lit("x")), "right")
    out = spread_join(rows, right, ["k"])
    assert out.where("v = 'x'").count() == 6000 and largest_partition(out) < 3000


def test_spread_join_broadcasts_hot_keys_only(spark, tmp_path):
    """Cells of few distinct values make a small file, which is not a small table."""
    spark.range(50_000).selectExpr("id AS k", "1L AS n", "'cell' AS name").write.parquet(str(tmp_path / "cells"))
    left = spark.range(50_000).withColumnRenamed("id", "k")
    out = spread_join(left, spark.read.parquet(str(tmp_path / "cells")), ["k"])
    assert out._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") <= 1
    assert out.where("name = 'cell'").count() == 50_000
