from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.operators import drift
from zonecast.operators import moments as M

NAMES = ("a", "b", "c")


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(7)
    a = rng.normal(size=600)
    return np.column_stack([a, 2 * a + rng.normal(size=600), np.full(600, 0.1)])


def table(spark, values, parts=5):
    rows = [(datetime(2024, 1, 1) + timedelta(hours=i), *map(float, v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "hour_ts timestamp_ntz, a double, b double, c double").repartition(parts)


def matrix(df):
    cells = {(r["f1"], r["f2"]): r["corr"] for r in df.collect()}
    return np.array([[cells[x, y] for y in NAMES] for x in NAMES])


def wanted(values):
    out = np.zeros((3, 3))
    out[:2, :2] = np.corrcoef(values[:, :2], rowvar=False)
    return out


def test_combine_equals_numpy_for_any_parts(values):
    left, right = M._pairs(3)
    day = np.arange(600) % 7
    rows = (day, np.ones(600, np.int64), values, np.zeros((600, 6)))
    halves = [M._combine(*(p[s] for p in rows), left, right) for s in (slice(0, 11), slice(11, 600))]
    merged = M._combine(*(np.concatenate(p) for p in zip(*halves)), left, right)
    for d, n, mean, co in zip(*merged):
        x = values[day == d]
        assert n == len(x)
        np.testing.assert_allclose(mean, x.mean(axis=0), atol=1e-12)
        want = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
        np.testing.assert_allclose(co, want[left, right], atol=1e-9)
        assert co[5] == 0.0  # the constant column, exactly


@pytest.mark.parametrize("offset", [0.0, 1e9])
def test_large_offsets_and_constants(spark, values, offset):
    df = table(spark, values + offset)
    np.testing.assert_allclose(matrix(drift.correlation_matrix(df, NAMES)), wanted(values), atol=1e-6)


def test_merged_days_are_the_whole(spark, values, tmp_path):
    df = table(spark, values)
    M.daily_moments(df, NAMES).write.parquet(f"{tmp_path}/m")
    daily = spark.read.parquet(f"{tmp_path}/m")
    assert daily.count() == 25 and daily.agg(F.sum("n")).first()[0] == 600
    whole = matrix(M.correlations(M.merge_moments(daily, NAMES), NAMES))
    np.testing.assert_allclose(whole, matrix(drift.correlation_matrix(df, NAMES)), atol=1e-12)
    week = daily.where(F.col("day").between(F.lit(date(2024, 1, 3)), F.lit(date(2024, 1, 9))))
    part = matrix(M.correlations(M.merge_moments(week, NAMES), NAMES))
    np.testing.assert_allclose(part, wanted(values[48:216]), atol=1e-9)


def test_rows_without_a_value_or_time_are_left_out(spark, values):
    df = table(spark, values)
    holes = df.select("hour_ts", F.when(F.hour("hour_ts") == 3, None).otherwise(F.col("a")).alias("a"), F.when(F.hour("hour_ts") == 4, float("nan")).otherwise(F.col("b")).alias("b"), "c")
    kept = [i for i in range(600) if i % 24 not in (3, 4)]
    np.testing.assert_allclose(matrix(drift.correlation_matrix(holes, NAMES)), wanted(values[kept]), atol=1e-9)
    timeless = holes.withColumn("hour_ts", F.when(F.hour("hour_ts") != 5, F.col("hour_ts")))
    assert M.daily_moments(timeless, NAMES).agg(F.sum("n")).first()[0] == 600 - 3 * 25


def test_empty_table(spark, values):
    none = table(spark, values).where("false")
    assert M.daily_moments(none, NAMES).count() == 0
    assert (matrix(drift.correlation_matrix(none, NAMES)) == 0).all()


def test_one_scan(spark, values, tmp_path):
    table(spark, values).write.parquet(f"{tmp_path}/t")
    plan = drift.correlation_matrix(spark.read.parquet(f"{tmp_path}/t"), NAMES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Subquery" not in plan
