"""Order statistics, histograms and samples against NumPy and plain Python."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.functions import ordered as O
from zonecast.functions.sampling import bottom_k, latest_n

RNG = np.random.default_rng(7)
SETS = {
    "normal": RNG.normal(0, 50, 4001),
    "ties": RNG.integers(0, 4, 3000).astype(float),
    "one_hot": np.r_[np.full(2000, 5.0), RNG.uniform(0, 10, 1000)],
    "constant": np.full(50, 3.0),
    "tiny": np.array([2.0]),
    "negative": -RNG.lognormal(0, 3, 1500),
    "close": 1e9 + np.arange(2500, dtype=float),
    "binary": RNG.integers(0, 2, 999).astype(float),
}


@pytest.fixture(scope="module")
def long(spark):
    rows = [(k, float(v)) for k, vs in SETS.items() for v in vs]
    return spark.createDataFrame(rows, "feature string, value double").repartition(6).cache()


@pytest.fixture(scope="module")
def dist(long):
    return long.groupBy("feature", "value").agg(F.count("*").alias("n")).cache()


def test_bucket_keeps_order(spark):
    values = sorted({*SETS["normal"], *SETS["negative"], 0.0, 1.0, 2.0, np.nextafter(2, 0), np.nextafter(8, 0), 8.0, 1e-300, -1e-300, 1e300})
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    got = [r["b"] for r in df.select("i", O.monotone_bucket(F.col("v")).alias("b")).orderBy("i").collect()]
    assert got == sorted(got)


def test_edges_equal_numpy_percentiles(dist):
    got = {r["feature"]: r["edges"] for r in O.linear_edges(dist, 10).collect()}
    assert set(got) == set(SETS)
    for k, vs in SETS.items():
        np.testing.assert_allclose(got[k], np.percentile(vs, np.linspace(0, 100, 11)), rtol=1e-12, atol=1e-12)


def test_counts_equal_numpy_histogram(dist):
    edges = O.linear_edges(dist, 10)
    got = {r["feature"]: (r["edges"], r["counts"]) for r in O.bin_counts(dist, edges, 10).collect()}
    for k, vs in SETS.items():
        e, counts = got[k]
        assert counts == np.histogram(vs, bins=e)[0].tolist(), k
        assert sum(counts) == len(vs)


def test_values_outside_the_edges_are_dropped(spark):
    dist = spark.createDataFrame([("f", v, 1) for v in (-1.0, 0.0, 1.0, 2.0, 3.0)], "feature string, value double, n bigint")
    edges = spark.createDataFrame([("f", [0.0, 1.0, 2.0])], "feature string, edges array<double>")
    assert O.bin_counts(dist, edges, 2).first()["counts"] == [1, 2]


@pytest.mark.parametrize("rank_of,pick", [
    (O.nearest_rank(0.1), lambda n: int(round((n - 1) * 0.1))),
    (O.nearest_rank(0.9), lambda n: int(round((n - 1) * 0.9))),
    (O.floor_rank(10), lambda n: min(int(n * 10 / 100), n - 1)),
])
def test_picked_ranks(dist, rank_of, pick):
    got = {r["feature"]: r["value"] for r in O.order_statistics(dist, lambda n: F.array(rank_of(n))).collect()}
    for k, vs in SETS.items():
        assert got[k] == sorted(vs)[pick(len(vs))], k


def test_nulls_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (None,), (1.0,)], "x double")
    assert [tuple(r) for r in O.single(df, "x").collect()] == [("x", 1.0, 2)]


@pytest.mark.parametrize("k", [1, 40, 10_000])
def test_bottom_k_is_exact(long, k):
    keyed = long.withColumn("digest", F.md5(F.concat_ws("|", "feature", F.monotonically_increasing_id().cast("string")))).cache()
    want = {}
    for r in keyed.collect():
        want.setdefault(r["feature"], []).append(r["digest"])
    got = {}
    for r in bottom_k(keyed, k).collect():
        got.setdefault(r["feature"], []).append(r["digest"])
    assert {f: sorted(d) for f, d in got.items()} == {f: sorted(d)[:k] for f, d in want.items()}


@pytest.mark.parametrize("k", [1, 40, 10_000])
@pytest.mark.parametrize("part", ["digest > '8'", "feature = 'ties'", "false"])
def test_bottom_k_is_exact_whatever_is_probed(long, k, part):
    odd = long.sparkSession.createDataFrame([("same", 1.0, "0" * 32)] * 50 + [("none", 1.0, None), (None, 1.0, "a" * 32)], "feature string, value double, digest string")
    keyed = long.withColumn("digest", F.md5(F.concat_ws("|", "feature", F.monotonically_increasing_id().cast("string")))).unionByName(odd).cache()
    want = {}
    for r in keyed.where("digest IS NOT NULL AND feature IS NOT NULL").collect():
        want.setdefault(r["feature"], []).append(r["digest"])
    got = {}
    for r in bottom_k(keyed, k, probe=keyed.where(part)).collect():
        got.setdefault(r["feature"], []).append(r["digest"])
    assert {f: sorted(d) for f, d in got.items()} == {f: sorted(d)[:k] for f, d in want.items()}


@pytest.mark.parametrize("n", [1, 100, 1000, 5000])
def test_latest_n_is_exact(spark, n):
    start = datetime(2024, 1, 1)
    # A third of all rows share one instant.
    rows = [(i, start + timedelta(minutes=7 * (i % 400)) if i % 3 else start + timedelta(hours=40)) for i in range(1200)]
    df = spark.createDataFrame(rows, "id bigint, ts timestamp_ntz").repartition(5)
    want = sorted(rows, key=lambda r: (r[1], r[0]), reverse=True)[:n]
    got = [(r["id"], r["ts"]) for r in latest_n(df, n, "ts", "id").collect()]
    assert sorted(got) == sorted(want)
