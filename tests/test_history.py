from datetime import datetime, timedelta

from pyspark.sql import functions as F

from zonecast.operators import history as H
from zonecast.session import ROWS_PER_TASK, partitions_for

START, END = datetime(2024, 1, 1), datetime(2024, 1, 2)
TRIPS = "zone_id bigint, ts timestamp_ntz, end_ts timestamp_ntz, fare double, distance double"


def trip(zone, ts, fare=10.0, distance=1.0, end=True):
    return (zone, ts, ts + timedelta(minutes=5) if end and ts else None, fare, distance)


def test_each_validity_rule_drops_its_row(spark):
    t = datetime(2024, 1, 1, 5)
    good = [trip(1, START), trip(263, END - timedelta(microseconds=1)), trip(5, t, 0.0, 0.0)]
    bad = [
        trip(0, t), trip(264, t), trip(None, t), trip(1, None), trip(1, t, end=False), trip(1, t, -0.01),
        trip(1, t, None), trip(1, t, 1.0, -1.0), trip(1, t, 1.0, None), trip(1, END), trip(1, START - timedelta(seconds=1)),
    ]
    kept = H.valid_trips(spark.createDataFrame(good + bad, TRIPS), START, END, 1, 263)
    assert sorted(r["zone_id"] for r in kept.collect()) == [1, 5, 263]


def test_hourly_means_and_counts(spark):
    rows = [trip(1, datetime(2024, 1, 1, 3, 59, 59), 10.0, 1.0), trip(1, datetime(2024, 1, 1, 3), 20.0, 3.0)]
    (row,) = H.hourly_demand(spark.createDataFrame(rows, TRIPS)).collect()
    assert (row["hour_ts"], row["trip_count"], row["avg_fare"], row["avg_distance"]) == (datetime(2024, 1, 1, 3), 2, 15.0, 2.0)


def test_dense_grid_is_complete_and_zero_filled(spark):
    rows = [trip(z, datetime(2024, 1, 1, h, 30)) for z, hs in {1: [0, 5, 23], 2: [7]}.items() for h in hs]
    dense = H.densify(H.hourly_demand(spark.createDataFrame(rows, TRIPS)), START, END).collect()
    assert len(dense) == 2 * 24 == len({(r["zone_id"], r["hour_ts"]) for r in dense})
    busy = {(r["zone_id"], r["hour_ts"].hour) for r in dense if r["trip_count"] == 1}
    assert busy == {(1, 0), (1, 5), (1, 23), (2, 7)}
    assert all((r["avg_fare"] is None) == (r["trip_count"] == 0) for r in dense)


def test_zones_seen_only_outside_the_calendar_get_a_zero_grid(spark):
    outside = [datetime(2023, 12, 31, 22), datetime(2024, 1, 2, 3)]
    cases = {1: outside[:1], 2: outside[1:], 3: outside, 4: [outside[0], datetime(2024, 1, 1, 12), outside[1]]}
    rows = [trip(z, t) for z, ts in cases.items() for t in ts]
    dense = H.densify(H.hourly_demand(spark.createDataFrame(rows, TRIPS)), START, END)
    per_zone = {r["zone_id"]: (r["n"], r["t"]) for r in dense.groupBy("zone_id").agg(F.count("*").alias("n"), F.sum("trip_count").alias("t")).collect()}
    assert per_zone == {1: (24, 0), 2: (24, 0), 3: (24, 0), 4: (24, 1)}


def test_two_names_in_one_hour_do_not_fan_out(spark):
    rows = [
        (7, "Old", datetime(2024, 1, 1, 4, 10)),
        (7, "New", datetime(2024, 1, 1, 4, 20)),
        (7, "New", datetime(2024, 1, 1, 9, 0)),
        (8, None, datetime(2024, 1, 1, 9, 0)),
    ]
    trips = spark.createDataFrame(rows, "zone_id bigint, zone_name string, ts timestamp_ntz")
    out = H.hourly_history(trips, START, END, None, "Unknown Station")
    assert out.columns == list(H.HISTORY_COLUMNS)
    rows = out.collect()
    assert len(rows) == 48
    assert {(r["zone_id"], r["zone_name"]) for r in rows} == {(7, "Old"), (8, "Unknown Station")}
    assert {r["trip_count"] for r in rows if r["zone_id"] == 7 and r["hour_ts"].hour == 4} == {2}
    assert {tuple(r) for r in H.first_zone_name(trips).collect()} == {(7, "Old"), (8, None)}


def test_named_trips_keep_weighted_means(spark):
    rows = [(1, "a", 10.0), (1, "a", 20.0), (1, "b", 60.0)]
    trips = spark.createDataFrame(rows, "zone_id bigint, zone_name string, fare double").withColumn(
        "ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    )
    (row,) = H.hourly_demand(trips).collect()
    assert (row["trip_count"], row["avg_fare"], row["avg_distance"], row["zone_name"]) == (3, 30.0, None, "a")


def test_missing_lookup_name_gets_the_label(spark):
    dense = H.densify(H.hourly_demand(spark.createDataFrame([trip(1, START), trip(2, START)], TRIPS)), START, END)
    lookup = spark.createDataFrame([(1, "Airport")], "zone_id bigint, zone_name string")
    names = {(r[0], r[1]) for r in H.attach_names(dense, lookup, "Unknown").select("zone_id", "zone_name").collect()}
    assert names == {(1, "Airport"), (2, "Unknown")}


def test_gap_finder_equals_expected_minus_present(spark, history, cfg):
    holes = {(1, cfg.start), (1, cfg.start + timedelta(hours=1)), (2, cfg.last_hour), (3, datetime(2024, 2, 29, 12))}
    cond = F.lit(False)
    for z, ts in holes:
        cond |= (F.col("zone_id") == z) & (F.col("hour_ts") == F.lit(ts))
    sparse = history.where(~cond)
    got = {(r[0], r[1]) for r in H.hour_gaps(sparse, cfg.start, cfg.end).collect()}
    assert got == holes
    assert H.hour_gaps(history, cfg.start, cfg.end).isEmpty()


def test_gaps_with_rows_outside_the_calendar(spark):
    rows = [(1, datetime(2023, 12, 31, 20)), (1, datetime(2024, 1, 1, 3)), (1, datetime(2024, 1, 3))]
    got = H.hour_gaps(spark.createDataFrame(rows, "zone_id bigint, hour_ts timestamp_ntz"), START, END)
    assert sorted(r["hour_ts"].hour for r in got.collect()) == [h for h in range(24) if h != 3]


def test_status(history, cfg):
    (row,) = H.history_status(history, cfg.split.train_start).collect()
    assert (row["history_rows"], row["n_zones"]) == (6552, 3)
    assert row["supported_start"] == datetime(2024, 1, 1) and row["supported_end"] == datetime(2024, 3, 1)


def test_audit_counts_come_with_the_job(history):
    df, obs = H.counted(history, "rows-in")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 6552


def test_grid_difference_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    assert {tuple(r) for r in H.grid_difference(a, b).collect()} == {(1, "left", 1), (2, "left", 1), (3, "right", 1)}


def test_grid_difference_groups_rows_only_where_they_meet(spark):
    a = spark.createDataFrame([(1, None), (1, None), (None, None), (2, 0.5)], "x int, y double")
    b = spark.createDataFrame([(None, 1), (0.5, 2), (None, 3)], "y double, x int")
    diff = H.grid_difference(a, b, 7)
    plan = diff._jdf.queryExecution().executedPlan().toString()  # before it runs
    assert {tuple(r) for r in diff.collect()} == {(1, None, "left", 1), (None, None, "left", 1), (3, None, "right", 1)}
    assert "hashpartitioning(x" in plan and ", 7)" in plan and plan.rindex("HashAggregate") < plan.index("Exchange")
    assert H.grid_difference(a.where("false"), b.where("false")).count() == 0


def test_partitions_grow_with_rows(spark):
    assert [partitions_for(spark, n) for n in (0, 4 * ROWS_PER_TASK, 4 * ROWS_PER_TASK + 1)] == [4, 4, 5]
