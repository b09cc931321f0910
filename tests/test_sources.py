import csv
import io
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from zonecast.config import load_config, preset
from zonecast.functions import textfns, timefns
from zonecast.operators.history import Audit
from zonecast.plans.prepare import prepare
from zonecast.sources import bikes, read_history, register_source, source, taxi

TFL_HEADER = [
    "Number", "Start date", "Start station number", "Start station", "End date", "End station number", "End station",
    "Bike number", "Bike model", "Total duration", "Total duration (ms)",
]
CITI_HEADER = [
    "ride_id", "rideable_type", "started_at", "ended_at", "start_station_name", "start_station_id", "end_station_name",
    "end_station_id", "start_lat", "start_lng", "end_lat", "end_lng", "member_casual",
]


def write_csv(path, header, rows, quoting=csv.QUOTE_ALL):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh, quoting=quoting)
        w.writerow(header)
        w.writerows(rows)


def tfl_row(start, station, name="Park, North"):
    return ["1", start, station, name, start, "9", "End", "5", "CLASSIC", "5m", "300000"]


def citi_row(started, station, name="Broadway & W 58 St", ride="r1"):
    return [ride, "classic_bike", started, started, name, station, "E", "1.01", "40", "-73", "40", "-73", "member"]


def as_text(header, rows):
    out = io.StringIO()
    w = csv.writer(out)
    w.writerow(header)
    w.writerows(rows)
    return out.getvalue()


def busy(history):
    return {(r["zone_id"], r["hour_ts"]): r["trip_count"] for r in history.where("trip_count > 0").collect()}


@pytest.fixture
def tfl_dir(tmp_path):
    rows = [
        tfl_row("2024-01-05 10:05", "200"),
        tfl_row("2024-01-05 10:55:30", "200"),
        tfl_row("2024-01-05 11:00", "200"),
        tfl_row("2024-01-05 11:10", "201", ""),
        tfl_row("2024-01-05 11:59", "201", "Second"),
    ]
    names = bikes.tfl_files(preset("tfl").months)
    for n in names:
        write_csv(tmp_path / n, TFL_HEADER, rows if "387" in n else [tfl_row("2023-12-02 00:00", "200")] if "385" in n else [])
    return tmp_path


def test_tfl_end_to_end(spark, tfl_dir):
    cfg = preset("tfl")
    out = read_history(spark, str(tfl_dir), cfg)
    assert out.count() == 2 * 2184
    assert busy(out) == {
        (200, datetime(2023, 12, 2)): 1,
        (200, datetime(2024, 1, 5, 10)): 2,
        (200, datetime(2024, 1, 5, 11)): 1,
        (201, datetime(2024, 1, 5, 11)): 2,
    }
    names = {(r[0], r[1]) for r in out.select("zone_id", "zone_name").distinct().collect()}
    assert names == {(200, "Park, North"), (201, "Unknown Station")}
    assert out.where("avg_fare IS NOT NULL OR avg_distance IS NOT NULL").isEmpty()


def test_a_missing_extract_is_an_error(spark, tfl_dir):
    (tfl_dir / bikes.TFL_FILES["2024-02"][1]).unlink()
    with pytest.raises(FileNotFoundError, match="390Journey"):
        read_history(spark, str(tfl_dir), preset("tfl"))


def test_bad_dates_and_ids_raise(spark, tmp_path):
    for name, row in {"date": tfl_row("05/01/2024 10:00", "1"), "id": tfl_row("2024-01-05 10:00", "x1")}.items():
        write_csv(tmp_path / f"{name}.csv", TFL_HEADER, [row])
        with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|CAST_INVALID_INPUT"):
            bikes.read_tfl_trips(spark, [str(tmp_path / f"{name}.csv")]).collect()


def test_rows_without_station_are_dropped(spark, tmp_path):
    write_csv(tmp_path / "a.csv", TFL_HEADER, [tfl_row("2024-01-05 10:00", ""), tfl_row("2024-01-05 10:00", "4")], csv.QUOTE_MINIMAL)
    assert [r["zone_id"] for r in bikes.read_tfl_trips(spark, [str(tmp_path / "a.csv")]).collect()] == [4]


CITI_ROWS = [
    citi_row("2024-01-15 08:05:11", "4028.03"),
    citi_row("2024-01-15 08:45:00.123", "4028.03"),
    citi_row("2024-01-15 09:00:00", "3113.1", "A"),
    citi_row("2024-01-15 09:30:00", "3113.10", "A"),
    citi_row("2024-01-15 09:30:00", "AB123"),
    citi_row("2024-01-15 09:30:00", "SYS016"),
    citi_row("2024-01-15 09:30:00", ""),
    citi_row("2024-01-15 09:30:00", "12.345"),
]
CITI_BUSY = {
    (402803, datetime(2024, 1, 15, 8)): 2,
    (311310, datetime(2024, 1, 15, 9)): 2,
    (311310, datetime(2024, 2, 1)): 1,
    (311310, datetime(2024, 3, 31, 23)): 1,
}
LATER = {"202402": [citi_row("2024-02-01 00:00:00", "3113.1", "B")], "202403": [citi_row("2024-03-31 23:59:59", "3113.1")]}


def test_citibike_csv(spark, tmp_path):
    cfg = preset("citibike")
    write_csv(tmp_path / "202401-citibike-tripdata_1.csv", CITI_HEADER, CITI_ROWS[:3])
    write_csv(tmp_path / "202401-citibike-tripdata_2.csv", CITI_HEADER, CITI_ROWS[3:])
    for m, rows in LATER.items():
        write_csv(tmp_path / f"{m}-citibike-tripdata.csv", CITI_HEADER, rows)
    out = read_history(spark, str(tmp_path), cfg)
    assert busy(out) == CITI_BUSY and out.count() == 2 * 2184
    (tmp_path / "202402-citibike-tripdata.csv").unlink()
    with pytest.raises(FileNotFoundError, match="202402"):
        read_history(spark, str(tmp_path), cfg)


@pytest.mark.parametrize("usable", [True, False])
def test_audit_is_counted_by_the_write(spark, tmp_path, usable):
    cfg = preset("citibike")
    blank = [[*r] for r in CITI_ROWS]
    for r in blank:
        r[CITI_HEADER.index("start_station_id")] = ""
    for m in cfg.months:
        write_csv(tmp_path / f"{m.replace('-', '')}-citibike-tripdata.csv", CITI_HEADER, CITI_ROWS if usable else blank)
    audit = Audit("citibike")
    history = read_history(spark, str(tmp_path), cfg, audit)
    assert history._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    history.write.parquet(f"{tmp_path}/out")
    raw = spark.read.option("header", True).csv(f"{tmp_path}/*.csv")
    kept = raw.where(textfns.is_station_id("start_station_id")).count()
    if not usable:
        assert kept == 0 and audit.counts() == {"kept": 0, "grid": 0}
        with pytest.raises(ValueError, match="filtered out"):
            prepare(spark, str(tmp_path), f"{tmp_path}/prepared", cfg)
        return
    assert kept > 0 and audit.counts() == {
        "raw": raw.count(),
        "kept": kept,
        "dropped": raw.count() - kept,
        "grid": spark.read.parquet(f"{tmp_path}/out").count(),
    }
    assert audit.table(spark).count() == 4


def test_citibike_zip(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "202401-citibike-tripdata.zip", "w") as z:
        z.writestr("folder/202401-citibike-tripdata_1.csv", as_text(CITI_HEADER, CITI_ROWS[:3]))
        z.writestr("202401-citibike-tripdata_2.CSV", as_text(CITI_HEADER, CITI_ROWS[3:]))
        z.writestr("again/202401-citibike-tripdata_1.csv", as_text(CITI_HEADER, CITI_ROWS[:3]))
        z.writestr("empty.csv", "")
        z.writestr("notes.txt", "no table")
    for m, rows in LATER.items():
        with zipfile.ZipFile(tmp_path / f"{m}-citibike-tripdata.zip", "w") as z:
            z.writestr(f"{m}.csv", as_text(CITI_HEADER, rows))
    out = read_history(spark, str(tmp_path), preset("citibike").with_(name="citibike_zip"))
    assert busy(out) == CITI_BUSY


def test_line_breaks_inside_zip_fields(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("a.csv", as_text(CITI_HEADER, [citi_row("2024-01-15 08:05:11", "1.25", 'Two\nlines, "quoted"')]))
    (row,) = bikes.read_member_zip(spark, [str(tmp_path / "a.zip")]).collect()
    assert row["start_station_name"] == 'Two\nlines, "quoted"' and row["start_station_id"] == "1.25"


def test_dropped_rows_are_counted(spark, tmp_path):
    write_csv(tmp_path / "a.csv", CITI_HEADER, CITI_ROWS)
    audit = Observation("rows")
    trips = bikes.citibike_trips(bikes.read_member_csv(spark, [str(tmp_path / "a.csv")]), audit)
    trips.write.format("noop").mode("overwrite").save()
    assert audit.get == {"total": 8, "dropped": 4}


def test_a_source_without_usable_rows_is_an_error(spark, tmp_path):
    for m in ("202401", "202402", "202403"):
        write_csv(tmp_path / f"{m}-citibike-tripdata.csv", CITI_HEADER, CITI_ROWS[4:])
    with pytest.raises(ValueError, match="filtered"):
        read_history(spark, str(tmp_path), preset("citibike"))


def test_taxi_end_to_end(spark, tmp_path):
    cfg = preset("taxi")
    schema = (
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID int, total_amount double, "
        "trip_distance double, extra string"
    )
    for m in cfg.months:
        t = datetime.fromisoformat(f"{m}-10T08:30:00")
        rows = [(t, t, 4, 12.5, 1.5, "x"), (t, t, 4, 7.5, 2.5, "x"), (t, t, 264, 1.0, 1.0, "x"), (t, None, 4, 1.0, 1.0, "x")]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"yellow_tripdata_{m}.parquet"))
    write_csv(tmp_path / "zones.csv", ["LocationID", "Borough", "Zone"], [["4", "M", "Alphabet City"], ["5", "S", "Arden"]])
    out = read_history(spark, str(tmp_path), cfg)
    assert busy(out) == {(4, datetime.fromisoformat(f"{m}-10T08:00:00")): 2 for m in cfg.months}
    (row,) = out.where("trip_count > 0 AND month(hour_ts) = 1").collect()
    assert (row["avg_fare"], row["avg_distance"], row["zone_name"]) == (10.0, 2.0, "Alphabet City")
    globbed = taxi.read_trips(spark, str(tmp_path / "yellow_tripdata_*.parquet"))
    assert globbed.count() == 12


def test_registry():
    with pytest.raises(ValueError, match="unknown source"):
        source("nowhere")
    register_source("here")(lambda spark, root, cfg: None)
    assert source("here")(None, "", None) is None


def test_config_file_overrides(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(
        '{"dataset": {"adapter": "citibike"}, "data": {"months": ["2024-05", "2024-06"], "raw_dir": "r"},'
        ' "features": {"lag_hours": [1], "rolling_windows": [12]}, "models": {"gbt": {"n_estimators": 7}},'
        ' "split": {"train_start": "2024-05-08T00:00:00", "train_end": "2024-06-01T00:00:00",'
        ' "val_end": "2024-06-15T00:00:00", "test_end": "2024-07-01T00:00:00"},'
        ' "monitoring": {"quality": {"min_matched_pairs": 3}, "drift": {"maxlen": 50}}}'
    )
    c = load_config(str(path))
    assert (c.name, c.start, c.end) == ("citibike", datetime(2024, 5, 1), datetime(2024, 7, 1))
    assert (c.lags, c.rolling_windows, c.rounds, c.min_matched_pairs, c.drift_max_samples) == ((1,), (12,), 7, 3, 50)
    assert c.split.val_end == datetime(2024, 6, 15) and c.paths["raw_dir"] == "r"
    assert (preset("taxi").end, preset("citibike").end) == (datetime(2024, 3, 1), datetime(2024, 4, 1))
    path.write_text('{"models": {"lightgbm": {"n_estimators": 9, "random_state": 5}}}')
    assert (load_config(str(path)).rounds, load_config(str(path)).seed) == (9, 5)
    with pytest.raises(ValueError):
        preset("boats")


def test_text_and_time_columns(spark):
    ids = spark.createDataFrame([("4028.03",), ("3113.1",), ("3113.10\n",), ("12",), (None,)], "s string")
    got = [tuple(r) for r in ids.select(textfns.is_station_id("s"), F.when(textfns.is_station_id("s"), textfns.station_number("s"))).collect()]
    assert got == [(True, 402803), (True, 311310), (False, None), (False, None), (False, None)]
    row = spark.range(1).select(
        timefns.parse_seconds(F.lit("2024-02-29 23:59:59.999")).alias("s"),
        timefns.parse_minutes(F.lit("2024-02-29 23:59:59")).alias("m"),
        timefns.hour_floor(F.lit(datetime(2024, 2, 29, 23, 59)).cast("timestamp_ntz")).alias("h"),
        textfns.pseudonym(F.lit("key")).alias("p"),
    ).first()
    assert row["s"] == datetime(2024, 2, 29, 23, 59, 59) and row["m"] == datetime(2024, 2, 29, 23, 59)
    assert row["h"] == datetime(2024, 2, 29, 23)
    assert row["p"] == "2c70e12b7a0646f92279f427c7b38e7334d8e5389cff167a1dc30e73f826b683"


def test_files_with_another_column_order_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("started_at,start_station_name,start_station_id\n2024-01-01 00:00:01,North,11.5\n")
    (tmp_path / "b.csv").write_text("start_station_id,started_at,start_station_name\n22.25,2024-01-01 00:00:02,South\n")
    rows = bikes.read_member_csv(spark, [f"{tmp_path}/*.csv"]).collect()
    assert {(r["start_station_name"], r["start_station_id"]) for r in rows} == {("North", "11.5"), ("South", "22.25")}


def test_a_row_of_another_width_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("started_at,start_station_name,start_station_id\n2024-01-01 00:00:01,North\n")
    with pytest.raises(Exception, match="[Mm]alformed|MALFORMED"):
        bikes.read_member_csv(spark, [f"{tmp_path}/a.csv"]).collect()


def test_a_month_without_known_files_raises():
    with pytest.raises(FileNotFoundError, match="2024-03"):
        bikes.tfl_files(("2024-02", "2024-03"))


def test_members_of_equal_name_and_companion_files(spark, tmp_path):
    import zipfile

    head = "started_at,start_station_name,start_station_id\n"
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("one/trips.csv", head + "2024-01-01 00:00:01,North,11.5\n")
        z.writestr("two/trips.csv", head + "2024-01-01 00:00:02,South,22.25\n")
        z.writestr("__MACOSX/one/._trips.csv", "no table")
    assert bikes.read_member_zip(spark, [f"{tmp_path}/x.zip"]).count() == 2
