"""Example queries: every operator over the test tables.

``events`` stand in for trips (user = zone, value = fare, ``props.k`` = distance) and for
requests; ``customer`` is the zone lookup.  All queries read whole tables.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.config import CONTINUOUS, FEATURES, TARGET, DatasetConfig, Split
from zonecast.functions import textfns, timefns
from zonecast.operators import (
    admission,
    baselines,
    checks,
    contracts,
    drift,
    evaluation,
    features,
    history,
    metrics,
    moments,
    quality,
    scoring,
    splits,
    training,
    usage,
)
from zonecast.plans import learn, marts, monitor
from zonecast.session import materialize, partitions_for, stage_path, use_utc
from zonecast.sources import bikes, sinks, taxi
from zonecast.streaming import jobs, revisions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CONFIG = DatasetConfig(
    name="events",
    start=datetime(2024, 1, 1),
    end=datetime(2024, 1, 31),
    split=Split.of("2024-01-08", "2024-01-20", "2024-01-25", "2024-01-31"),
)
AS_OF = datetime(2024, 1, 31)
BASELINES = ("slot_mean", "seasonal_naive")
RATE_LIMIT = 3
RATE_SECONDS = 3600


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(use_utc(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# Shared inputs ---------------------------------------------------------------


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def k_of(props: str = "props"):
    return F.get_json_object(props, "$.k")


def raw_trips(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").alias("zone_id"),
        "ts",
        F.col("value").alias("fare"),
        k_of().cast("double").alias("distance"),
        "event_type",
    )


def trips(spark, sf):
    return history.valid_trips(raw_trips(spark, sf), CONFIG.start, CONFIG.end)


def named_trips(spark, sf):
    return trips(spark, sf).withColumn("zone_name", F.col("event_type"))


def lookup(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("zone_id"), F.col("c_name").alias("zone_name")
    )


def hourly(spark, sf):
    return history.hourly_demand(trips(spark, sf))


def dense(spark, sf):
    return history.densify(hourly(spark, sf), CONFIG.start, CONFIG.end)


def full_history(spark, sf):
    return history.attach_names(dense(spark, sf), lookup(spark, sf), CONFIG.unknown_label)


def feature_rows(spark, sf):
    return features.engineer_features(full_history(spark, sf), CONFIG)


def stored_features(spark, sf):
    """Model columns and zone name, stored because several branches read them."""
    rows = feature_rows(spark, sf).select("zone_name", "hour_ts", TARGET, *FEATURES)
    return materialize(rows, "features")


def split_rows(spark, sf):
    return splits.split_from_config(stored_features(spark, sf), CONFIG)


def both_baselines(train: DataFrame, test: DataFrame) -> DataFrame:
    slots = materialize(baselines.fit_slot_means(train), "slots")
    return baselines.predict_seasonal_naive(baselines.predict_slot_means(test, slots))


def predicted(spark, sf):
    """Both baselines on the test split."""
    train, _, test = split_rows(spark, sf)
    return both_baselines(train, test)


def requests(spark, sf):
    """Every event as a request; ``view`` events stay off the hour."""
    hour = F.when(F.col("event_type") == "view", F.col("ts")).otherwise(timefns.hour_floor("ts"))
    return table(spark, sf, "events").select(
        F.col("event_id").alias("request_id"), F.col("user_id").alias("zone_id"), hour.alias("hour_ts")
    )


def usage_events(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("client"),
        F.col("event_type").alias("endpoint"),
        "ts",
        k_of().cast("bigint").alias("records"),
    )


def request_log(spark, sf):
    """Requests with status, latency (``k`` hundredths of a second) and predicted value."""
    failed = F.col("event_type") == "error"
    return table(spark, sf, "events").select(
        F.col("event_id").alias("request_id"),
        F.col("event_type").alias("client"),
        F.col("event_type").alias("endpoint"),
        "ts",
        F.when(failed, F.lit("500")).when(F.col("user_id") == 0, F.lit("422")).otherwise(F.lit("200")).alias("status"),
        F.when(F.col("user_id") == 0, F.lit("unsupported_zone")).alias("reason"),
        (k_of().cast("double") / 100).alias("latency_s"),
        F.when(~failed, F.col("value")).alias("predicted"),
    )


def _prediction_id(model: str | Column):
    return textfns.row_digest("zone_id", "hour_ts", F.lit(model))


def prediction_log(preds: DataFrame) -> DataFrame:
    """Both baselines as logged predictions; the naive one is an hour newer."""
    return with_ids(predictions_made(preds))


def predictions_made(preds: DataFrame) -> DataFrame:
    """The rows of the prediction log before they get their ids."""
    rows = F.array(
        *[
            F.struct(F.lit(m).alias("model"), F.col(m).alias("predicted_value"), (F.col("hour_ts") - timefns.hours(age)).alias("created_at"))
            for m, age in (("slot_mean", 2), ("seasonal_naive", 1))
        ]
    )
    return preds.select("zone_id", "hour_ts", F.inline(rows))


def with_ids(made: DataFrame) -> DataFrame:
    return made.select("zone_id", "hour_ts", _prediction_id(F.col("model")).alias("prediction_id"), "predicted_value", "created_at")


def submitted_actuals(feats: DataFrame) -> DataFrame:
    """Late actuals from the validation start on: by id (twice, the second corrected) and by key."""
    return addressed(submissions(feats))


def submissions(feats: DataFrame) -> DataFrame:
    """Submitted actuals before they name a prediction or an hour."""
    rows = feats.where(F.col("hour_ts") >= timefns.ts_lit(CONFIG.split.train_end))
    value = F.col(TARGET).cast("double")
    sent = F.array(
        F.struct(F.lit(1).cast("bigint").alias("seq"), F.lit(True).alias("by_id"), (value + 1).alias("actual_value")),
        F.struct(F.lit(2).cast("bigint").alias("seq"), F.lit(True).alias("by_id"), value.alias("actual_value")),
        F.struct(F.lit(3).cast("bigint").alias("seq"), F.lit(False).alias("by_id"), value.alias("actual_value")),
    )
    return rows.select("zone_id", "hour_ts", F.inline(sent))


def addressed(sent: DataFrame) -> DataFrame:
    none = F.lit(None)
    return sent.select(
        "seq",
        F.when(F.col("by_id"), _prediction_id("slot_mean")).alias("prediction_id"),
        F.when(~F.col("by_id"), F.col("zone_id")).otherwise(none).alias("zone_id"),
        F.when(~F.col("by_id"), F.col("hour_ts")).otherwise(none).alias("hour_ts"),
        "actual_value",
    )


def log_and_actuals(spark, sf):
    feats = stored_features(spark, sf)
    train, _, test = splits.split_from_config(feats, CONFIG)
    preds = both_baselines(train, test)
    return materialize(prediction_log(preds), "prediction-log"), submitted_actuals(feats)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# History ---------------------------------------------------------------------


@query
def filter_trips(spark, sf):
    return trips(spark, sf).select(
        "event_id", "zone_id", timefns.hour_floor("ts").alias("hour_ts"), "fare", "distance"
    )


@query
def hourly_agg(spark, sf):
    return rounded(hourly(spark, sf), "avg_fare", "avg_distance")


@query
def zone_universe(spark, sf):
    return history.zone_universe(trips(spark, sf)).orderBy("zone_id")


@query
def first_zone_name(spark, sf):
    return history.first_zone_name(named_trips(spark, sf))


@query
def dense_history(spark, sf):
    return rounded(full_history(spark, sf), "avg_fare", "avg_distance")


@query
def named_history(spark, sf):
    """Counts only, with names from the trips themselves."""
    rows = named_trips(spark, sf).select("zone_id", "ts", "zone_name")
    return history.hourly_history(rows, CONFIG.start, CONFIG.end, None, "Unknown Station")


@query
def hour_gaps(spark, sf):
    return history.hour_gaps(hourly(spark, sf), CONFIG.start, CONFIG.end)


@query
def history_status(spark, sf):
    return history.history_status(full_history(spark, sf), CONFIG.split.train_start)


@query
def audit_counts(spark, sf):
    """Row counts before and after the trip filter, from one pass."""
    raw = raw_trips(spark, sf)
    kept = F.coalesce(history.is_valid_trip(CONFIG.start, CONFIG.end), F.lit(False))
    return raw.agg(F.count("*").alias("raw_rows"), F.count_if(kept).alias("kept_rows"))


# Features and splits ---------------------------------------------------------


@query
def calendar_features(spark, sf):
    return features.add_calendar(dense(spark, sf).select("zone_id", "hour_ts", TARGET))


@query
def lag_rolling_features(spark, sf):
    rows = feature_rows(spark, sf).select("zone_id", "hour_ts", TARGET, *[c for c in FEATURES if c != "zone_id"])
    return rounded(rows, "rolling_mean_24h")


def _served(spark, sf, bulk):
    out = features.serve_features(requests(spark, sf), materialize(full_history(spark, sf), "history"), CONFIG, bulk=bulk)
    cols = ["request_id", "zone_id", "hour_ts", "reason", *[c for c in FEATURES if c != "zone_id"]]
    return rounded(out.select(*cols), "rolling_mean_24h")


@query
def serve_features(spark, sf):
    return _served(spark, sf, bulk=False)


@query
def serve_features_bulk(spark, sf):
    return _served(spark, sf, bulk=True)


@query
def serve_stored(spark, sf):
    """Requests served from stored day blocks and zone facts alone; the history is not read again."""
    hist = materialize(full_history(spark, sf), "history")
    blocks = materialize(features.day_blocks(hist, CONFIG), "blocks")
    zones = materialize(features.zone_facts(hist), "zones")
    out = features.serve_features(requests(spark, sf), hist, CONFIG, zones=zones, blocks=blocks)
    cols = ["request_id", "zone_id", "hour_ts", "reason", *[c for c in FEATURES if c != "zone_id"]]
    return rounded(out.select(*cols), "rolling_mean_24h")


@query
def day_blocks(spark, sf):
    """Day blocks, one row per position: zone, day, days back, hour and count."""
    blocks = features.day_blocks(full_history(spark, sf), CONFIG)
    back = F.array(*[F.lit(d) for d in features.block_days(CONFIG)])
    rows = blocks.select("zone_id", "day", F.posexplode("slots").alias("pos", "trip_count"))
    hour = (F.col("pos") % features.HOURS).cast("bigint")
    days = F.get(back, F.floor(F.col("pos") / features.HOURS).cast("int")).cast("bigint")
    return rows.select("zone_id", F.col("day").cast("string").alias("day"), days.alias("days_back"), hour.alias("hour"), "trip_count")


@query
def strict_vs_serve_parity(spark, sf):
    """Batch features asked for again as requests: rows compared, and rows that differ."""
    hist = materialize(full_history(spark, sf), "history")
    strict = features.engineer_features(hist, CONFIG).select("zone_id", "hour_ts", *[c for c in FEATURES if c != "zone_id"])
    # Stored because they are counted and compared.
    strict = materialize(strict, "strict")
    asked = hist.where(F.col("hour_ts") >= timefns.ts_lit(CONFIG.split.train_start)).select("zone_id", "hour_ts")
    served = features.serve_features(asked, hist, CONFIG, bulk=True).select(*strict.columns)
    diff = history.grid_difference(strict, served, partitions_for(spark, 2 * strict.count()))
    return strict.agg(F.count(F.lit(1)).alias("rows_compared")).withColumn(
        "rows_different", diff.agg(F.count(F.lit(1)).alias("n")).scalar()
    )


@query
def split_counts(spark, sf):
    return splits.split_counts(feature_rows(spark, sf), CONFIG.split)


@query
def regression_fixture(spark, sf):
    _, _, test = split_rows(spark, sf)
    return rounded(sinks.regression_fixture(test), "rolling_mean_24h")


# Contracts -------------------------------------------------------------------


@query
def feature_contract(spark, sf):
    return contracts.contract_report(feature_rows(spark, sf), contracts.feature_contract())


@query
def history_contract(spark, sf):
    return contracts.contract_report(full_history(spark, sf), contracts.history_contract())


@query
def staged_contract(spark, sf):
    """Rules narrower than the data, over unfiltered trips, so that they find something."""
    staged = raw_trips(spark, sf).withColumn("hour_ts", timefns.hour_floor("ts"))
    c = CONFIG.split
    return contracts.contract_report(
        staged, contracts.staged_trip_contract(c.train_start, c.val_end, 1, 100)
    )


@query
def calendar_contract(spark, sf):
    rows = features.add_calendar(dense(spark, sf))
    return contracts.contract_report(rows, contracts.calendar_contract([1]))


@query
def prediction_contract(spark, sf):
    preds = predicted(spark, sf).withColumn("predicted_count", F.col("slot_mean"))
    return contracts.contract_report(preds, contracts.prediction_contract())


@query
def duplicate_keys(spark, sf):
    """Raw trips are not unique per zone and hour; the report lists the repeated keys."""
    rows = trips(spark, sf).select("zone_id", timefns.hour_floor("ts").alias("hour_ts"))
    return contracts.duplicate_keys(rows, ["zone_id", "hour_ts"])


@query
def violating_rows(spark, sf):
    staged = raw_trips(spark, sf).withColumn("hour_ts", timefns.hour_floor("ts"))
    c = CONFIG.split
    bad = contracts.violating_rows(staged, contracts.staged_trip_contract(c.train_start, c.val_end, 1, 100))
    return bad.select("event_id", F.concat_ws(",", "broken_rules").alias("broken_rules"))


@query
def grid_checks(spark, sf):
    """Gap and warm-up checks over the sparse hourly table."""
    return contracts.grid_report(hourly(spark, sf), CONFIG.start, CONFIG.end, CONFIG.split.train_start)


@query
def layered_marts(spark, sf):
    """The last layer of the stored tables."""
    _build_marts(spark, sf)
    return rounded(spark.table(marts.MART), "avg_fare", "avg_distance")


@query
def layered_checks(spark, sf):
    """Rule violations per layer (none)."""
    _build_marts(spark, sf)
    return marts.check_marts(spark, CONFIG.with_(months=("2024-01",)))


def _build_marts(spark, sf):
    marts.build_marts(spark, raw_trips(spark, sf), stage_path(spark, "marts"), CONFIG)


@query
def regression_gate(spark, sf):
    rows = metrics.model_metrics(predicted(spark, sf), BASELINES)
    return rows.select(
        "model",
        ((F.col("mae") < 3.20) & (F.col("pct_clipped") < 5.0)).alias("passed"),
    )


@query
def pipeline_parity(spark, sf):
    """Gap filling against a spine joined to the hourly table: differing rows (none)."""
    agg = hourly(spark, sf).select("zone_id", "hour_ts", TARGET)
    spine = agg.select("zone_id").distinct().select(
        "zone_id",
        F.explode(timefns.hour_spine(timefns.ts_lit(CONFIG.start), timefns.ts_lit(CONFIG.last_hour))).alias("hour_ts"),
    )
    joined = spine.join(agg, ["zone_id", "hour_ts"], "left").withColumn(TARGET, F.coalesce(TARGET, F.lit(0)))
    diff = history.grid_difference(dense(spark, sf).select("zone_id", "hour_ts", TARGET), joined)
    return diff.agg(F.count(F.lit(1)).alias("rows_different"))


# Baselines and evaluation ----------------------------------------------------


@query
def slot_mean_fit(spark, sf):
    train, _, _ = splits.split_from_config(feature_rows(spark, sf), CONFIG)
    return rounded(baselines.fit_slot_means(train), "slot_mean").withColumn("slot_total", F.col("slot_total").cast("bigint"))


@query
def slot_mean_predict(spark, sf):
    return rounded(predicted(spark, sf).select("zone_id", "hour_ts", "slot_mean"), "slot_mean")


@query
def seasonal_naive_predict(spark, sf):
    _, _, test = splits.split_from_config(feature_rows(spark, sf), CONFIG)
    return baselines.predict_seasonal_naive(test).select("zone_id", "hour_ts", "seasonal_naive")


@query
def model_comparison(spark, sf):
    rows = metrics.model_metrics(predicted(spark, sf), BASELINES)
    return rounded(rows, "mae", "rmse", "smape", "mean_pred", "std_pred")


@query
def model_deltas(spark, sf):
    rows = metrics.model_deltas(metrics.model_metrics(predicted(spark, sf), BASELINES), "seasonal_naive")
    return rounded(rows, "baseline_mae", "candidate_mae", "delta_pct")


@query
def hardest_zones(spark, sf):
    rows = evaluation.hardest_zones(evaluation.zone_totals(predicted(spark, sf), BASELINES), "slot_mean")
    return rounded(rows, "mae", "mean_demand")


def _totals(spark, sf):
    return materialize(evaluation.zone_totals(predicted(spark, sf), BASELINES), "zone-totals")


@query
def demand_quantiles(spark, sf):
    return rounded(evaluation.demand_quantiles(_totals(spark, sf)), "p_low", "p_high")


@query
def segment_mae(spark, sf):
    rows = evaluation.segment_mae(_totals(spark, sf), BASELINES)
    return rounded(rows, *[f"{m}_mae" for m in BASELINES])


@query
def segment_deltas(spark, sf):
    rows = evaluation.segment_mae(_totals(spark, sf), BASELINES)
    return rounded(
        evaluation.segment_deltas(rows, "seasonal_naive", "slot_mean").select("segment", "n_rows", "delta_pct"),
        "delta_pct",
    )


@query
def evaluation_report(spark, sf):
    preds = materialize(predicted(spark, sf), "predictions")
    totals = materialize(evaluation.zone_totals(preds, BASELINES), "zone-totals")
    report = evaluation.long_report(
        metrics.model_metrics(preds, BASELINES),
        evaluation.segment_mae(totals, BASELINES),
        evaluation.hardest_zones(totals, "slot_mean"),
    )
    return rounded(report, "value")


# Quality ---------------------------------------------------------------------


@query
def match_by_id(spark, sf):
    log, actuals = log_and_actuals(spark, sf)
    return quality.match_by_id(log, actuals).select("prediction_id", "submissions", "actual_value", "matched")


@query
def match_latest(spark, sf):
    log, actuals = log_and_actuals(spark, sf)
    return quality.match_latest(log, actuals).select("zone_id", "hour_ts", "prediction_id", "actual_value", "matched")


@query
def latest_prediction(spark, sf):
    log, _ = log_and_actuals(spark, sf)
    return quality.latest_predictions(log)


@query
def match_summary(spark, sf):
    return quality.match_summary(quality.match_actuals(*log_and_actuals(spark, sf)))


@query
def unmatched_actuals(spark, sf):
    rows = quality.unmatched(quality.match_actuals(*log_and_actuals(spark, sf)))
    return rows.select("warning", "submissions")


@query
def quality_window(spark, sf):
    return monitor.quality_report(*log_and_actuals(spark, sf), CONFIG, "3d", AS_OF)


@query
def quality_alert(spark, sf):
    """Quality below a threshold that the baselines miss, with the overall drift status attached."""
    _, status = _drift_tables(spark, sf)
    return monitor.quality_report(*log_and_actuals(spark, sf), CONFIG.with_(mae_threshold=0.01), "3d", AS_OF, status)


# Drift -----------------------------------------------------------------------


def _reference_and_buffer(spark, sf):
    train, _, test = split_rows(spark, sf)
    return train, materialize(drift.current_buffer(test, CONFIG.drift_max_samples, "hour_ts", "zone_id"), "drift-buffer")


@query
def latest_buffer(spark, sf):
    _, _, test = split_rows(spark, sf)
    return drift.current_buffer(test, CONFIG.drift_max_samples, "hour_ts", "zone_id").select("zone_id", "hour_ts", TARGET)


@query
def decile_bins(spark, sf):
    train, _, _ = split_rows(spark, sf)
    bins = drift.reference_bins(train)
    cells = bins.select("feature", F.posexplode("counts").alias("bin", "rows"), "edges")
    return rounded(
        cells.select(
            "feature",
            F.col("bin").cast("bigint").alias("bin"),
            F.element_at("edges", F.col("bin") + 1).alias("low"),
            F.element_at("edges", F.col("bin") + 2).alias("high"),
            "rows",
        ),
        "low",
        "high",
    )


@query
def ks_sample(spark, sf):
    train, _, _ = split_rows(spark, sf)
    return rounded(drift.reference_sample(train), "value")


@query
def psi(spark, sf):
    train, now = _reference_and_buffer(spark, sf)
    return rounded(drift.psi(materialize(drift.reference_bins(train), "bins"), now), "psi")


@query
def ks_stat(spark, sf):
    train, now = _reference_and_buffer(spark, sf)
    rows = drift.ks_test(drift.reference_sample(train), drift.long_values(now), exact=False)
    return rounded(rows.withColumns({c: F.col(c).cast("bigint") for c in ("n_ref", "n_cur")}), "ks_statistic", "ks_pvalue")


@query
def ks_exact(spark, sf):
    """P-values from counted lattice paths."""
    train, now = _reference_and_buffer(spark, sf)
    return rounded(drift.ks_test(drift.reference_sample(train), drift.long_values(now), exact=True), "ks_statistic", "ks_pvalue")


@query
def corr_matrix(spark, sf):
    train, _, _ = split_rows(spark, sf)
    return rounded(drift.correlation_matrix(train), "corr")


@query
def daily_moments(spark, sf):
    """Per day of the training split: rows, and mean and covariance of every pair of features."""
    train, _, _ = split_rows(spark, sf)
    pairs = moments.pair_moments(moments.daily_moments(train))
    cells = pairs.select(
        F.col("day").cast("string").alias("day"), "f1", "f2", "n", F.col("m1").alias("mean"), (F.col("s") / F.col("n")).alias("covariance")
    )
    # Eight digits: at six, values such as -0.0390625 are exact halves, and the last bit decides.
    return cells.withColumns({c: F.round(c, 8) for c in ("mean", "covariance")})


@query
def corr_recent(spark, sf):
    """Correlations of the training split's last week, merged from stored days."""
    train, _, _ = split_rows(spark, sf)
    daily = materialize(moments.daily_moments(train), "moments")
    last = daily.agg(F.date_sub(F.max("day"), 6).alias("d")).scalar()
    return rounded(moments.correlations(moments.merge_moments(daily.where(F.col("day") >= last))), "corr")


@query
def corr_shift(spark, sf):
    train, now = _reference_and_buffer(spark, sf)
    shift = drift.correlation_shift(drift.correlation_matrix(train), drift.correlation_matrix(now))
    return rounded(shift, "correlation_shift")


def _drift_tables(spark, sf):
    train, _, test = split_rows(spark, sf)
    return monitor.drift_tables(
        materialize(drift.reference_bins(train), "bins"),
        materialize(drift.reference_sample(train), "sample"),
        drift.correlation_matrix(train),
        test,
        CONFIG,
        "hour_ts",
        "zone_id",
        exact=False,
    )


@query
def drift_report(spark, sf):
    return _drift_tables(spark, sf)[0]


@query
def drift_status(spark, sf):
    return _drift_tables(spark, sf)[1]


# Checks ----------------------------------------------------------------------


@query
def sparse_zones(spark, sf):
    means = materialize(checks.zone_means(dense(spark, sf)), "zone-means")
    return rounded(checks.sparse_zones(means), "mean_demand", "threshold")


@query
def extreme_predictions(spark, sf):
    """Events' values as predictions against the zones' peak hours."""
    preds = trips(spark, sf).select("event_id", "zone_id", F.col("fare").alias("predicted_count"))
    return checks.extreme_predictions(preds, hourly(spark, sf))


# Usage and requests ----------------------------------------------------------


@query
def usage_daily(spark, sf):
    return usage.usage_daily(usage_events(spark, sf))


@query
def usage_report(spark, sf):
    return usage.usage_report(usage.usage_daily(usage_events(spark, sf)))


@query
def dedup_latest(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return usage.dedup_latest(rows, ["user_id"], ["ts", "event_id"])


@query
def request_counts(spark, sf):
    return usage.request_counts(request_log(spark, sf))


@query
def rejection_counts(spark, sf):
    return usage.rejection_counts(request_log(spark, sf))


@query
def error_count(spark, sf):
    return usage.error_count(request_log(spark, sf))


@query
def latency_histogram(spark, sf):
    return usage.latency_histogram(request_log(spark, sf)).withColumn("le", F.col("le").cast("string"))


@query
def prediction_histogram(spark, sf):
    return usage.prediction_histogram(request_log(spark, sf)).withColumn("le", F.col("le").cast("string"))


@query
def request_rate(spark, sf):
    rows = usage.request_rate(request_log(spark, sf).select("request_id", "client", "ts"), RATE_SECONDS)
    return rows.select("request_id", "client", "recent")


@query
def rate_limit_replay(spark, sf):
    log = request_log(spark, sf).select("request_id", "client", "ts")
    return admission.replay_admission(log, RATE_LIMIT, RATE_SECONDS).select("request_id", "client", "admitted")


@query
def client_pseudonym(spark, sf):
    keys = table(spark, sf, "events").select(textfns.pseudonym("user_id").alias("client_hash"))
    return keys.groupBy("client_hash").agg(F.count(F.lit(1)).alias("requests"))


# Text formats ----------------------------------------------------------------


def _station_text(spark, sf):
    """Values as station ids like ``12.3``; ``error`` events get a system id."""
    text = F.col("value").cast("string")
    return table(spark, sf, "events").select(
        "event_id",
        "ts",
        "event_type",
        F.when(F.col("event_type") == "error", F.concat(F.lit("SYS"), text)).otherwise(text).alias("station"),
    )


@query
def station_id_normalize(spark, sf):
    rows = _station_text(spark, sf)
    ok = textfns.is_station_id("station")
    return rows.select(
        "event_id", "station", ok.alias("usable"), F.when(ok, textfns.station_number("station")).alias("zone_id")
    )


@query
def parse_trip_text(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")
    return table(spark, sf, "events").select(
        "event_id",
        timefns.parse_minutes(text).alias("minute_ts"),
        timefns.parse_seconds(text).alias("second_ts"),
        timefns.hour_floor(timefns.parse_seconds(text)).alias("hour_ts"),
    )


def _member_rows(spark, sf):
    rows = _station_text(spark, sf)
    return rows.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("started_at"),
        F.concat(F.lit("Stop, "), F.col("event_type")).alias("start_station_name"),
        F.col("station").alias("start_station_id"),
    )


def _station_counts(trips_: DataFrame) -> DataFrame:
    return history.hourly_demand(trips_).select("zone_id", "hour_ts", TARGET)


@query
def csv_trips(spark, sf):
    """Events written as bike-share CSV files and read back through the CSV source."""
    path = stage_path(spark, "csv")
    _member_rows(spark, sf).write.option("header", True).option("quoteAll", True).csv(path)
    return _station_counts(bikes.citibike_trips(bikes.read_member_csv(spark, [path])))


@query
def tfl_csv_trips(spark, sf):
    """Events written as quoted extracts, errors with the columns the other way round, and read back by column name."""
    rows = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("Start station number"),
        F.concat(F.lit("Stop, "), F.col("event_type")).alias("Start station"),
        F.date_format("ts", "yyyy-MM-dd HH:mm").alias("Start date"),
        F.col("event_type").alias("kind"),
    )
    names, paths = list(bikes.TFL_COLUMNS), []
    for columns, own in ((names, rows.where("kind <> 'error'")), (names[::-1], rows.where("kind = 'error'"))):
        paths.append(stage_path(spark, "extracts"))
        own.select(*[f"`{c}`" for c in columns]).write.options(header=True, quoteAll=True).csv(paths[-1])
    return _station_counts(bikes.read_tfl_trips(spark, [f"{p}/*.csv" for p in paths]))


@query
def taxi_trips(spark, sf):
    """Events under the column names of taxi files, and their zones' names from a lookup CSV."""
    trips_path, zones_path = stage_path(spark, "taxi"), stage_path(spark, "zones")
    raw_trips(spark, sf).select(
        F.col("zone_id").alias("PULocationID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        F.col("ts").alias("tpep_dropoff_datetime"),
        F.col("fare").alias("total_amount"),
        F.col("distance").alias("trip_distance"),
    ).write.parquet(trips_path)
    zones = lookup(spark, sf).select(F.col("zone_name").alias("Zone"), F.col("zone_id").alias("LocationID"))
    zones.write.options(header=True, quoteAll=True).csv(zones_path)
    valid = history.valid_trips(taxi.read_trips(spark, trips_path), CONFIG.start, CONFIG.end)
    out = history.hourly_history(valid, CONFIG.start, CONFIG.end, taxi.read_zone_lookup(spark, zones_path), CONFIG.unknown_label)
    return rounded(out, "avg_fare", "avg_distance")


@query
def zip_trips(spark, sf):
    """Events packed into zip archives by Spark tasks and read through the archive source."""
    def pack(batches):
        for i, rows in enumerate(batches):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(f"part/{i}.CSV", rows.to_csv(index=False))
                archive.writestr("readme.txt", "not a table")
            yield pd.DataFrame({"content": [buffer.getvalue()]})

    archives = _member_rows(spark, sf).mapInPandas(pack, "content binary")
    return _station_counts(bikes.citibike_trips(bikes.unzip_members(archives)))


# Models ----------------------------------------------------------------------


#: Boosted trees by application and folder: three queries read one fit, which depends on nothing but the table.
_TREES: dict[tuple[str, str], training.Model] = {}


def _fitted(spark, sf, *names):
    feats = stored_features(spark, sf)
    train, val, test = splits.split_from_config(feats, CONFIG)
    models = {}
    for n in names:
        key = (spark.sparkContext.applicationId, sf)
        if n != "gbt":
            models[n] = training.create_model(n).fit(train, val)
        elif key in _TREES:
            models[n] = _TREES[key]
        else:
            models[n] = _TREES[key] = training.create_model(n, **training.gbt_params(CONFIG)).fit(train, val)
    return models, test


@query
def gbt_eval(spark, sf):
    """Errors of the trees, as configured, beside the slot mean; rounds grown until patience ran out, and rounds kept."""
    models, test = _fitted(spark, sf, "slot_mean", "gbt")
    rows = metrics.model_metrics(training.predict_all(models, test), list(models))
    counts = {k: F.when(F.col("model") == "gbt", F.lit(v)) for k, v in models["gbt"].rounds().items()}
    return rounded(rows.withColumns(counts), "mae", "rmse", "smape")


@query
def compare_objectives(spark, sf):
    models, test = _fitted(spark, sf, "gbt", "poisson")
    return learn.compare_objectives(test, models)


@query
def feature_importance(spark, sf):
    models, _ = _fitted(spark, sf, "gbt")
    return models["gbt"].importances(spark)


@query
def batch_score(spark, sf):
    """Every event scored as a request with the slot-mean model; rejected ones are flagged."""
    hist = materialize(full_history(spark, sf), "history")
    train, _, _ = splits.split_from_config(features.engineer_features(hist, CONFIG), CONFIG)
    model = training.create_model("slot_mean").fit(train)
    out = scoring.score_requests(requests(spark, sf), hist, model, CONFIG)
    return rounded(out, "predicted_count").select(
        "request_id", "zone_id", "zone_name", "hour_ts", "reason", "predicted_count", "model_name", "model_version"
    )


# Streaming -------------------------------------------------------------------


def _run_stream(spark, sf, build: Callable[[DataFrame], DataFrame], keys: list[str] | None = None) -> DataFrame:
    # A pattern, because a plain path would have to be a folder.
    events = spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/[e]vents.parquet")
    root = stage_path(spark, "stream")
    if keys:
        return jobs.run_latest(build(events), keys, f"{root}/out", f"{root}/checkpoint")
    return jobs.run_available(build(events), f"{root}/out", f"{root}/checkpoint")


@query
def stream_hourly(spark, sf):
    """Every hour as it stands after the last batch, open ones too."""

    def build(events):
        rows = events.select(
            F.col("user_id").alias("zone_id"), "ts", F.col("value").alias("fare"), k_of().cast("double").alias("distance")
        )
        return jobs.hourly_stream(history.valid_trips(rows, CONFIG.start, CONFIG.end))

    return rounded(_run_stream(spark, sf, build, ["zone_id", "hour_ts"]), "avg_fare", "avg_distance")


@query
def stream_usage(spark, sf):
    """Every day as it stands after the last batch, open ones too."""

    def build(events):
        return jobs.usage_stream(
            events.select(
                F.col("user_id").cast("string").alias("client"),
                F.col("event_type").alias("endpoint"),
                "ts",
                k_of().cast("bigint").alias("records"),
            )
        )

    return _run_stream(spark, sf, build, ["client", "endpoint", "date"])


def _stage_parts(df: DataFrame, name: str, **options) -> str:
    """Stores rows as a table a stream can follow."""
    path = stage_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return path


@query
def stream_log(spark, sf):
    """Scored requests streamed into the prediction log (ids are fresh on every run)."""
    hist = materialize(full_history(spark, sf), "history")
    train, _, _ = splits.split_from_config(features.engineer_features(hist, CONFIG), CONFIG)
    scored = scoring.score_requests(requests(spark, sf), hist, training.create_model("slot_mean").fit(train), CONFIG)
    source = _stage_parts(scored.select("zone_id", "hour_ts", "predicted_count"), "scored")
    root = stage_path(spark, "log")
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    jobs.prediction_log_stream(stream, f"{root}/out", f"{root}/checkpoint", AS_OF).awaitTermination()
    return rounded(spark.read.parquet(f"{root}/out"), "predicted_value").drop("prediction_id")


@query
def stream_quality(spark, sf):
    """Sliding quality of logged predictions against actuals observed an hour after the hour; open windows and late actuals too."""
    truth = history.densify(hourly(spark, sf), CONFIG.start, CONFIG.end)
    # Ids are made where the streams read: digests would be most of the stored bytes.
    tables = {
        "log": predicted(spark, sf).select("zone_id", "hour_ts", *BASELINES),
        "seen": truth.select("zone_id", "hour_ts", TARGET),
    }
    paths = {k: _stage_parts(v, k) for k, v in tables.items()}
    scored, counts = (spark.readStream.schema(tables[k].schema).parquet(paths[k]) for k in tables)
    log = prediction_log(scored).select("prediction_id", "predicted_value", "created_at")
    seen = counts.select(
        _prediction_id("slot_mean").alias("prediction_id"),
        F.col(TARGET).cast("double").alias("actual_value"),
        (F.col("hour_ts") + timefns.hours(1)).alias("observed_at"),
    )
    root = stage_path(spark, "quality")
    out = jobs.quality_latest(log, seen, f"{root}/pairs", f"{root}/checkpoint", "2 days", "1 day")
    return rounded(out, "mae", "rmse", "smape")


@query
def stream_quality_revised(spark, sf):
    """The prediction log and its actuals, wrong first submissions and hour-addressed ones too, in several files: pairs are revised as rows come."""
    feats = stored_features(spark, sf)
    train, _, test = splits.split_from_config(feats, CONFIG)
    # Ids are made where the streams read: digests would be most of the stored bytes.
    parts = {"log": predictions_made(both_baselines(train, test)), "seen": submissions(feats)}
    # Small row groups, because a file of millions of narrow rows would be one, hence one task.
    paths = {k: _stage_parts(v.repartition(3), k, **{"parquet.block.size": 1 << 20}) for k, v in parts.items()}
    made, sent = (spark.readStream.schema(parts[k].schema).option("maxFilesPerTrigger", 1).parquet(paths[k]) for k in parts)
    log = with_ids(made).select(*quality.LOG_COLUMNS)
    seen = addressed(sent).withColumn("observed_at", F.lit(AS_OF).cast(timefns.NTZ))
    root = stage_path(spark, "quality")
    out = revisions.revised_quality(log, seen, f"{root}/state", f"{root}/checkpoint", window="2 days")
    return rounded(out, "mae", "rmse", "smape")


@query
def usage_upserts(spark, sf):
    """Daily usage kept by upserts of a file stream, one of whose files is replayed at the end."""
    files = _stage_parts(usage_events(spark, sf).repartition(4), "usage")
    stream = spark.readStream.schema(spark.read.parquet(files).schema).option("maxFilesPerTrigger", 2).parquet(files)
    root = stage_path(spark, "usage")
    source = F.col("_metadata.file_name")
    revisions.usage_upserts(stream.withColumn("source", source), f"{root}/daily", f"{root}/checkpoint")
    again = spark.read.parquet(files).withColumn("source", source)
    revisions.merge_usage(again.where(F.col("source") == again.agg(F.min("source")).scalar()), f"{root}/daily")
    return revisions.stored_usage(spark, f"{root}/daily")


@query
def stream_admission(spark, sf):
    """The admission fold as a stream with state per client."""

    def build(events):
        rows = events.select(F.col("event_id").alias("request_id"), F.col("event_type").alias("client"), "ts")
        return jobs.admission_stream(rows, RATE_LIMIT, RATE_SECONDS)

    return _run_stream(spark, sf, build).select("request_id", "client", "admitted")


@query
def stream_drift(spark, sf):
    """Drift per micro-batch over the newest scored rows; the last batch's report."""
    train, _, test = split_rows(spark, sf)
    bins, sample = _reference(train)
    return _stream_drift(spark, test, lambda rows: drift.feature_drift(bins, sample, rows))


@query
def stream_drift_status(spark, sf):
    """The overall verdict of the last micro-batch: sample gate, worst feature and correlation shift."""
    train, _, test = split_rows(spark, sf)
    bins, sample = _reference(train)
    correlation = materialize(drift.correlation_matrix(train), "correlation")

    def evaluate(rows):
        shift = drift.correlation_shift(correlation, drift.correlation_matrix(rows))
        return drift.drift_status(drift.feature_drift(bins, sample, rows), shift, rows, CONFIG.drift_min_samples)

    return _stream_drift(spark, test, evaluate)


def _reference(train):
    return materialize(drift.reference_bins(train), "bins"), materialize(drift.reference_sample(train), "sample")


def _stream_drift(spark, test, evaluate):
    stream = spark.readStream.schema(test.schema).parquet(_stage_parts(test, "scored"))
    root = stage_path(spark, "drift")
    jobs.drift_stream(
        stream,
        evaluate,
        f"{root}/buffer",
        f"{root}/report",
        f"{root}/checkpoint",
        CONFIG.drift_max_samples,
        "hour_ts",
        "zone_id",
    ).awaitTermination()
    reports = spark.read.parquet(f"{root}/report")
    return reports.where(F.col("batch") == reports.agg(F.max("batch").alias("b")).scalar()).drop("batch")


FLAGSHIP = "lag_rolling_features"

__all__ = ["CONFIG", "CONTINUOUS", "FLAGSHIP", "QUERIES"]
