"""The example queries as plain SQL, for an independent check on the same tables."""

from __future__ import annotations

from zonecast.config import CONTINUOUS, FEATURES

MEASURES = ", ".join(CONTINUOUS)

# Common table expressions, in dependency order.
_CTES = {
    "raw_trips": """
        SELECT event_id, user_id AS zone_id, ts, value AS fare,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS distance, event_type
        FROM events""",
    "trips": """
        SELECT *, date_trunc('hour', ts) AS hour_ts FROM raw_trips
        WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31'
          AND zone_id >= 1 AND fare >= 0 AND distance >= 0""",
    "hourly": """
        SELECT zone_id, hour_ts, count(*) AS trip_count, avg(fare) AS avg_fare, avg(distance) AS avg_distance
        FROM trips GROUP BY zone_id, hour_ts""",
    "spine": """
        SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR))
               AS hour_ts""",
    "dense": """
        SELECT z.zone_id, s.hour_ts, coalesce(a.trip_count, 0) AS trip_count, a.avg_fare, a.avg_distance
        FROM (SELECT DISTINCT zone_id FROM hourly) z CROSS JOIN spine s
        LEFT JOIN hourly a ON a.zone_id = z.zone_id AND a.hour_ts = s.hour_ts""",
    "history": """
        SELECT d.zone_id, coalesce(c.c_name, 'Unknown') AS zone_name, d.hour_ts, d.trip_count, d.avg_fare,
               d.avg_distance
        FROM dense d LEFT JOIN customer c ON c.c_custkey = d.zone_id""",
    "windowed": """
        SELECT *, extract(hour FROM hour_ts) AS hour_of_day, isodow(hour_ts) - 1 AS day_of_week,
               CASE WHEN isodow(hour_ts) >= 6 THEN 1 ELSE 0 END AS is_weekend, extract(month FROM hour_ts) AS month,
               CAST(lag(trip_count, 1) OVER w AS DOUBLE) AS lag_1h,
               CAST(lag(trip_count, 24) OVER w AS DOUBLE) AS lag_24h,
               CAST(lag(trip_count, 168) OVER w AS DOUBLE) AS lag_168h,
               CASE WHEN count(*) OVER t = 24 THEN avg(trip_count) OVER t END AS rolling_mean_24h
        FROM history
        WINDOW w AS (PARTITION BY zone_id ORDER BY hour_ts),
               t AS (PARTITION BY zone_id ORDER BY hour_ts ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)""",
    "feats": """
        SELECT * FROM windowed
        WHERE hour_ts >= TIMESTAMP '2024-01-08' AND lag_1h IS NOT NULL AND lag_24h IS NOT NULL
          AND lag_168h IS NOT NULL AND rolling_mean_24h IS NOT NULL""",
    "train": "SELECT * FROM feats WHERE hour_ts >= TIMESTAMP '2024-01-08' AND hour_ts < TIMESTAMP '2024-01-20'",
    "test": "SELECT * FROM feats WHERE hour_ts >= TIMESTAMP '2024-01-25' AND hour_ts < TIMESTAMP '2024-01-31'",
    "slots": """
        SELECT zone_id, hour_of_day, day_of_week, count(*) AS slot_rows, CAST(sum(trip_count) AS BIGINT) AS slot_total,
               CAST(sum(trip_count) AS DOUBLE) / count(*) AS slot_mean
        FROM train GROUP BY zone_id, hour_of_day, day_of_week""",
    "preds": """
        SELECT t.*, coalesce(s.slot_mean, (SELECT coalesce(avg(trip_count), 0) FROM train)) AS slot_mean,
               t.lag_168h AS seasonal_naive
        FROM test t LEFT JOIN slots s USING (zone_id, hour_of_day, day_of_week)""",
    "by_model": """
        SELECT 'slot_mean' AS model, CAST(trip_count AS DOUBLE) AS y, slot_mean AS p FROM preds
        UNION ALL
        SELECT 'seasonal_naive', CAST(trip_count AS DOUBLE), seasonal_naive FROM preds""",
    "metrics": """
        SELECT model, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
               coalesce(100 * avg(CASE WHEN abs(y) + abs(p) > 0 THEN 2 * abs(y - p) / (abs(y) + abs(p)) END), 0) AS smape,
               count(p) AS n_predictions, count(*) FILTER (WHERE p < 0) AS n_clipped,
               avg(p) AS mean_pred, stddev_pop(p) AS std_pred,
               round(100.0 * count(*) FILTER (WHERE p < 0) / count(p), 2)::DOUBLE AS pct_clipped
        FROM by_model GROUP BY model""",
    "means": """
        SELECT zone_id, CAST(sum(trip_count) AS DOUBLE) / count(*) AS mean_demand FROM preds GROUP BY zone_id""",
    "ranked_means": """
        SELECT mean_demand, row_number() OVER (ORDER BY mean_demand) - 1 AS rn, count(*) OVER () AS n FROM means""",
    "quantiles": """
        SELECT max(mean_demand) FILTER (WHERE rn = CAST(round((n - 1) * CAST(0.1 AS DOUBLE)) AS BIGINT)) AS p_low,
               max(mean_demand) FILTER (WHERE rn = CAST(round((n - 1) * CAST(0.9 AS DOUBLE)) AS BIGINT)) AS p_high
        FROM ranked_means""",
    "segmented": """
        SELECT unnest(list_filter([
                 CASE WHEN m.mean_demand < (SELECT p_low FROM quantiles) THEN 'sparse_zones' END,
                 CASE WHEN m.mean_demand > (SELECT p_high FROM quantiles) THEN 'dense_zones' END,
                 CASE WHEN hour_of_day BETWEEN 0 AND 5 THEN 'late_night' END,
                 CASE WHEN hour_of_day IN (7, 8, 9, 17, 18, 19) THEN 'peak_hours' END,
                 CASE WHEN is_weekend = 1 THEN 'weekend' END,
                 CASE WHEN is_weekend = 0 THEN 'weekday' END,
                 CASE WHEN trip_count = 0 THEN 'zero_demand' END], lambda x: x IS NOT NULL)) AS segment,
               abs(trip_count - slot_mean) AS e1, abs(trip_count - seasonal_naive) AS e2
        FROM preds p JOIN means m USING (zone_id)""",
    "segments": """
        SELECT segment, count(*) AS n_rows, avg(e1) AS slot_mean_mae, avg(e2) AS seasonal_naive_mae
        FROM segmented GROUP BY segment""",
    "hardest": """
        SELECT zone_id, min(zone_name) AS zone_name, avg(abs(trip_count - slot_mean)) AS mae,
               CAST(sum(trip_count) AS DOUBLE) / count(*) AS mean_demand
        FROM preds GROUP BY zone_id ORDER BY mae DESC, zone_id LIMIT 5""",
    "plog": """
        SELECT md5(concat_ws('|', zone_id, hour_ts, 'slot_mean', '')) AS prediction_id, zone_id, hour_ts,
               slot_mean AS predicted_value, hour_ts - INTERVAL 2 HOUR AS created_at FROM preds
        UNION ALL
        SELECT md5(concat_ws('|', zone_id, hour_ts, 'seasonal_naive', '')), zone_id, hour_ts, seasonal_naive,
               hour_ts - INTERVAL 1 HOUR FROM preds""",
    "late": "SELECT zone_id, hour_ts, CAST(trip_count AS DOUBLE) AS v FROM feats WHERE hour_ts >= TIMESTAMP '2024-01-20'",
    "actuals": """
        SELECT 1 AS seq, md5(concat_ws('|', zone_id, hour_ts, 'slot_mean', '')) AS prediction_id,
               NULL::BIGINT AS zone_id, NULL::TIMESTAMP AS hour_ts, v + 1 AS actual_value FROM late
        UNION ALL
        SELECT 2, md5(concat_ws('|', zone_id, hour_ts, 'slot_mean', '')), NULL, NULL, v FROM late
        UNION ALL
        SELECT 3, NULL, zone_id, hour_ts, v FROM late""",
    "latest": """
        SELECT zone_id, hour_ts, prediction_id FROM plog
        QUALIFY row_number() OVER (PARTITION BY zone_id, hour_ts ORDER BY created_at DESC, prediction_id DESC) = 1""",
    "resolved": """
        SELECT a.seq, a.actual_value, a.prediction_id, a.zone_id, a.hour_ts, p.prediction_id AS target
        FROM actuals a LEFT JOIN plog p ON p.prediction_id = a.prediction_id WHERE a.prediction_id IS NOT NULL
        UNION ALL
        SELECT a.seq, a.actual_value, a.prediction_id, a.zone_id, a.hour_ts, l.prediction_id
        FROM actuals a LEFT JOIN latest l ON l.zone_id = a.zone_id AND l.hour_ts = a.hour_ts
        WHERE a.prediction_id IS NULL""",
    "final_log": """
        SELECT p.*, f.actual_value FROM plog p LEFT JOIN (
            SELECT target, arg_max(actual_value, seq) AS actual_value FROM resolved WHERE target IS NOT NULL
            GROUP BY target) f ON f.target = p.prediction_id""",
    "buffer": "SELECT * FROM test ORDER BY hour_ts DESC, zone_id DESC LIMIT 1000",
    "train_long": "SELECT feature, value FROM (SELECT {cast} FROM train) UNPIVOT (value FOR feature IN ({names}))",
    "cur_long": "SELECT feature, value FROM (SELECT {cast} FROM buffer) UNPIVOT (value FOR feature IN ({names}))",
    "edge_lists": """
        SELECT feature, quantile_cont(value, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS edges
        FROM train_long GROUP BY feature""",
    "cells": """
        SELECT feature, b - 1 AS bin, edges[b] AS low, edges[b + 1] AS high
        FROM edge_lists CROSS JOIN (SELECT unnest(range(1, 11)) AS b)""",
    "ref_bins": """
        SELECT c.feature, c.bin, c.low, c.high,
               count(*) FILTER (WHERE t.value >= c.low AND (t.value < c.high OR (c.bin = 9 AND t.value <= c.high))) AS rows
        FROM cells c JOIN train_long t USING (feature) GROUP BY c.feature, c.bin, c.low, c.high""",
    "cur_bins": """
        SELECT c.feature, c.bin,
               count(*) FILTER (WHERE t.value >= c.low AND (t.value < c.high OR (c.bin = 9 AND t.value <= c.high))) AS rows
        FROM cells c JOIN cur_long t USING (feature) GROUP BY c.feature, c.bin""",
    "shares": """
        SELECT r.feature, (r.rows + 1e-6::DOUBLE) / (sum(r.rows) OVER w + 1e-5::DOUBLE) AS r,
               (c.rows + 1e-6::DOUBLE) / (sum(c.rows) OVER w + 1e-5::DOUBLE) AS c
        FROM ref_bins r JOIN cur_bins c ON c.feature = r.feature AND c.bin = r.bin
        WINDOW w AS (PARTITION BY r.feature)""",
    "psi": "SELECT feature, sum((c - r) * ln(c / r)) AS psi FROM shares GROUP BY feature",
    "sample": """
        SELECT feature, value, digest FROM (
            SELECT u.feature, u.value, md5(concat_ws('|', u.z, u.h, u.feature, '42')) AS digest
            FROM (SELECT zone_id AS z, hour_ts AS h, {cast} FROM train) UNPIVOT (value FOR feature IN ({names})) u)
        QUALIFY row_number() OVER (PARTITION BY feature ORDER BY digest) <= 5000""",
    "ks_cum": """
        SELECT DISTINCT feature, value,
               count(*) FILTER (WHERE side = 1) OVER (PARTITION BY feature ORDER BY value) /
                   (count(*) FILTER (WHERE side = 1) OVER (PARTITION BY feature))::DOUBLE AS f1,
               count(*) FILTER (WHERE side = 2) OVER (PARTITION BY feature ORDER BY value) /
                   (count(*) FILTER (WHERE side = 2) OVER (PARTITION BY feature))::DOUBLE AS f2,
               count(*) FILTER (WHERE side = 1) OVER (PARTITION BY feature) AS n_ref,
               count(*) FILTER (WHERE side = 2) OVER (PARTITION BY feature) AS n_cur
        FROM (SELECT feature, value, 1 AS side FROM sample UNION ALL SELECT feature, value, 2 FROM cur_long)""",
    "ks": """
        SELECT feature, n_ref, n_cur, max(abs(f1 - f2)) AS d,
               max(abs(f1 - f2)) * sqrt(n_ref::DOUBLE * n_cur / (n_ref + n_cur)) AS lam
        FROM ks_cum GROUP BY feature, n_ref, n_cur""",
    "ks_p": """
        SELECT feature, n_ref, n_cur, d, CASE WHEN lam < 0.2 THEN 1.0::DOUBLE ELSE greatest(0.0, least(1.0,
                   2 * list_sum(list_transform(range(1, 101),
                       lambda k: pow(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam)))))::DOUBLE END AS p
        FROM ks""",
    "ref_corr": "{ref_corr}",
    "cur_corr": "{cur_corr}",
    "ok": """
        SELECT r.f1 AS f FROM ref_corr r JOIN cur_corr c ON c.f1 = r.f1 AND c.f2 = r.f2
        WHERE r.f1 = r.f2 AND r.corr <> 0 AND c.corr <> 0""",
    "shift": """
        SELECT CASE WHEN (SELECT count(*) FROM ok) < 2 THEN 0.0::DOUBLE
                    ELSE sqrt(sum(CASE WHEN r.f1 IN (SELECT f FROM ok) AND r.f2 IN (SELECT f FROM ok)
                                       THEN pow(c.corr - r.corr, 2) ELSE 0 END))
                         / greatest((SELECT count(*) * (count(*) - 1) / 2 FROM ok), 1) END AS correlation_shift,
               8 - (SELECT count(*) FROM ok) AS n_excluded
        FROM ref_corr r JOIN cur_corr c ON c.f1 = r.f1 AND c.f2 = r.f2""",
    "verdicts": """
        SELECT feature, round(psi, 6) AS psi, round(d, 6) AS ks_statistic, round(p, 6) AS ks_pvalue,
               CASE WHEN psi > 0.25 OR p < 0.05 THEN 'alert' WHEN psi > 0.1 THEN 'warning' ELSE 'ok' END AS verdict
        FROM psi JOIN ks_p USING (feature)""",
    "reqs": """
        SELECT event_id AS request_id, user_id AS zone_id,
               CASE WHEN event_type = 'view' THEN ts ELSE date_trunc('hour', ts) END AS hour_ts
        FROM events""",
    "flagged": """
        SELECT r.*, CASE WHEN r.zone_id NOT IN (SELECT zone_id FROM history) THEN 'unsupported_zone'
                         WHEN r.hour_ts < TIMESTAMP '2024-01-08'
                              OR r.hour_ts >= (SELECT max(hour_ts) + INTERVAL 1 HOUR FROM history)
                         THEN 'unsupported_timestamp' END AS reason
        FROM reqs r""",
    "served": """
        SELECT f.*, w.lag_1h AS w1, w.lag_24h AS w24, w.lag_168h AS w168, w.rolling_mean_24h AS wr
        FROM flagged f LEFT JOIN windowed w ON w.zone_id = f.zone_id AND w.hour_ts = f.hour_ts""",
    "rlog": """
        SELECT event_id AS request_id, event_type AS client, event_type AS endpoint, ts,
               CASE WHEN event_type = 'error' THEN '500' WHEN user_id = 0 THEN '422' ELSE '200' END AS status,
               CASE WHEN user_id = 0 THEN 'unsupported_zone' END AS reason,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS latency_s,
               CASE WHEN event_type <> 'error' THEN value END AS predicted
        FROM events""",
    "usage": """
        SELECT CAST(user_id AS VARCHAR) AS client, event_type AS endpoint, CAST(ts AS DATE) AS date,
               count(*) AS request_count,
               CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total_records
        FROM events GROUP BY ALL""",
    "stations": """
        SELECT event_id, ts, CASE WHEN event_type = 'error' THEN 'SYS' || CAST(value AS VARCHAR)
                                  ELSE CAST(value AS VARCHAR) END AS station
        FROM events""",
    "station_ids": """
        SELECT *, regexp_full_match(station, '[0-9]+\\.[0-9]{1,2}') AS usable,
               CASE WHEN regexp_full_match(station, '[0-9]+\\.[0-9]{1,2}')
                    THEN CAST(replace(regexp_replace(station, '\\.([0-9])$', '.\\10'), '.', '') AS BIGINT) END AS zone_id
        FROM stations""",
    "station_hours": """
        SELECT zone_id, date_trunc('hour', ts) AS hour_ts, count(*) AS trip_count FROM station_ids WHERE usable
        GROUP BY ALL""",
}


def _corr(source: str) -> str:
    """All pairs of one table's correlation matrix."""
    cells = []
    for a in CONTINUOUS:
        for b in CONTINUOUS:
            if a == b:
                corr = f"CASE WHEN var_pop({a}) > 0 THEN 1.0::DOUBLE ELSE 0.0 END"
            else:
                corr = (
                    f"CASE WHEN var_pop({a}) * var_pop({b}) > 0 THEN covar_pop({a}, {b}) / "
                    f"sqrt(var_pop({a}) * var_pop({b})) ELSE 0.0 END"
                )
            cells.append(f"SELECT '{a}' AS f1, '{b}' AS f2, {corr} AS corr FROM {source}")
    return "\nUNION ALL\n".join(cells)


_CAST = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)
_ORDER = list(_CTES)


def _cte(name: str) -> str:
    if name == "ref_corr":
        return _corr("train")
    if name == "cur_corr":
        return _corr("buffer")
    return _CTES[name].replace("{cast}", _CAST).replace("{names}", ", ".join(FEATURES))


def _daily_moments() -> str:
    """Covariances of all pairs and means, per day."""
    cells = [
        f"SELECT CAST(CAST(hour_ts AS DATE) AS VARCHAR) AS day, '{a}' AS f1, '{b}' AS f2, count(*) AS n, "
        f"round(avg({a}), 8) AS mean, round(covar_pop({a}, {b}), 8) AS covariance FROM train GROUP BY 1"
        for i, a in enumerate(CONTINUOUS)
        for b in CONTINUOUS[i:]
    ]
    return "\nUNION ALL\n".join(cells)


def _mentions(text: str, name: str) -> bool:
    flat = "".join(ch if ch.isalnum() or ch == "_" else " " for ch in text).split()
    return name in flat


def sql(select: str) -> str:
    """``select`` preceded by just the common table expressions it needs."""
    needed: list[str] = []
    texts = [select]
    for name in reversed(_ORDER):
        if any(_mentions(t, name) for t in texts):
            needed.append(name)
            texts.append(_cte(name))
    body = ",\n".join(f"{n} AS ({_cte(n)})" for n in reversed(needed))
    return f"WITH {body}\n{select}" if needed else select


def _rules(source: str, rules: dict[str, str], keys: str | None = None) -> str:
    parts = [f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {cond}) AS violations FROM {source}" for n, cond in rules.items()]
    if keys:
        parts.append(
            f"SELECT 'unique_{keys.replace(', ', '_')}', count(*) FROM "
            f"(SELECT 1 FROM {source} GROUP BY {keys} HAVING count(*) > 1)"
        )
    return "\nUNION ALL\n".join(parts)


def _not_null(*cols: str) -> dict[str, str]:
    return {f"not_null_{c}": f"{c} IS NULL" for c in cols}


_KEY_RULES = {"min_zone_id": "zone_id < 1", "min_trip_count": "trip_count < 0"}
_RANGES = {"hour_of_day": (0, 23), "day_of_week": (0, 6), "is_weekend": (0, 1), "month": (1, 12)}
_STAGED = {
    **{f"not_null_{c}": f"{c} IS NULL" for c in ("zone_id", "hour_ts", "fare", "distance")},
    "range_zone_id": "NOT zone_id BETWEEN 1 AND 100",
    "window_hour_ts": "hour_ts < TIMESTAMP '2024-01-08' OR hour_ts >= TIMESTAMP '2024-01-25'",
    "min_fare": "fare < 0",
    "min_distance": "distance < 0",
}
_STAGED_WIDE = {
    **{k: v for k, v in _STAGED.items() if k.startswith(("not_null", "min"))},
    "min_zone_id": "zone_id < 1",
    "window_hour_ts": "hour_ts < TIMESTAMP '2024-01-01' OR hour_ts >= TIMESTAMP '2024-01-31'",
}
_CALENDAR_RULES = _rules(
    "windowed",
    {
        **_not_null("day_of_week", "is_weekend", "month"),
        "accepted_day_of_week": "day_of_week NOT IN (0, 1, 2, 3, 4, 5, 6)",
        "accepted_is_weekend": "is_weekend NOT IN (0, 1)",
        "accepted_month": "month NOT IN (1)",
    },
)
_STAGED_SOURCE = "(SELECT *, date_trunc('hour', ts) AS hour_ts FROM raw_trips)"

_SERVED = f"""
    SELECT request_id, zone_id, hour_ts, reason,
           CASE WHEN reason IS NULL THEN extract(hour FROM hour_ts) END AS hour_of_day,
           CASE WHEN reason IS NULL THEN isodow(hour_ts) - 1 END AS day_of_week,
           CASE WHEN reason IS NULL THEN CAST(isodow(hour_ts) >= 6 AS BIGINT) END AS is_weekend,
           CASE WHEN reason IS NULL THEN extract(month FROM hour_ts) END AS month,
           CASE WHEN reason IS NULL THEN coalesce(w1, 0) END AS lag_1h,
           CASE WHEN reason IS NULL THEN coalesce(w24, 0) END AS lag_24h,
           CASE WHEN reason IS NULL THEN coalesce(w168, 0) END AS lag_168h,
           CASE WHEN reason IS NULL THEN round(coalesce(wr, 0), 6) END AS rolling_mean_24h
    FROM served"""

_HISTOGRAM = """
    SELECT {by} CASE WHEN e = 1e308 THEN 'Infinity' ELSE CAST(e AS VARCHAR) END AS le,
           count(*) FILTER (WHERE v <= e) AS observations
    FROM (SELECT {by} {value} AS v FROM rlog) CROSS JOIN (SELECT unnest({edges}::DOUBLE[]) AS e) GROUP BY {by} e"""

#: Windows of two days that start every day, of matched pairs.
_WINDOWS = """
    SELECT window_start, window_start + INTERVAL 2 DAY AS window_end, {columns} FROM (
        SELECT date_trunc('day', created_at) - k * INTERVAL 1 DAY AS window_start, count(*) AS matched_pairs,
               round(avg(abs(actual_value - predicted_value)), 6) AS mae,
               round(sqrt(avg(pow(actual_value - predicted_value, 2))), 6) AS rmse,
               round(coalesce(100 * avg(CASE WHEN abs(actual_value) + abs(predicted_value) > 0 THEN
                   2 * abs(actual_value - predicted_value) / (abs(actual_value) + abs(predicted_value)) END), 0), 6) AS smape
        FROM ({pairs}), (SELECT unnest([0, 1]) AS k) GROUP BY 1)"""

_QUALITY = """
    SELECT CASE WHEN n >= 10 THEN 'ok' ELSE 'insufficient_matched_pairs' END AS status, '3d' AS window,
               n AS matched_pairs, 10::BIGINT AS required, CASE WHEN n >= 10 THEN round(mae, 6) END AS mae,
               CASE WHEN n >= 10 THEN round(rmse, 6) END AS rmse, CASE WHEN n >= 10 THEN round(smape, 6) END AS smape,
               CASE WHEN n >= 10 THEN z END AS zero_denominator_pairs_excluded,
               coalesce(n >= 10 AND round(mae, 6) > {threshold} * 1.2, false) AS degraded
        FROM (SELECT count(*) AS n, avg(abs(actual_value - predicted_value)) AS mae,
                     sqrt(avg(pow(actual_value - predicted_value, 2))) AS rmse,
                     coalesce(100 * avg(CASE WHEN abs(actual_value) + abs(predicted_value) > 0 THEN
                         2 * abs(actual_value - predicted_value) / (abs(actual_value) + abs(predicted_value)) END), 0) AS smape,
                     count(*) FILTER (WHERE abs(actual_value) + abs(predicted_value) = 0) AS z
              FROM final_log WHERE actual_value IS NOT NULL AND created_at >= TIMESTAMP '2024-01-28')"""

_DRIFT_STATUS = """
    SELECT CASE WHEN n < 100 THEN 'insufficient_samples' WHEN alerts > 0 OR s > 0.1 THEN 'alert'
                    WHEN warnings > 0 THEN 'warning' ELSE 'ok' END AS status,
               n AS collected, 100::BIGINT AS required, CASE WHEN n >= 100 THEN round(s, 6) END AS correlation_shift,
               CASE WHEN n >= 100 THEN x END AS n_excluded
        FROM (SELECT (SELECT count(*) FROM buffer) AS n,
                     (SELECT count(*) FROM verdicts WHERE verdict = 'alert') AS alerts,
                     (SELECT count(*) FROM verdicts WHERE verdict = 'warning') AS warnings,
                     (SELECT correlation_shift FROM shift) AS s, (SELECT n_excluded FROM shift) AS x)"""

ORACLE = {
    "filter_trips": sql("SELECT event_id, zone_id, hour_ts, fare, distance FROM trips"),
    "hourly_agg": sql(
        "SELECT zone_id, hour_ts, trip_count, round(avg_fare, 6) AS avg_fare, round(avg_distance, 6) AS avg_distance "
        "FROM hourly"
    ),
    "zone_universe": sql("SELECT DISTINCT zone_id FROM trips ORDER BY zone_id"),
    "first_zone_name": sql(
        "SELECT zone_id, event_type AS zone_name FROM trips "
        "QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY ts, event_type) = 1"
    ),
    "dense_history": sql(
        "SELECT zone_id, zone_name, hour_ts, trip_count, round(avg_fare, 6) AS avg_fare, "
        "round(avg_distance, 6) AS avg_distance FROM history"
    ),
    "named_history": sql(
        "SELECT d.zone_id, f.event_type AS zone_name, d.hour_ts, d.trip_count, NULL::DOUBLE AS avg_fare, "
        "NULL::DOUBLE AS avg_distance FROM dense d JOIN (SELECT zone_id, event_type FROM trips "
        "QUALIFY row_number() OVER (PARTITION BY zone_id ORDER BY ts, event_type) = 1) f USING (zone_id)"
    ),
    "hour_gaps": sql(
        "SELECT d.zone_id, d.hour_ts FROM dense d ANTI JOIN hourly h ON h.zone_id = d.zone_id AND h.hour_ts = d.hour_ts"
    ),
    "history_status": sql(
        "SELECT count(*) AS history_rows, count(DISTINCT zone_id) AS n_zones, min(hour_ts) AS first_hour, "
        "max(hour_ts) AS last_hour, TIMESTAMP '2024-01-08' AS supported_start, "
        "max(hour_ts) + INTERVAL 1 HOUR AS supported_end FROM history"
    ),
    "audit_counts": sql(
        "SELECT (SELECT count(*) FROM raw_trips) AS raw_rows, (SELECT count(*) FROM trips) AS kept_rows"
    ),
    "calendar_features": sql(
        "SELECT zone_id, hour_ts, trip_count, extract(hour FROM hour_ts) AS hour_of_day, isodow(hour_ts) - 1 AS "
        "day_of_week, CASE WHEN isodow(hour_ts) >= 6 THEN 1::BIGINT ELSE 0::BIGINT END AS is_weekend, "
        "extract(month FROM hour_ts) AS month FROM dense"
    ),
    "lag_rolling_features": sql(
        "SELECT zone_id, hour_ts, trip_count, hour_of_day, day_of_week, CAST(is_weekend AS BIGINT) AS is_weekend, month, "
        "lag_1h, lag_24h, lag_168h, round(rolling_mean_24h, 6) AS rolling_mean_24h FROM feats"
    ),
    "serve_features": sql(_SERVED),
    "serve_features_bulk": sql(_SERVED),
    "serve_stored": sql(_SERVED),
    "day_blocks": sql(
        "SELECT b.zone_id, CAST(b.day AS VARCHAR) AS day, b.days_back, b.hour, h.trip_count FROM (SELECT d.*, o.days_back, r.hour FROM "
        "(SELECT DISTINCT zone_id, CAST(hour_ts AS DATE) + CAST(k AS INTEGER) AS day FROM history, (VALUES (0), (1), (7)) v(k)) d, "
        "(VALUES (0::BIGINT), (1), (7)) o(days_back), range(24) r(hour)) b LEFT JOIN history h ON h.zone_id = b.zone_id "
        "AND h.hour_ts = CAST(b.day AS TIMESTAMP) - to_days(CAST(b.days_back AS INTEGER)) + to_hours(b.hour)"
    ),
    "strict_vs_serve_parity": sql("SELECT count(*) AS rows_compared, 0::BIGINT AS rows_different FROM feats"),
    "split_counts": sql(
        "SELECT * FROM (SELECT CASE WHEN hour_ts < TIMESTAMP '2024-01-20' THEN 'train' WHEN hour_ts < TIMESTAMP "
        "'2024-01-25' THEN 'val' WHEN hour_ts < TIMESTAMP '2024-01-31' THEN 'test' END AS split, count(*) AS n_rows, "
        "min(hour_ts) AS first_hour, max(hour_ts) AS last_hour FROM feats GROUP BY 1) WHERE split IS NOT NULL"
    ),
    "regression_fixture": sql(
        "SELECT hour_of_day, day_of_week, CAST(is_weekend AS BIGINT) AS is_weekend, month, zone_id, lag_1h, lag_24h, "
        "lag_168h, round(rolling_mean_24h, 6) AS rolling_mean_24h, trip_count FROM test "
        "WHERE zone_id IN (SELECT DISTINCT zone_id FROM test ORDER BY zone_id LIMIT 20)"
    ),
    "feature_contract": sql(
        _rules(
            "feats",
            {
                **_not_null("zone_id", "hour_ts", "trip_count", *_RANGES, "lag_1h", "lag_24h", "lag_168h", "rolling_mean_24h"),
                **_KEY_RULES,
                **{f"range_{c}": f"NOT {c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in _RANGES.items()},
            },
            "zone_id, hour_ts",
        )
    ),
    "history_contract": sql(
        _rules("history", {**_not_null("zone_id", "zone_name", "hour_ts", "trip_count"), **_KEY_RULES}, "zone_id, hour_ts")
    ),
    "staged_contract": sql(_rules(_STAGED_SOURCE, _STAGED)),
    "calendar_contract": sql(_CALENDAR_RULES),
    "prediction_contract": sql(
        _rules(
            "preds",
            {
                "not_null_zone_id": "zone_id IS NULL",
                "not_null_hour_ts": "hour_ts IS NULL",
                "not_null_predicted_count": "slot_mean IS NULL",
                "min_zone_id": "zone_id < 1",
                "min_predicted_count": "slot_mean < 0",
            },
        )
    ),
    "duplicate_keys": sql(
        "SELECT zone_id, hour_ts, count(*) AS copies FROM trips GROUP BY zone_id, hour_ts HAVING count(*) > 1"
    ),
    "violating_rows": sql(
        "SELECT * FROM (SELECT event_id, concat_ws(',', "
        + ", ".join(f"CASE WHEN {cond} THEN '{n}' END" for n, cond in _STAGED.items())
        + f") AS broken_rules FROM {_STAGED_SOURCE}) WHERE broken_rules <> ''"
    ),
    "grid_checks": sql(
        "SELECT 'no_hour_gaps' AS rule, count(*) AS violations FROM dense d ANTI JOIN hourly h ON h.zone_id = d.zone_id "
        "AND h.hour_ts = d.hour_ts UNION ALL SELECT 'warmup_present', CASE WHEN count(*) = 0 THEN 1::BIGINT ELSE "
        "0::BIGINT END FROM hourly WHERE hour_ts >= TIMESTAMP '2024-01-01' AND hour_ts < TIMESTAMP '2024-01-08'"
    ),
    "regression_gate": sql("SELECT model, mae < 3.2 AND pct_clipped < 5 AS passed FROM metrics"),
    "pipeline_parity": sql(
        "SELECT count(*) AS rows_different FROM (SELECT zone_id, hour_ts, sum(n) AS trip_count FROM (SELECT zone_id, "
        "hour_ts, trip_count AS n FROM hourly UNION ALL SELECT zone_id, hour_ts, 0 FROM (SELECT DISTINCT zone_id FROM "
        "hourly), spine) GROUP BY ALL) u FULL JOIN dense d ON d.zone_id = u.zone_id AND d.hour_ts = u.hour_ts "
        "WHERE d.trip_count IS DISTINCT FROM u.trip_count"
    ),
    "slot_mean_fit": sql(
        "SELECT zone_id, hour_of_day, day_of_week, slot_rows, slot_total, round(slot_mean, 6) AS slot_mean FROM slots"
    ),
    "slot_mean_predict": sql("SELECT zone_id, hour_ts, round(slot_mean, 6) AS slot_mean FROM preds"),
    "seasonal_naive_predict": sql("SELECT zone_id, hour_ts, lag_168h AS seasonal_naive FROM test"),
    "model_comparison": sql(
        "SELECT model, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(smape, 6) AS smape, n_predictions, n_clipped, "
        "round(mean_pred, 6) AS mean_pred, round(std_pred, 6) AS std_pred, pct_clipped FROM metrics"
    ),
    "model_deltas": sql(
        "SELECT c.model AS candidate, b.model AS baseline, round(b.mae, 6) AS baseline_mae, round(c.mae, 6) AS "
        "candidate_mae, round((c.mae - b.mae) / b.mae * 100, 6) AS delta_pct FROM metrics c JOIN metrics b "
        "ON b.model <> c.model WHERE c.model = 'seasonal_naive' AND b.mae > 0"
    ),
    "hardest_zones": sql(
        "SELECT zone_id, zone_name, round(mae, 6) AS mae, round(mean_demand, 6) AS mean_demand FROM hardest"
    ),
    "demand_quantiles": sql("SELECT round(p_low, 6) AS p_low, round(p_high, 6) AS p_high FROM quantiles"),
    "segment_mae": sql(
        "SELECT segment, n_rows, round(slot_mean_mae, 6) AS slot_mean_mae, round(seasonal_naive_mae, 6) AS "
        "seasonal_naive_mae FROM segments"
    ),
    "segment_deltas": sql(
        "SELECT segment, n_rows, CASE WHEN slot_mean_mae > 0 THEN round((seasonal_naive_mae - slot_mean_mae) / "
        "slot_mean_mae * 100, 6) END AS delta_pct FROM segments"
    ),
    "evaluation_report": sql(
        """SELECT section, key, metric, round(value, 6) AS value FROM (
        SELECT 'model_comparison' AS section, model AS key, metric, value FROM (
            SELECT model, mae, rmse, smape, n_predictions::DOUBLE AS n_predictions, n_clipped::DOUBLE AS n_clipped,
                   mean_pred, std_pred, pct_clipped FROM metrics)
            UNPIVOT (value FOR metric IN (mae, rmse, smape, n_predictions, n_clipped, mean_pred, std_pred, pct_clipped))
        UNION ALL
        SELECT 'segments', segment, metric, value FROM (
            SELECT segment, n_rows::DOUBLE AS n_rows, slot_mean_mae, seasonal_naive_mae FROM segments)
            UNPIVOT (value FOR metric IN (n_rows, slot_mean_mae, seasonal_naive_mae))
        UNION ALL
        SELECT 'hardest_zones', CAST(zone_id AS VARCHAR), metric, value FROM hardest
            UNPIVOT (value FOR metric IN (mae, mean_demand)))"""
    ),
    "match_by_id": sql(
        "SELECT a.prediction_id, count(*) AS submissions, arg_max(a.actual_value, a.seq) AS actual_value, "
        "bool_or(p.prediction_id IS NOT NULL) AS matched FROM actuals a LEFT JOIN plog p ON p.prediction_id = "
        "a.prediction_id WHERE a.prediction_id IS NOT NULL GROUP BY a.prediction_id"
    ),
    "match_latest": sql(
        "SELECT a.zone_id, a.hour_ts, l.prediction_id, a.actual_value, l.prediction_id IS NOT NULL AS matched "
        "FROM actuals a LEFT JOIN latest l ON l.zone_id = a.zone_id AND l.hour_ts = a.hour_ts "
        "WHERE a.prediction_id IS NULL"
    ),
    "latest_prediction": sql("SELECT zone_id, hour_ts, prediction_id FROM latest"),
    "match_summary": sql(
        "SELECT count(*) FILTER (WHERE target IS NOT NULL) AS matched_count, "
        "count(*) FILTER (WHERE target IS NULL) AS unmatched_count FROM resolved"
    ),
    "unmatched_actuals": sql(
        "SELECT CASE WHEN prediction_id IS NOT NULL THEN 'unknown prediction ' || prediction_id ELSE "
        "'nothing predicted for zone ' || zone_id || ' at ' || strftime(hour_ts, '%Y-%m-%dT%H:%M:%S') END "
        "AS warning, count(*) AS submissions FROM resolved WHERE target IS NULL GROUP BY 1"
    ),
    "quality_window": sql(_QUALITY.format(threshold=3.2)),
    "latest_buffer": sql("SELECT zone_id, hour_ts, trip_count FROM buffer"),
    "decile_bins": sql("SELECT feature, bin, round(low, 6) AS low, round(high, 6) AS high, rows FROM ref_bins"),
    "ks_sample": sql("SELECT feature, round(value, 6) AS value, digest FROM sample"),
    "psi": sql("SELECT feature, round(psi, 6) AS psi FROM psi"),
    "ks_stat": sql(
        "SELECT feature, n_ref, n_cur, round(d, 6) AS ks_statistic, round(p, 6) AS ks_pvalue FROM ks_p"
    ),
    "corr_matrix": sql("SELECT f1, f2, round(corr, 6) AS corr FROM ref_corr"),
    "daily_moments": sql(_daily_moments()),
    "corr_recent": sql(
        "SELECT f1, f2, round(corr, 6) AS corr FROM ("
        + _corr("(SELECT * FROM train WHERE hour_ts >= (SELECT CAST(max(hour_ts) AS DATE) - 6 FROM train))")
        + ")"
    ),
    "corr_shift": sql("SELECT round(correlation_shift, 6) AS correlation_shift, n_excluded FROM shift"),
    "drift_report": sql("SELECT feature, psi, ks_statistic, ks_pvalue, verdict FROM verdicts"),
    "drift_status": sql(_DRIFT_STATUS),
    "sparse_zones": sql(
        """SELECT zone_id, round(mean_demand, 6) AS mean_demand, round(threshold, 6) AS threshold FROM (
            SELECT *, max(mean_demand) FILTER (WHERE rn = least(CAST(floor(n * 10.0::DOUBLE / 100) AS BIGINT), n - 1))
                          OVER () AS threshold
            FROM (SELECT *, row_number() OVER (ORDER BY mean_demand) - 1 AS rn, count(*) OVER () AS n
                  FROM (SELECT zone_id, CAST(sum(trip_count) AS DOUBLE) / count(*) AS mean_demand FROM dense
                        GROUP BY zone_id)))
        WHERE mean_demand < threshold"""
    ),
    "extreme_predictions": sql(
        "SELECT t.event_id, t.zone_id, t.fare AS predicted_count, m.max_seen FROM trips t JOIN (SELECT zone_id, "
        "max(trip_count) AS max_seen FROM hourly GROUP BY zone_id) m USING (zone_id) "
        "WHERE m.max_seen > 0 AND t.fare > m.max_seen * 5.0::DOUBLE"
    ),
    "usage_daily": sql("SELECT client, endpoint, date, request_count, total_records FROM usage"),
    "usage_report": sql(
        "SELECT client, endpoint, date, request_count, total_records FROM usage ORDER BY date DESC, client, endpoint"
    ),
    "dedup_latest": (
        "SELECT user_id, event_id, ts, event_type, value FROM events "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
    ),
    "request_counts": sql("SELECT endpoint, status, count(*) AS requests FROM rlog GROUP BY endpoint, status"),
    "rejection_counts": sql("SELECT reason, count(*) AS rejections FROM rlog WHERE reason IS NOT NULL GROUP BY reason"),
    "error_count": sql("SELECT count(*) FILTER (WHERE status = '500') AS errors FROM rlog"),
    "latency_histogram": sql(
        _HISTOGRAM.format(
            by="endpoint,", value="latency_s", edges="[0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 1e308]"
        )
    ),
    "prediction_histogram": sql(
        _HISTOGRAM.format(by="", value="predicted", edges="[0, 1, 5, 10, 25, 50, 100, 250, 500, 1000, 1e308]")
    ),
    "request_rate": sql(
        "SELECT request_id, client, count(*) OVER (PARTITION BY client ORDER BY ts RANGE BETWEEN INTERVAL 3600 SECOND "
        "PRECEDING AND CURRENT ROW) AS recent FROM rlog"
    ),
    "client_pseudonym": (
        "SELECT sha256(CAST(user_id AS VARCHAR)) AS client_hash, count(*) AS requests FROM events GROUP BY 1"
    ),
    "station_id_normalize": sql("SELECT event_id, station, usable, zone_id FROM station_ids"),
    "parse_trip_text": (
        "SELECT event_id, date_trunc('minute', ts) AS minute_ts, date_trunc('second', ts) AS second_ts, "
        "date_trunc('hour', ts) AS hour_ts FROM events"
    ),
    "csv_trips": sql("SELECT zone_id, hour_ts, trip_count FROM station_hours"),
    "zip_trips": sql("SELECT zone_id, hour_ts, trip_count FROM station_hours"),
    "tfl_csv_trips": (
        "SELECT user_id AS zone_id, date_trunc('hour', ts) AS hour_ts, count(*) AS trip_count FROM events GROUP BY ALL"
    ),
    "taxi_trips": sql(
        "SELECT zone_id, zone_name, hour_ts, trip_count, round(avg_fare, 6) AS avg_fare, "
        "round(avg_distance, 6) AS avg_distance FROM history"
    ),
    "batch_score": sql(
        """SELECT f.request_id, f.zone_id, coalesce(n.zone_name, 'zone ' || f.zone_id || ' (no name)') AS zone_name, f.hour_ts,
               f.reason, CASE WHEN f.reason IS NULL THEN round(coalesce(s.slot_mean,
                   (SELECT coalesce(avg(trip_count), 0) FROM train)), 6) END AS predicted_count,
               'slot_mean' AS model_name, 'v1' AS model_version
        FROM flagged f
        LEFT JOIN (SELECT zone_id, arg_min(zone_name, hour_ts) AS zone_name FROM history GROUP BY zone_id) n
               ON n.zone_id = f.zone_id
        LEFT JOIN slots s ON s.zone_id = f.zone_id AND s.hour_of_day = extract(hour FROM f.hour_ts)
               AND s.day_of_week = isodow(f.hour_ts) - 1"""
    ),
    "layered_marts": sql(
        "SELECT zone_id, hour_ts, trip_count, round(avg_fare, 6) AS avg_fare, round(avg_distance, 6) AS avg_distance, "
        "hour_of_day, day_of_week, CAST(is_weekend AS BIGINT) AS is_weekend, month FROM windowed"
    ),
    "layered_checks": sql(
        f"SELECT 'stg_trips' AS layer, rule, violations FROM ({_rules('trips', _STAGED_WIDE)}) UNION ALL "
        "SELECT 'zone_hour_dense', 'no_hour_gaps', count(*) FROM (SELECT zone_id, hour_ts FROM "
        "(SELECT DISTINCT zone_id FROM dense), spine EXCEPT SELECT zone_id, hour_ts FROM dense) UNION ALL "
        "SELECT 'zone_hour_dense', 'warmup_present', CAST(count(*) FILTER (WHERE hour_ts < TIMESTAMP '2024-01-08') = 0 "
        f"AS BIGINT) FROM dense UNION ALL SELECT 'training_features', rule, violations FROM ({_CALENDAR_RULES})"
    ),
    "stream_log": sql(
        "SELECT f.zone_id, f.hour_ts, round(coalesce(s.slot_mean, (SELECT coalesce(avg(trip_count), 0) FROM train)), 6) "
        "AS predicted_value, TIMESTAMP '2024-01-31' AS created_at FROM flagged f LEFT JOIN slots s ON s.zone_id = "
        "f.zone_id AND s.hour_of_day = extract(hour FROM f.hour_ts) AND s.day_of_week = isodow(f.hour_ts) - 1 "
        "WHERE f.reason IS NULL"
    ),
    "stream_drift": sql("SELECT feature, psi, ks_statistic, ks_pvalue, verdict FROM verdicts"),
    "stream_drift_status": sql(_DRIFT_STATUS),
    "quality_alert": sql(
        f"SELECT q.*, CASE WHEN q.degraded THEN s.status END AS drift_status FROM ({_QUALITY.format(threshold=0.01)}) q, "
        f"({_DRIFT_STATUS}) s"
    ),
    "stream_hourly": sql(
        "SELECT zone_id, hour_ts, trip_count, round(avg_fare, 6) AS avg_fare, round(avg_distance, 6) AS avg_distance "
        "FROM hourly"
    ),
    "stream_usage": sql(
        "SELECT client, endpoint, date, request_count, total_records FROM usage"
    ),
    "usage_upserts": sql("SELECT client, endpoint, date, request_count, total_records FROM usage"),
    "stream_quality": sql(
        _WINDOWS.format(
            pairs="SELECT p.created_at, p.predicted_value, s.v AS actual_value FROM plog p JOIN (SELECT md5(concat_ws('|', zone_id, hour_ts, "
            "'slot_mean', '')) AS prediction_id, hour_ts + INTERVAL 1 HOUR AS observed_at, CAST(trip_count AS DOUBLE) AS v FROM dense) s "
            "USING (prediction_id) WHERE s.observed_at >= p.created_at",
            columns="matched_pairs, mae, rmse, smape",
        )
    ),
    "stream_quality_revised": sql(
        _WINDOWS.format(
            pairs="SELECT created_at, predicted_value, actual_value FROM final_log WHERE actual_value IS NOT NULL",
            columns="CASE WHEN matched_pairs >= 10 THEN 'ok' ELSE 'insufficient_matched_pairs' END AS status, matched_pairs, "
            "CASE WHEN matched_pairs >= 10 THEN mae END AS mae, CASE WHEN matched_pairs >= 10 THEN rmse END AS rmse, "
            "CASE WHEN matched_pairs >= 10 THEN smape END AS smape",
        )
    ),
}
