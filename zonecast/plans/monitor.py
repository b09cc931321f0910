"""Drift and quality reports from stored tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from zonecast.config import DatasetConfig
from zonecast.operators.drift import correlation_matrix, correlation_shift, current_buffer, drift_status, feature_drift
from zonecast.operators.quality import match_actuals, quality_alert, quality_window, with_actuals
from zonecast.session import materialize


def drift_tables(
    bins: DataFrame,
    sample: DataFrame,
    correlation: DataFrame,
    scored: DataFrame,
    cfg: DatasetConfig,
    ts: str = "scored_at",
    tie: str = "request_id",
    exact: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(per feature, overall)`` drift of the newest scored rows."""
    # At most ``drift_max_samples`` rows.
    current = materialize(current_buffer(scored, cfg.drift_max_samples, ts, tie), "drift-buffer")
    per_feature = materialize(feature_drift(bins, sample, current, cfg.n_bins, exact), "drift-features")
    shift = correlation_shift(correlation, correlation_matrix(current))
    return per_feature, drift_status(per_feature, shift, current, cfg.drift_min_samples)


def quality_report(
    log: DataFrame,
    actuals: DataFrame,
    cfg: DatasetConfig,
    window: str = "7d",
    as_of: datetime | None = None,
    drift: DataFrame | None = None,
) -> DataFrame:
    """Matches actuals to the log and reports the window's quality, with drift when degraded."""
    quality = quality_window(with_actuals(log, match_actuals(log, actuals)), window, as_of, cfg)
    return quality if drift is None else quality_alert(quality, drift)
