"""Settings of a dataset: calendar, features, split and thresholds."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta

# The model's input columns, in the order models receive them.
FEATURES = (
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "month",
    "zone_id",
    "lag_1h",
    "lag_24h",
    "lag_168h",
    "rolling_mean_24h",
)
CONTINUOUS = tuple(c for c in FEATURES if c != "zone_id")
TARGET = "trip_count"

# Hours counted as peak, and the night hours (inclusive).
PEAK_HOURS = (7, 8, 9, 17, 18, 19)
NIGHT_HOURS = (0, 5)

# Drift thresholds.
PSI_WARNING = 0.1
PSI_ALERT = 0.25
KS_ALPHA = 0.05
CORRELATION_ALERT = 0.1
PSI_EPSILON = 1e-6

# Upper edges of the request latency (s) and predicted value histograms.
LATENCY_EDGES = (0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
PREDICTION_EDGES = (0, 1, 5, 10, 25, 50, 100, 250, 500, 1000)


def as_datetime(value: str | datetime) -> datetime:
    return datetime.fromisoformat(value) if isinstance(value, str) else value


@dataclass(frozen=True)
class Split:
    """Half-open train / validation / test boundaries."""

    train_start: datetime
    train_end: datetime
    val_end: datetime
    test_end: datetime

    @classmethod
    def of(cls, train_start, train_end, val_end, test_end) -> Split:
        return cls(*(as_datetime(v) for v in (train_start, train_end, val_end, test_end)))


@dataclass(frozen=True)
class DatasetConfig:
    name: str
    start: datetime
    end: datetime
    split: Split
    months: tuple[str, ...] = ()
    min_zone: int = 1
    max_zone: int | None = None
    unknown_label: str = "Unknown"
    lags: tuple[int, ...] = (1, 24, 168)
    rolling_windows: tuple[int, ...] = (24,)
    # Fixed values down to the alert margin: configured defaults.  Tree settings keep the configured meaning: rounds, shrinkage, depth, leaf size, row share.
    rounds: int = 500
    learning_rate: float = 0.05
    max_depth: int = 6
    min_child_samples: int = 20
    subsample: float = 0.8
    feature_share: float = 0.8
    patience: int = 50
    seed: int = 42
    drift_min_samples: int = 100
    drift_max_samples: int = 1000
    ks_sample_size: int = 5000
    n_bins: int = 10
    min_matched_pairs: int = 10
    mae_threshold: float = 3.20
    mae_alert_margin: float = 1.2
    paths: dict[str, str] = field(default_factory=dict)

    @property
    def last_hour(self) -> datetime:
        return self.end - timedelta(hours=1)

    @property
    def lag_columns(self) -> list[str]:
        return [f"lag_{k}h" for k in self.lags]

    @property
    def rolling_columns(self) -> list[str]:
        return [f"rolling_mean_{w}h" for w in self.rolling_windows]

    def with_(self, **changes) -> DatasetConfig:
        return replace(self, **changes)


def _calendar(months: tuple[str, ...]) -> tuple[datetime, datetime]:
    """First hour of the first month, and first hour after the last month."""
    first = datetime.fromisoformat(min(months) + "-01")
    last = datetime.fromisoformat(max(months) + "-01")
    return first, (last + timedelta(days=32)).replace(day=1)


# Months and split dates of the three supported datasets.
_WINTER = ("2023-12", "2024-01", "2024-02")
_SPRING = ("2024-01", "2024-02", "2024-03")
_WINTER_SPLIT = ("2024-01-01T00:00:00", "2024-02-01T00:00:00", "2024-02-15T00:00:00", "2024-03-01T00:00:00")
_SPRING_SPLIT = ("2024-02-01T00:00:00", "2024-03-01T00:00:00", "2024-03-16T00:00:00", "2024-04-01T00:00:00")

_PRESETS = {
    "taxi": dict(months=_WINTER, split=Split.of(*_WINTER_SPLIT), max_zone=263),
    "tfl": dict(months=_WINTER, split=Split.of(*_WINTER_SPLIT), unknown_label="Unknown Station"),
    "citibike": dict(months=_SPRING, split=Split.of(*_SPRING_SPLIT), unknown_label="Unknown Station"),
}


# Names of the tree settings in a configuration file.
_TREE_KEYS = {
    "n_estimators": "rounds",
    "learning_rate": "learning_rate",
    "max_depth": "max_depth",
    "min_child_samples": "min_child_samples",
    "subsample": "subsample",
    "colsample_bytree": "feature_share",
    "early_stopping_rounds": "patience",
    "random_state": "seed",
}


def preset(name: str, **changes) -> DatasetConfig:
    """Configuration of a known dataset, with optional overrides."""
    if name not in _PRESETS:
        raise ValueError(f"unknown dataset {name!r}; known: {sorted(_PRESETS)}")
    values = dict(_PRESETS[name])
    start, end = _calendar(values["months"])
    return DatasetConfig(name=name, start=start, end=end, **values).with_(**changes)


def load_config(path: str) -> DatasetConfig:
    """Read a JSON (or YAML, where PyYAML is present) file in the nested layout of the presets."""
    with open(path, encoding="utf-8") as fh:
        text = fh.read()
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as exc:
            raise RuntimeError("reading YAML needs PyYAML; use JSON instead") from exc
        raw = yaml.safe_load(text)
    else:
        raw = json.loads(text)

    changes: dict = {}
    months = tuple(raw.get("data", {}).get("months", ()))
    if months:
        start, end = _calendar(months)
        changes.update(months=months, start=start, end=end)
    if "split" in raw:
        s = raw["split"]
        changes["split"] = Split.of(s["train_start"], s["train_end"], s["val_end"], s["test_end"])
    feats = raw.get("features", {})
    if "lag_hours" in feats:
        changes["lags"] = tuple(feats["lag_hours"])
    if "rolling_windows" in feats:
        changes["rolling_windows"] = tuple(feats["rolling_windows"])
    for section, keys in {
        ("monitoring", "drift"): {"min_samples": "drift_min_samples", "maxlen": "drift_max_samples"},
        ("monitoring", "quality"): {
            "min_matched_pairs": "min_matched_pairs",
            "mae_alert_margin": "mae_alert_margin",
        },
        # The tree section goes by either name.
        ("models", "lightgbm"): _TREE_KEYS,
        ("models", "gbt"): _TREE_KEYS,
    }.items():
        node = raw
        for part in section:
            node = node.get(part, {}) if isinstance(node, dict) else {}
        changes.update({field_: node[key] for key, field_ in keys.items() if key in node})
    paths = {**raw.get("data", {}), **raw.get("artifacts", {})}
    changes["paths"] = {k: v for k, v in paths.items() if isinstance(v, str)}
    return preset(raw.get("dataset", {}).get("adapter", "taxi"), **changes)
