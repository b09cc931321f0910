"""Datasets by name: ``source(name)(spark, root, cfg, audit)`` gives the hourly history; ``audit`` is optional, also for own sources."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonecast.config import DatasetConfig
from zonecast.operators.history import Audit, hourly_history, valid_trips
from zonecast.session import use_utc
from zonecast.sources import bikes, taxi

Source = Callable[..., DataFrame]
_SOURCES: dict[str, Source] = {}


def register_source(name: str):
    def wrap(fn: Source) -> Source:
        _SOURCES[name] = fn
        return fn

    return wrap


def source(name: str) -> Source:
    if name not in _SOURCES:
        raise ValueError(f"unknown source {name!r}; known: {sorted(_SOURCES)}")
    return _SOURCES[name]


def read_history(spark: SparkSession, root: str, cfg: DatasetConfig, audit: Audit | None = None) -> DataFrame:
    """The hourly history.  With ``audit``, its ``grid`` rows, and what the source watches (``raw``, ``kept``), are counted as it is written."""
    read = source(cfg.name)
    if audit is None:
        return read(use_utc(spark), root, cfg)
    known = {"audit": audit} if "audit" in inspect.signature(read).parameters else {}
    return audit.watch(read(use_utc(spark), root, cfg, **known), "grid")


def _watch(audit: Audit | None, df: DataFrame, step: str) -> DataFrame:
    return df if audit is None else audit.watch(df, step)


@register_source("taxi")
def taxi_history(spark: SparkSession, root: str, cfg: DatasetConfig, audit: Audit | None = None) -> DataFrame:
    files = taxi.month_files(root, cfg.months)
    bikes.require_files(spark, root, [f.rsplit("/", 1)[-1] for f in files])
    raw = _watch(audit, taxi.read_trips(spark, files), "raw")
    trips = _watch(audit, valid_trips(raw, cfg.start, cfg.end, cfg.min_zone, cfg.max_zone), "kept")
    lookup = taxi.read_zone_lookup(spark, cfg.paths.get("zones_path", f"{root.rstrip('/')}/zones.csv"))
    return hourly_history(trips, cfg.start, cfg.end, lookup, cfg.unknown_label)


@register_source("tfl")
def tfl_history(spark: SparkSession, root: str, cfg: DatasetConfig, audit: Audit | None = None) -> DataFrame:
    names = bikes.tfl_files(cfg.months)
    bikes.require_files(spark, root, names)
    trips = bikes.read_tfl_trips(spark, [f"{root.rstrip('/')}/{n}" for n in names], cfg.paths.get("multiline") == "true")
    return hourly_history(_watch(audit, trips, "kept"), cfg.start, cfg.end, None, cfg.unknown_label)


@register_source("citibike")
def citibike_history(spark: SparkSession, root: str, cfg: DatasetConfig, audit: Audit | None = None) -> DataFrame:
    """Extracted CSV members in ``root``; see :func:`citibike_zip_history` for archives."""
    patterns = bikes.citibike_patterns(cfg.months)
    bikes.require_files(spark, root, patterns)
    members = bikes.read_member_csv(spark, [f"{root.rstrip('/')}/{p}" for p in patterns])
    return _from_members(members, cfg, audit)


@register_source("citibike_zip")
def citibike_zip_history(spark: SparkSession, root: str, cfg: DatasetConfig, audit: Audit | None = None) -> DataFrame:
    """Monthly zip archives in ``root``, read without unpacking to disk."""
    patterns = [f"{m.replace('-', '')}*citibike*.zip" for m in cfg.months]
    bikes.require_files(spark, root, patterns)
    members = bikes.read_member_zip(spark, [f"{root.rstrip('/')}/{p}" for p in patterns])
    return _from_members(members, cfg, audit)


def _from_members(members: DataFrame, cfg: DatasetConfig, audit: Audit | None) -> DataFrame:
    trips = _watch(audit, bikes.citibike_trips(_watch(audit, members, "raw")), "kept")
    if audit is None:
        bikes.require_trips(trips, members)
    return hourly_history(trips, cfg.start, cfg.end, None, cfg.unknown_label)
