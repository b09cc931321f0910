"""Raw files to stored history, universe and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonecast.config import DatasetConfig
from zonecast.operators.contracts import (
    Contract,
    coerce,
    contract_report,
    feature_contract,
    history_contract,
    raise_on_violations,
)
from zonecast.operators.features import day_blocks, engineer_features, zone_facts
from zonecast.operators.history import Audit
from zonecast.session import publish, use_utc
from zonecast.sources.registry import read_history
from zonecast.sources.sinks import write_history, write_table, write_universe


def _store_checked(df: DataFrame, contract: Contract, out: str, writer, audit: Audit | None = None) -> str:
    """Writes once to a staging folder, checks what was written, then publishes it."""
    spark = df.sparkSession
    staged = writer(coerce(df, contract), f"{out}/staged/{contract.name}")
    counts = {} if audit is None else audit.counts()
    if counts.get("kept", counts.get("grid", 1)) == 0:
        raise ValueError(f"all rows were filtered out: {counts}; nothing to publish")
    raise_on_violations(contract_report(spark.read.parquet(staged), contract), contract.name)
    return publish(spark, staged, f"{out}/{contract.name}")


def prepare(spark: SparkSession, root: str, out: str, cfg: DatasetConfig) -> dict[str, str]:
    """Builds, checks and stores the tables of a dataset; returns their paths.

    Each stage is written once and read back, so a contract check or a later stage
    never repeats the scan of the raw trips, and lost executors cost one stage at most.
    A table that breaks its contract stays in the ``staged`` folder and is not published.
    ``audit`` holds the source's row counts (raw, kept, dropped, grid), taken while the
    history was written.  ``blocks`` and ``zones`` are what serving reads instead of the history.
    """
    use_utc(spark)
    out = out.rstrip("/")
    audit = Audit(cfg.name)
    paths = {"history": _store_checked(read_history(spark, root, cfg, audit), history_contract(), out, write_history, audit)}
    paths["audit"] = write_table(audit.table(spark), f"{out}/audit")
    history = spark.read.parquet(paths["history"])
    paths["universe"] = write_universe(history, f"{out}/universe", cfg.name)
    paths["features"] = _store_checked(engineer_features(history, cfg), feature_contract(), out, write_table)
    paths["blocks"] = publish(spark, write_table(day_blocks(history, cfg), f"{out}/staged/blocks"), f"{out}/blocks")
    paths["zones"] = publish(spark, write_table(zone_facts(history), f"{out}/staged/zones"), f"{out}/zones")
    return paths
