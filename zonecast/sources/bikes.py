"""Bike-share trips: bi-weekly CSV extracts and monthly zip archives of CSV files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.textfns import is_station_id, station_number
from zonecast.functions.timefns import parse_minutes, parse_seconds
from zonecast.session import path_exists

# Extract files of each month.
TFL_FILES = {
    "2023-12": (
        "385JourneyDataExtract01Dec2023-14Dec2023.csv",
        "386JourneyDataExtract15Dec2023-31Dec2023.csv",
    ),
    "2024-01": (
        "387JourneyDataExtract01Jan2024-14Jan2024.csv",
        "388JourneyDataExtract15Jan2024-31Jan2024.csv",
    ),
    "2024-02": (
        "389JourneyDataExtract01Feb2024-14Feb2024.csv",
        "390JourneyDataExtract15Feb2024-29Feb2024.csv",
    ),
}
# Columns used from an archive member.
TFL_COLUMNS = ("Start station number", "Start station", "Start date")
MEMBER_COLUMNS = ("started_at", "start_station_name", "start_station_id")

_CSV = {"header": True, "quote": '"', "escape": '"', "mode": "FAILFAST", "enforceSchema": False}


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    first = spark.read.options(header=True, quote='"', escape='"').csv(path)
    return tuple(first.columns)


def _expanded(spark: SparkSession, pattern: str) -> list[str]:
    """Files of a path or pattern, on any file system that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return sorted(f.getPath().toString() for f in found or [])


def read_named_csv(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], multiline: bool = False) -> DataFrame:
    """``columns`` of several CSV files as text, by name.

    Files are grouped by their header line, so one with another order of columns is read by its own.  A file without
    a wanted column, or a row with a different number of fields than its header, raises.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in (f for p in paths for f in _expanded(spark, p)):
        groups.setdefault(_header(spark, path), []).append(path)
    out = None
    for header, files in groups.items():
        absent = [c for c in columns if c not in header]
        if absent:
            raise ValueError(f"no column {absent} in {files}")
        schema = ", ".join(f"`{c}` string" for c in header)
        # All fields are parsed (no pruning), or a short row would go unseen.
        rows = spark.read.options(**_CSV, multiLine=multiline, columnPruning=False).schema(schema).csv(files).select(*[f"`{c}`" for c in columns])
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise FileNotFoundError(f"no files at {list(paths)}")
    return out


def require_files(spark: SparkSession, root: str, expected: Sequence[str]) -> None:
    """Every expected name (or ``*`` pattern) must be there: absent files would become false zeros."""
    missing = [e for e in expected if not path_exists(spark, f"{root.rstrip('/')}/{e}")]
    if missing:
        raise FileNotFoundError(f"missing in {root}: {missing}")


def tfl_files(months: Sequence[str]) -> list[str]:
    unknown = [m for m in months if m not in TFL_FILES]
    if unknown:
        raise FileNotFoundError(f"no extract files are known for {unknown}")
    return [f for m in months for f in TFL_FILES[m]]


def read_tfl_trips(spark: SparkSession, paths: Sequence[str], multiline: bool = False) -> DataFrame:
    """Trips of quoted CSV extracts; dates are cut to minutes, a bad date or id raises.

    ``multiline`` accepts line breaks inside quotes, at the price of one task per file.
    """
    raw = read_named_csv(spark, paths, TFL_COLUMNS, multiline)
    return (
        raw.select(
            F.col("Start station number").cast("bigint").alias("zone_id"),
            F.col("Start station").alias("zone_name"),
            parse_minutes("Start date").alias("ts"),
        )
        .na.drop(subset=["zone_id", "ts"])
    )


def citibike_patterns(months: Sequence[str]) -> list[str]:
    return [f"{m.replace('-', '')}*citibike*.csv" for m in months]


def read_member_csv(spark: SparkSession, paths: Sequence[str], multiline: bool = False) -> DataFrame:
    """Extracted CSV members as text columns."""
    return read_named_csv(spark, paths, MEMBER_COLUMNS, multiline)


def read_member_zip(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Members of the zip archives at ``paths``."""
    return unzip_members(spark.read.format("binaryFile").load(list(paths)).select("content"))


def unzip_members(archives: DataFrame, chunk: int = 50_000) -> DataFrame:
    """Every ``*.csv`` member (any case, any folder) of a ``content`` column as text columns.

    An archive cannot be split, so it is one task; its members are decompressed as a
    stream and leave the task in chunks.  Companion files of an archiver (``__MACOSX``
    folders, names that start with ``._``) are no data; a member that repeats another's name and
    content is read once, one of that name with other content is read, too.
    """
    columns = list(MEMBER_COLUMNS)

    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    done = set()
                    for info in archive.infolist():
                        *folders, base = info.filename.split("/")
                        companion = base.startswith("._") or "__MACOSX" in folders
                        same = (base, info.CRC, info.file_size)
                        if info.file_size == 0 or companion or not base.lower().endswith(".csv") or same in done:
                            continue
                        done.add(same)
                        with archive.open(info) as member:
                            parts = pd.read_csv(
                                member,
                                usecols=columns,
                                dtype=str,
                                keep_default_na=False,
                                na_values=[""],
                                chunksize=chunk,
                                encoding="utf-8-sig",
                            )
                            for part in parts:
                                yield part[columns]

    return archives.select("content").mapInPandas(unzip, ", ".join(f"{c} string" for c in columns))


def citibike_trips(members: DataFrame, audit: Observation | None = None) -> DataFrame:
    """Trips with usable station ids; ``audit`` receives ``total`` and ``dropped`` row counts."""
    usable = is_station_id("start_station_id")
    if audit is not None:
        members = members.observe(
            audit, F.count(F.lit(1)).alias("total"), F.count_if(~usable).alias("dropped")
        )
    return members.where(usable).select(
        station_number("start_station_id").alias("zone_id"),
        F.col("start_station_name").alias("zone_name"),
        parse_seconds("started_at").alias("ts"),
    )


def require_trips(trips: DataFrame, members: DataFrame | None = None) -> None:
    """A source whose rows were all filtered out is an error, not an empty grid; ``members`` tells how many there were."""
    if trips.isEmpty():
        count = "" if members is None else f" {members.count()}"
        raise ValueError(f"all{count} rows were filtered out (no usable station ids); cannot build a grid")
