"""Identifier columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonecast.functions.timefns import col_of

# Fixed value: a usable station id, digits with one or two decimals.
STATION_ID_PATTERN = r"\A[0-9]+\.[0-9]{1,2}\z"


def is_station_id(c: Column | str) -> Column:
    """True for usable ids; NULL counts as unusable."""
    return F.coalesce(col_of(c).rlike(STATION_ID_PATTERN), F.lit(False))


def station_number(c: Column | str) -> Column:
    """``4028.03`` -> 402803 and ``3113.1`` -> 311310."""
    padded = F.regexp_replace(col_of(c), r"\.([0-9])\z", ".$10")
    return F.regexp_replace(padded, r"\.", "").cast("bigint")


def pseudonym(c: Column | str) -> Column:
    """SHA-256 hex digest of a client key."""
    return F.sha2(col_of(c).cast("string"), 256)


def row_digest(*parts: Column | str, seed: int | str = "") -> Column:
    """Stable hex digest of a row key, equal on every run and engine."""
    cols = [col_of(p).cast("string") for p in parts]
    return F.md5(F.concat_ws("|", *cols, F.lit(str(seed))))
