"""Sharding by a permutation-filled lookup table (operator 10, native).

Method: the table has a prime number of slots.  Every shard has its own order of preference over all slots, ``(offset + j *
skip) mod slots``, a permutation because the size is prime.  The shards take turns; each claims the first slot of its order that
is still free, until none is.  A key's hash picks a slot, the slot names the shard.  Loads differ by one slot at most, and
when a shard is added or removed few slots change hands.

Placement is DataFrame work only: the hash is a built-in expression, and the table (``slots`` rows, a parameter) is broadcast,
so a row is placed by one probe, in the scan, without a shuffle; a hot source, key or text has no effect.  The table is filled
once from that parameter alone, before any row is read.

The key is hashed as text, so any type works; a null key counts as its own value and goes to one fixed slot.
Repeated rows go to one shard.  Columns of the input stay as they are, also where one is called ``slot`` or ``shard``: the
operator names its two columns by parameters and refuses names that exist.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

#: Production parameters: shards, and slots (a prime of over 100 slots for each shard).
SHARDS, SLOTS = 32, 4001
#: A key's hash is the number in so many leading hexadecimal digits of its MD5.
DIGITS = 12


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:DIGITS], 16)


def preferences(shards: list[str], slots: int) -> list[tuple[int, int]]:
    """(offset, skip) of every shard; they depend on its name alone."""
    return [(_number(f"offset:{s}") % slots, _number(f"skip:{s}") % (slots - 1) + 1) for s in shards]


def fill(shards: list[str], slots: int) -> list[int]:
    """Slot to index of the shard that claimed it."""
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    if not 0 < len(shards) <= slots or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names, and a slot each")
    order, table, asked = preferences(shards, slots), [-1] * slots, [0] * len(shards)
    for turn in range(slots):
        shard = turn % len(shards)
        offset, skip = order[shard]
        while table[(offset + asked[shard] * skip) % slots] >= 0:
            asked[shard] += 1
        table[(offset + asked[shard] * skip) % slots] = shard
    return table


def slot_of(key: Column, slots: int) -> Column:
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("bigint") % F.lit(slots)


def lookup_table(spark: SparkSession, shards: list[str], slots: int) -> DataFrame:
    """``slot`` and ``shard``, one row for each slot, from one constant expression."""
    owners = ",".join(map(str, fill(shards, slots)))
    return spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "shard")).selectExpr("cast(slot as bigint) slot", "cast(shard as int) shard")


def place(
    df: DataFrame, key: str = "doc_id", shards: list[str] | int = SHARDS, slots: int = SLOTS, slot: str = "slot", shard: str = "shard"
) -> DataFrame:
    """``df`` with the slot of ``key`` and the index of its shard."""
    if {slot.lower(), shard.lower()} & {c.lower() for c in df.columns}:
        raise ValueError("choose names for slot and shard that the input doesn't have")
    names = [f"shard-{i}" for i in range(shards)] if isinstance(shards, int) else shards
    table = lookup_table(df.sparkSession, names, slots).withColumnsRenamed({"slot": slot, "shard": shard})
    return df.withColumn(slot, slot_of(F.col(key), slots)).join(F.broadcast(table), slot).select(*map(_quoted, [*df.columns, slot, shard]))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def write_shards(df: DataFrame, folder: str, key: str = "doc_id", shards: list[str] | int = SHARDS, slots: int = SLOTS) -> None:
    """One folder ``shard=i`` for each shard.  Rows aren't moved: every task writes to the shards it has rows of."""
    place(df, key, shards, slots, "slot", "shard").drop("slot").write.partitionBy("shard").parquet(folder)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document, with the length of its text."""
    docs = documents(spark, sf_dir).select("doc_id", "source", F.length("text").cast("bigint").alias("text_chars"))
    return place(docs).withColumn("shard", F.col("shard").cast("bigint"))


def _sql() -> str:
    """The same in SQL: a recursive query takes the turns one by one."""
    of = lambda kind: f"('0x' || substr(md5('{kind}:shard-' || i), 1, {DIGITS}))::BIGINT"
    return f"""
WITH RECURSIVE prefs AS (
  SELECT i, {of("offset")} % {SLOTS} AS off, {of("skip")} % {SLOTS - 1} + 1 AS skip FROM range({SHARDS}) t(i)
), orders AS (
  SELECT i, list((off + j * skip) % {SLOTS} ORDER BY j) AS pref FROM prefs, range({SLOTS}) r(j) GROUP BY i
), turns AS (
  SELECT 0 AS turn, [false FOR x IN range({SLOTS})] AS taken, -1::BIGINT AS slot, -1::BIGINT AS shard
  UNION ALL
  SELECT turn + 1, taken[:pick] || [true] || taken[pick + 2:], pick, i FROM (
    SELECT turn, taken, o.i, list_filter(o.pref, lambda p: NOT taken[p + 1])[1] AS pick
    FROM turns JOIN orders o ON o.i = turn % {SHARDS} WHERE turn < {SLOTS}
  )
)
SELECT d.doc_id, d.source, length(d.text) AS text_chars, t.slot, t.shard
FROM documents d JOIN (SELECT slot, shard FROM turns WHERE turn > 0) t
  ON t.slot = ('0x' || substr(md5(coalesce('k' || d.doc_id, 'null')), 1, {DIGITS}))::BIGINT % {SLOTS}
"""


ORACLE_SQL = _sql()
