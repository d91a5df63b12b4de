"""Which dates of a table may hold a key: bitmaps of key hashes, written with each load.

Every date of a load has a Bloom filter cut into blocks of one bitmap (Spark's 4 KB), as many as its keys
ask for, a power of two. A key belongs to one block and sets ``PROBES`` bits in it. A batch of few keys
meets each filter in one block per key, so a merge opens the key columns of the dates that may hold one of
its keys, and nothing of the others. A key that is there is always found; a date is opened in vain with
probability below 1e-4 per key of the batch.

Hashes depend on types, so the filters are used only where names and types of the keys are those of the
batch. Floating-point keys, which have more than one zero, have no filters.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.merge import all_set

BITS = 32_768  # Fixed value: bits of one of Spark's bitmaps.
BLOCK_KEYS = 1024  # keys a block holds on average, at most
PROBES = 6
MOST_ASKED = 100_000  # keys of a batch beyond which nearly every date is touched anyway
SCHEMA = "date int, blocks long, block long, bits binary"


def signature(schema: T.StructType, keys: Sequence[str]) -> list[list[str]] | None:
    """Names and types of the keys, ``None`` where they cannot have filters."""
    if not keys or not set(keys) <= set(schema.names):
        return None
    types = [schema[k].dataType for k in keys]
    plain = (T.StringType, T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.BooleanType)
    if not all(isinstance(t, plain) for t in types):
        return None
    return [[k, t.simpleString()] for k, t in zip(keys, types, strict=True)]


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _places(h: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(h, F.lit(i)), F.lit(BITS)) for i in range(PROBES)]


def filters(rows: DataFrame, keys: Sequence[str], date: Column) -> DataFrame:
    """``date, blocks, block, bits`` of the rows; keys with a NULL match nothing and are left out.

    Bits are set before the shuffle, so a date with most of the rows reaches it as a few bitmaps a task.
    """
    keyed = rows.where(all_set(keys)).select(date.cast("int").alias("date"), key_hash(keys).alias("h"))
    wanted = F.ceil(F.log2(F.greatest(F.lit(1.0), F.count(F.lit(1)) / F.lit(BLOCK_KEYS))))
    sizes = keyed.groupBy("date").agg(F.pow(F.lit(2.0), wanted).cast("long").alias("blocks"))
    # The big side is on the left, where a frequent date is split.
    sized = keyed.join(sizes, "date", "left").withColumn("block", F.pmod(F.col("h"), F.col("blocks")))
    bits = sized.select("date", "blocks", "block", F.explode(F.array(*_places(F.col("h")))).alias("place"))
    return bits.groupBy("date", "blocks", "block").agg(F.bitmap_construct_agg("place").alias("bits"))


def _holds(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), place % 8)).cast("int") % 2 == 1


def dates_holding(found: DataFrame, batch: DataFrame, keys: Sequence[str]) -> list[int] | None:
    """Dates whose filters (``found``) may hold a key of the batch, ``None`` where it has too many keys to
    ask for each."""
    asked = batch.where(all_set(keys)).select(key_hash(keys).alias("h")).distinct()
    if asked.limit(MOST_ASKED + 1).count() > MOST_ASKED:
        return None
    # Powers of two, so a few dozen at most.
    sizes = [r["blocks"] for r in found.select("blocks").distinct().collect()]
    if not sizes:
        return []
    each = asked.select("h", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])).alias("blocks"))
    each = each.withColumn("block", F.pmod(F.col("h"), F.col("blocks")))
    met = found.join(each, ["blocks", "block"])
    all_there = reduce(Column.__and__, [_holds(F.col("bits"), p) for p in _places(F.col("h"))])
    return sorted(r["date"] for r in met.where(all_there).select("date").distinct().collect())
