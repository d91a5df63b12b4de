"""A sort key that keeps rows close which are close in every one of several columns.

Each column's values become ranks among its own quantiles, and the bits of the ranks are interleaved, so
a range of the key is a small box in all columns. Files written in that order have narrow minima and
maxima for each column, where a plain sort has them for its first column only.

Quantiles come from one approximate aggregate over all columns: at most ``2 ** BITS - 1`` numbers a column
reach the driver at any size of the table. Frequent values take several quantiles and share one rank.

Defined results: NULLs have the lowest rank; texts are ranked by their first seven bytes, so texts equal
in these share a rank; columns of other types (arrays, maps, structs, binary) are ranked by the hash of
their value, which groups equal ones; a table without rows gets no key but zero. The key orders rows
and nothing else, so an approximate quantile can make files wider, never results wrong.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 8  # of a rank: 256 quantiles
KEY_BITS = 62
ACCURACY = 10_000


def as_number(df: DataFrame, column: str) -> Column:
    """A number in the order of the column, as far as one can hold it."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(value.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return value.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(value.cast("timestamp"), F.current_timezone())).cast("double")
    return F.when(value.isNotNull(), F.xxhash64(value.cast("string"))).cast("double")


def rank(value: Column, bounds: Sequence[float], bits: int) -> Column:
    """How many of the ``2 ** bits - 1`` sorted bounds a value reaches, found by halving."""
    known = F.array(*map(F.lit, bounds))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(bits))])
    found = F.aggregate(
        steps, F.lit(0), lambda at, step: at + F.when(value >= F.element_at(known, at + step), step).otherwise(0)
    )
    return found.cast("long")


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """The bits of the ranks, highest first, one of each column in turn."""
    n = len(ranks)
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for j, value in enumerate(ranks):
            one = F.shiftright(value, bit).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(one, bit * n + n - 1 - j))
    return key


def with_curve_key(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """``df`` with the key of ``columns`` added; at most 62 columns."""
    bits = min(BITS, KEY_BITS // len(columns))
    if bits < 1:
        raise ValueError(f"at most {KEY_BITS} columns can be interleaved, got {len(columns)}")
    shares = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    numbers = [as_number(df, c) for c in columns]
    quantiles = df.agg(*[F.percentile_approx(v, shares, ACCURACY).alias(f"q{i}") for i, v in enumerate(numbers)]).first()
    ranks = [f"{key}_{i}" for i in range(len(columns))]
    ranked = df.withColumns({
        # A column of NULLs alone has no quantiles and one rank.
        name: rank(v, q, bits) if q else F.lit(0).cast("long")
        for name, v, q in zip(ranks, numbers, quantiles, strict=True)
    })
    return ranked.withColumn(key, interleaved([F.col(r) for r in ranks], bits)).drop(*ranks)
