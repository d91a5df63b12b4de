"""Error rows: one layout for every check, and the cap on how many are logged."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("error_kind", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("raw_value", T.StringType()),
        T.StructField("error_count", T.LongType()),
    ]
)
ERROR_COLUMNS = ERROR_SCHEMA.fieldNames()

# Error kinds.
EMPTY_DATE, INVALID_DATE = "EMPTY_DATE", "INVALID_DATE"
REJECT, ICT_DRIVEN, LOG_ONLY = "REJECT", "ICT_DRIVEN", "LOG_ONLY"
ABORT, LINE_REJECT = "ICT_DRIVEN_ABORT", "ICT_DRIVEN_LINE_REJECT"
NULL_VALUE, TYPE_MISMATCH = "NULL_VALUE", "TYPE MISMATCH"
FILE_EMPTY, DUPLICATE_KEY = "FILE_EMPTY", "DUPLICATE_KEY"
# A nullable column whose text could not be typed: counted, never logged.
NULLED = "NULLED"

CAP_SALTS = 32


def error_row(
    table: str | Column,
    filename: Column,
    column: str | Column,
    kind: str | Column,
    message: Column | None = None,
    raw: Column | None = None,
    count: Column | None = None,
) -> list[Column]:
    """Projection of one error row in the common layout."""
    as_col = lambda v: F.lit(v) if isinstance(v, str) else v
    kind_col = as_col(kind)
    return [
        as_col(table).alias("table_name"),
        filename.alias("filename"),
        as_col(column).alias("column_name"),
        kind_col.alias("error_kind"),
        (message if message is not None else kind_col).alias("error_message"),
        (raw if raw is not None else F.lit(None)).cast("string").alias("raw_value"),
        (count if count is not None else F.lit(1)).cast("long").alias("error_count"),
    ]


def null_message(column: Column) -> Column:
    return F.concat(F.lit("NULL_VALUE: Column '"), column, F.lit("' does not allow null"))


def union_errors(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [f.select(*ERROR_COLUMNS) for f in frames])


def cap(errors: DataFrame, limit: int | None, group: list[str], order: list[str]) -> DataFrame:
    """First ``limit`` rows of every group in ``order``; ``None`` keeps all.

    A group can be huge (every line of a big file can fail the same way), so it is ranked twice: in
    salted slices first, then over what the slices kept. Each slice is pre-limited on the map side.
    The first rows overall are among the first rows of their slices, so the result is exact.
    """
    if limit is None:
        return errors
    salt = F.pmod(F.xxhash64(*order), F.lit(CAP_SALTS))
    sliced = errors.withColumn("_salt", salt)
    for keys in ([*group, "_salt"], group):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        sliced = sliced.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")
    return sliced.drop("_salt")
