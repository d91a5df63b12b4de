"""Checks over accepted rows: empty units, duplicate keys, line numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators import errors as E

# Columns that do not count as data.
NOT_DATA = ("line_id", "yyyy", "mm", "dd", "FILE_PROCESS_DATE", "FILE_NAME_RECEIVED")


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NOT_DATA and not c.startswith("_")]


def filled_rows(df: DataFrame, unit: str, columns: Sequence[str]) -> DataFrame:
    """Rows per unit, and how many have a value in any data column. One aggregate for all columns."""
    some = reduce(Column.__or__, [F.col(c).isNotNull() for c in columns])
    return df.groupBy(unit).agg(F.count(F.lit(1)).alias("rows"), F.count_if(some).alias("filled"))


def empty_units(units: DataFrame, accepted: DataFrame, unit: str, columns: Sequence[str], table: str) -> DataFrame:
    """FILE_EMPTY for every listed unit without an accepted row holding data."""
    filled = filled_rows(accepted, unit, columns).where(F.col("filled") > 0)
    return (
        units.select(unit)
        .join(filled.select(unit), unit, "left_anti")
        .select(*E.error_row(table, F.col(unit), "ALL_COLUMNS", E.FILE_EMPTY))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], table: str, unit: str) -> DataFrame:
    """Key values found more than once in a unit; NULLs count as equal, unknown keys are ignored."""
    known = [k for k in keys if k in df.columns]
    if not known:
        return df.where(F.lit(False)).select(*E.error_row(table, F.col(unit), "", E.DUPLICATE_KEY))
    found = df.groupBy(unit, *known).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return found.select(
        *E.error_row(table, F.col(unit), ",".join(known), E.DUPLICATE_KEY, count=F.col("_n"))
    )


def number_lines(
    df: DataFrame, file: str = "_file", path: str = "_path", block: str = "_block", row: str = "_row"
) -> DataFrame:
    """Dense line numbers (``line_id`` from 1) per delivery, without sorting the rows.

    A block of a file is read in order by one task, so a row's place in its block is the distance
    of its row id to the block's smallest one. Blocks are numbered by a running sum over the list of
    blocks, which is small; rows are never gathered by file.
    """
    here = [file, path, block]
    blocks = df.groupBy(*here).agg(F.min(row).alias("_first"), F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(file).orderBy(path, block).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = blocks.withColumn("_offset", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    numbered = df.join(offsets.drop("_size"), here)
    return numbered.withColumn(
        "line_id", F.col("_offset") + F.col(row) - F.col("_first") + 1
    ).drop("_offset", "_first")
