"""Column-set operators: presence, alignment, trimming, duplicates, metadata stamps."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

META_FIRST = ("FILE_NAME_RECEIVED", "FILE_PROCESS_DATE")
DATE_PARTS = ("yyyy", "mm", "dd")


def first_spellings(names: Sequence[str]) -> list[tuple[int, str]]:
    """Positions and names left after dropping later case-insensitive duplicates."""
    seen: dict[str, int] = {}
    for i, n in enumerate(names):
        seen.setdefault(n.lower(), i)
    return [(i, names[i]) for i in seen.values()]


def dedup_columns(df: DataFrame) -> DataFrame:
    """First of every group of columns whose names differ only in case."""
    kept = first_spellings(df.columns)
    unique = df.toDF(*[f"_p{i}" for i in range(len(df.columns))])
    return unique.select(*[F.col(f"_p{i}").alias(n) for i, n in kept])


def missing_columns(df: DataFrame, expected: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in expected if c not in present]


def missing_column_errors(
    files: DataFrame, missing: Sequence[str], table: str, lenient: bool = False
) -> DataFrame:
    """One row per file and missing column; ``files`` has a column ``file_name``."""
    column = F.explode(F.array(*[F.lit(m) for m in missing]).cast("array<string>"))
    return gap_errors(files.select("file_name", column.alias("column_name")), table, lenient)


def gap_errors(gaps: DataFrame, table: str, lenient: bool = False) -> DataFrame:
    """One row per row of ``gaps`` (``file_name``, ``column_name``): columns a file does not have."""
    kind = "INFO_MISSING_COLUMN" if lenient else "MISSING_COLUMN"
    rows = gaps.select(F.lit(table).alias("table_name"), F.col("file_name").alias("filename"), "column_name")
    message = (
        F.concat(F.lit("Column '"), F.col("column_name"),
                 F.lit("' not present in source CSV, added with NULL"))
        if lenient
        else F.lit(kind)
    )
    return rows.select(
        "*",
        F.lit(kind).alias("error_kind"),
        message.alias("error_message"),
        F.lit(None).cast("string").alias("raw_value"),
        F.lit(1).cast("long").alias("error_count"),
    )


def align_to_string(df: DataFrame, expected: Sequence[str], trim: bool = False) -> DataFrame:
    """Expected columns as strings (NULL where absent), other columns untouched, one projection."""
    wanted, present = set(expected), set(df.columns)
    clean = (lambda c: F.trim(c)) if trim else (lambda c: c)
    out: list[Column] = [
        clean(F.col(c).cast("string")).alias(c) if c in wanted else F.col(c) for c in df.columns
    ]
    out += [F.lit(None).cast("string").alias(c) for c in expected if c not in present]
    return df.select(*out)


def trim_all(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    chosen = set(columns if columns is not None else df.columns)
    return df.select(*[F.trim(c).alias(c) if c in chosen else F.col(c) for c in df.columns])


def metadata_first(df: DataFrame) -> DataFrame:
    lead = [c for c in META_FIRST if c in df.columns]
    return df.select(*lead, *[c for c in df.columns if c not in lead])


def stamp(
    df: DataFrame,
    name: Column | None = None,
    processed: Column | None = None,
    parts: dict[str, Column] | None = None,
    today: Column | None = None,
) -> DataFrame:
    """Source file, process time and date parts; metadata columns lead, date parts close the row."""
    day = today if today is not None else F.current_date()
    fallback = {"yyyy": F.year(day), "mm": F.month(day), "dd": F.dayofmonth(day)}
    added: dict[str, Column] = {}
    if processed is not None:
        added["FILE_PROCESS_DATE"] = processed
    if name is not None:
        added["FILE_NAME_RECEIVED"] = name
    for part in DATE_PARTS:
        given = (parts or {}).get(part)
        value = fallback[part] if given is None else F.coalesce(given, fallback[part])
        added[part] = value.cast("int")
    business = [c for c in df.columns if c not in added]
    lead = [added[c].alias(c) for c in META_FIRST if c in added]
    return df.select(*lead, *business, *[added[p].alias(p) for p in DATE_PARTS])
