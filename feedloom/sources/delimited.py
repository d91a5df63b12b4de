"""Delimited text as string columns, with corrupt lines kept aside.

Everything is read as text: typing happens later, so a bad value is judged by the field's policy
instead of silently becoming NULL in the reader. Column pruning is off for these scans because a
pruned CSV parser no longer notices lines with too few or too many values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.filenames import received_name
from feedloom.operators.columns import first_spellings
from feedloom.specs import NAMES, POSITIONAL, SKIP_POSITIONAL, FeedSpec

CORRUPT = "_corrupt_record"
FILE, PATH, BLOCK, ROW = "_file", "_path", "_block", "_row"
POSITION = (FILE, PATH, BLOCK, ROW)


def csv_options(spec: FeedSpec) -> dict[str, str]:
    options = {
        "sep": spec.delimiter,
        "encoding": spec.charset,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "columnPruning": "false",
        "inferSchema": "false",
    }
    if spec.input_format in ("csv_quote", "csv_quote_ml"):
        options.update(quote='"', escape="\\")
    if spec.input_format == "csv_quote_ml":
        options["multiLine"] = "true"
    return options


def read_csv(reader: DataFrameReader, names: Sequence[str], path: str | list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    return reader.schema(schema).csv(path)


def first_line(spark: SparkSession, spec: FeedSpec, path: str | list[str], name: Column | None) -> list[str]:
    """Values of one first line: enough to learn names or the number of columns."""
    lines = spark.read.options(**csv_options(spec)).option("recursiveFileLookup", "true")
    rows = lines.option("header", "false").csv(path)
    if name is not None:
        rows = rows.where(name)
    row = rows.head(1)
    return list(row[0]) if row else []


def scan(
    spark: SparkSession,
    path: str | list[str],
    spec: FeedSpec,
    accept: Column | None = None,
) -> DataFrame:
    """All accepted deliveries under ``path`` in one scan.

    ``accept`` is a condition on ``_metadata``; Spark applies it to the file listing, so files of
    other feeds are never opened. Besides the source columns the result has the corrupt line and
    where a row came from (``_file``, ``_path``, ``_block``, ``_row``).
    """
    if spec.input_format == "fixed":
        raise ValueError("use fixed_width.scan for fixed-width files")
    reader = spark.read.options(**csv_options(spec)).option("recursiveFileLookup", "true")
    reader = reader.option("header", "false" if spec.header == POSITIONAL else "true")

    names, checked = spec.columns, spec.header == NAMES
    if not (spec.imposed and names):
        found = first_line(spark, spec, path, accept)
        if spec.header == NAMES:
            names = [n if n is not None else f"_c{i}" for i, n in enumerate(found)]
        elif spec.header == SKIP_POSITIONAL and len(found) != len(names):
            raise ValueError(f"expected {len(names)} columns but found {len(found)}")
        elif len(found) != len(names):
            names = [f"_c{i}" for i in range(len(found))]

    kept = first_spellings(names)
    unique = names if len(kept) == len(names) else [f"_p{i}" for i in range(len(names))]
    reader = reader.option("enforceSchema", str(not (checked and unique is names)).lower())
    rows = read_csv(reader, unique, path)
    if accept is not None:
        rows = rows.where(accept)
    return rows.select(
        *[F.col(f"`{unique[i]}`").alias(n) for i, n in kept],
        corrupt_line(F.col(f"`{unique[0]}`")).alias(CORRUPT),
        *position_columns(),
    )


def corrupt_line(anchor: Column) -> Column:
    """The corrupt line, tied to a source column: Spark refuses scans of that column alone."""
    line = F.col(CORRUPT)
    return F.coalesce(line, F.when(line.isNotNull(), anchor))


def position_columns() -> list[Column]:
    path = F.col("_metadata.file_path")
    return [
        received_name(path).alias(FILE),
        path.alias(PATH),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(ROW),
    ]


def lower_names(df: DataFrame) -> DataFrame:
    """Source columns with lower-case names; internal columns (leading ``_``) stay."""
    return df.toDF(*[c if c.startswith("_") else c.lower() for c in df.columns])
