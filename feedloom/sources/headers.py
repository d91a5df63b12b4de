"""Deliveries of one feed that bring headers of their own.

Every file's first line says which columns it holds, in which order. A catalogue of these lines, one row
per file, sorts the files into groups of equal headers, of which there are few. The files are then read
in one scan, line by line, and each line is parsed with the names of its group into the columns of the
feed; columns a file does not have are NULL, and are told per file. The catalogue costs a pass over the
files that splits lines and parses nothing. Where all files share a header, nothing is joined.

Lines are told apart by line breaks alone, so quoted values that hold line breaks need the other scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.columns import first_spellings
from feedloom.sources.delimited import BLOCK, CORRUPT, FILE, PATH, POSITION, ROW, csv_options, position_columns
from feedloom.specs import NAMES, FeedSpec

#: A separator that texts do not hold; a line that does is taken from the corrupt lines.
NO_SEPARATOR = "\x01"
MOST_HEADERS = 1000  # different headers of one load; their names are kept by the driver


@dataclass
class Deliveries:
    """``rows``: columns of the feed as text with corrupt lines and positions. ``gaps``: ``file_name,
    column_name`` of every column a file does not have, ``None`` where no file lacks any."""

    rows: DataFrame
    gaps: DataFrame | None


def applies(spec: FeedSpec) -> bool:
    return spec.header == NAMES and not spec.imposed and spec.input_format in ("csv", "csv_quote", "csv_deprecated")


def lines(spark: SparkSession, path: str | list[str], spec: FeedSpec, header: bool, accept: Column | None) -> DataFrame:
    """``_line`` and where it came from; with ``header`` without the first line of every file."""
    reader = spark.read.schema(f"_line string, {CORRUPT} string").options(
        sep=NO_SEPARATOR, quote="", escape="", encoding=spec.charset, mode="PERMISSIVE", columnPruning="false",
        columnNameOfCorruptRecord=CORRUPT, header=str(header).lower(), recursiveFileLookup="true",
    )
    rows = reader.csv(path)
    if accept is not None:
        rows = rows.where(accept)
    return rows.select(F.coalesce(CORRUPT, "_line").alias("_line"), *position_columns())


def first_lines(spark: SparkSession, path: str | list[str], spec: FeedSpec, accept: Column | None) -> DataFrame:
    """``_path, _file, _header`` of every file that has a line."""
    begin = lines(spark, path, spec, False, accept).where(F.col(BLOCK) == 0)
    return begin.groupBy(PATH, FILE).agg(F.min_by("_line", ROW).alias("_header"))


def names_of(spark: SparkSession, headers: list[str], spec: FeedSpec) -> list[list[str]]:
    """Column names of every header, by the reader's own rules for quotes; an unnamed one is ``_c`` and its place."""
    options = _line_options(spec)
    width = [h.count(spec.delimiter) + 1 for h in headers]
    parsed = [
        F.from_csv(F.lit(h), ", ".join(f"_p{i} string" for i in range(n)), options).alias(f"h{k}")
        for k, (h, n) in enumerate(zip(headers, width, strict=True))
    ]
    out = []
    for header, found in zip(headers, spark.range(1).select(*parsed).first(), strict=True):
        names = list(found)
        # A separator within quotes made the width too large.
        while len(names) > 1 and names[-1] is None and '"' in header:
            names.pop()
        out.append([f"_c{i}" if n is None else n for i, n in enumerate(names)])
    return out


def scan(
    spark: SparkSession, path: str | list[str], spec: FeedSpec, accept: Column | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, label: df,
) -> Deliveries:
    """All accepted files in one scan, each by its own header. ``keep`` may write the catalogue once."""
    catalogue = keep(first_lines(spark, path, spec, accept), f"headers-{spec.table}")
    headers = sorted(r["_header"] for r in catalogue.select("_header").distinct().limit(MOST_HEADERS + 1).collect())
    if len(headers) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers")
    groups = [dict((n, i) for i, n in first_spellings(names)) for names in names_of(spark, headers, spec)]
    wide = [len(h) for h in names_of(spark, headers, spec)]
    columns = spec.columns or list(dict.fromkeys(n for g in groups for n in g))

    rows = lines(spark, path, spec, True, accept)
    parsed = [_parsed(columns, g, n, spec) for g, n in zip(groups, wide, strict=True)]
    if len(groups) < 2:
        rows = rows.withColumn("_v", parsed[0] if parsed else F.lit(None).cast(_layout(columns)))
    else:
        number = spark.createDataFrame(list(enumerate(headers)), "_group int, _header string")
        grouped = catalogue.join(number, "_header").select(PATH, "_group")
        value = F.when(F.col("_group") == 0, parsed[0])
        for k, p in enumerate(parsed[1:], 1):
            value = value.when(F.col("_group") == k, p)
        rows = rows.join(grouped, PATH).withColumn("_v", value)
    rows = rows.select(*[F.col("_v")[f"_{i}"].alias(c) for i, c in enumerate(columns)], F.col("_v")[CORRUPT].alias(CORRUPT), *POSITION)

    lacking = {h: [c for c in columns if c not in g] for h, g in zip(headers, groups, strict=True)}
    short = [(h, c) for h, missing in lacking.items() for c in missing]
    if not short:
        return Deliveries(rows, None)
    gaps = catalogue.join(spark.createDataFrame(short, "_header string, column_name string"), "_header")
    return Deliveries(rows, gaps.select(F.col(FILE).alias("file_name"), "column_name").distinct())


def _line_options(spec: FeedSpec) -> dict[str, str]:
    return {k: v for k, v in csv_options(spec).items() if k not in ("encoding", "columnPruning", "inferSchema", "multiLine")}


def _layout(columns: list[str]) -> str:
    return "struct<" + ", ".join([*[f"_{i}: string" for i in range(len(columns))], f"{CORRUPT}: string"]) + ">"


def _parsed(columns: list[str], places: dict[str, int], width: int, spec: FeedSpec) -> Column:
    """The columns of the feed from a line of a group: by name, wherever the group has them."""
    schema = ", ".join([*[f"_p{i} string" for i in range(width)], f"{CORRUPT} string"])
    found = F.from_csv(F.col("_line"), schema, _line_options(spec))
    # One evaluation per line, whatever is taken from it.
    fields = lambda v: F.struct(
        *[(v[f"_p{places[c]}"] if c in places else F.lit(None).cast("string")).alias(f"_{i}") for i, c in enumerate(columns)],
        v[CORRUPT].alias(CORRUPT),
    )
    return F.transform(F.array(found), fields)[0]
