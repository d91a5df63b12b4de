"""File discovery, name validation and the match of files with feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.filenames import (
    base_name,
    feed_of,
    folder_name,
    name_parts,
    name_regex,
    received_name,
)
from feedloom.specs import FIRST, MERGE

MISSING_DATE = "Missing date pattern"


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Non-empty files below a folder: path, delivery name, bytes. File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        files = files.option("pathGlobFilter", glob)
    where = F.col("path")
    return files.load(path).select(
        "path",
        received_name(where).alias("file_name"),
        folder_name(where).alias("folder"),
        F.col("length").alias("bytes"),
    )


def empty_files(spark: SparkSession, path: str) -> DataFrame:
    """Names of delivered files without any byte."""
    names = spark.read.option("recursiveFileLookup", "true").text(path).inputFiles()
    listed = spark.createDataFrame([(n,) for n in names], "path string").select(
        received_name(F.col("path")).alias("file_name")
    )
    filled = list_files(spark, path).select("file_name")
    return listed.distinct().join(filled.distinct(), "file_name", "left_anti")


def match_pattern(files: DataFrame, pattern: str, name: str = "file_name") -> DataFrame:
    return files.where(F.col(name).rlike(name_regex(pattern)))


def rejection(name: Column) -> Column:
    """Why a file name is refused, NULL when it is fine."""
    part = name_parts(name)
    y, m, d = part["yyyy"], part["mm"], part["dd"]
    real = F.try_make_timestamp(y, m, d, F.lit(0), F.lit(0), F.lit(0)).isNotNull()
    # Wording of the reasons.
    reason = (
        F.when((y == 0) | (m == 0), F.lit("Missing year or month"))
        .when(~y.between(1900, 2100), F.concat(F.lit("Year "), y, F.lit(" out of range")))
        .when(~m.between(1, 12), F.concat(F.lit("Month "), m, F.lit(" invalid")))
        .when(~d.between(1, 31), F.concat(F.lit("Day "), d, F.lit(" invalid")))
        .when(~real, F.lit("day is out of range for month"))
    )
    return F.when(y.isNull(), F.lit(MISSING_DATE)).otherwise(
        F.concat(F.lit("Invalid date: "), reason)
    )


def rejected_date(name: Column) -> Column:
    """The date text of a refused name, ``N/A`` without year or month, NULL without any date."""
    part = name_parts(name)
    y, m, d = part["yyyy"], part["mm"], part["dd"]
    shown = F.concat(
        y, F.lit("-"), F.lpad(m.cast("string"), 2, "0"), F.lit("-"), F.lpad(d.cast("string"), 2, "0")
    )
    return F.when(y.isNull(), None).when((y == 0) | (m == 0), F.lit("N/A")).otherwise(shown)


def run_log_reason(name: Column) -> Column:
    """The shorter reason kept in the execution log for a refused name."""
    part = name_parts(name)
    m, d = part["mm"], part["dd"]
    # Wording of the reasons.
    return (
        F.when(part["yyyy"].isNull(), F.lit("Invalid filename format"))
        .when(~m.between(1, 12), F.concat(F.lit("Invalid date: Month "), m, F.lit(" invalid")))
        .when(~d.between(1, 31), F.concat(F.lit("Invalid date: Day "), d, F.lit(" invalid")))
        .otherwise(F.lit("Validation failed: Invalid filename"))
    )


def check_names(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Adds ``reason`` (NULL = accepted) and ``invalid_value``."""
    return files.withColumns(
        {"reason": rejection(F.col(name)), "invalid_value": rejected_date(F.col(name))}
    )


def choose(files: DataFrame, policy: str, name: str = "file_name") -> DataFrame:
    """Files a feed loads: the first by name, or all of them."""
    if policy != FIRST:
        return files
    return files.where(F.col(name) == files.agg(F.min(name)).scalar())


def load_units(files: DataFrame, policy: str, name: str = "file_name") -> DataFrame:
    """Adds ``unit``: what is judged and logged together (a file, or the merged files)."""
    if policy != MERGE:
        return files.withColumn("unit", F.col(name))
    n = F.count_distinct(name)
    label = F.when(n > 1, F.concat(F.lit("merged_"), n, F.lit("_files"))).otherwise(F.min(name))
    return files.withColumn("unit", files.agg(label).scalar())


def by_feed(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Discovered CSV files by feed, hidden ones left out."""
    shown = files.where(
        ~base_name(F.col(name)).startswith(".") & F.lower(F.col(name)).endswith(".csv")
    )
    return shown.groupBy(feed_of(F.col(name)).alias("feed")).agg(
        F.count_distinct(name).alias("files"), F.count_distinct("folder").alias("folders")
    )


def by_folder(files: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """One folder per table; expected folders without a file are reported as NO_DATA."""
    found = files.groupBy("folder").agg(
        F.count_distinct("file_name").alias("files"), F.sum("bytes").alias("bytes")
    )
    if expected is not None:
        found = expected.select("folder").distinct().join(found, "folder", "left")
    filled = F.coalesce(F.col("files"), F.lit(0)) > 0
    return found.select(
        "folder",
        F.coalesce("files", F.lit(0)).cast("long").alias("files"),
        F.when(filled, F.lit("SUCCESS")).otherwise(F.lit("NO_DATA")).alias("status"),
    )


def match_config(names: DataFrame, config: DataFrame, how: str = "prefix") -> DataFrame:
    """The configured table of every discovered name.

    ``names(name)``, ``config(table_name, position)``. An exact match wins, then the first configured
    table that is a prefix of the name or has it as a prefix (``how="prefix"``), or the same with
    substrings (``how="substring"``). Instead of comparing every name with every table, both sides
    are expanded into their own pieces and joined on equality.
    """
    left = names.select(F.lower("name").alias("name")).distinct()
    right = config.select("table_name", "position", F.lower("table_name").alias("_key"))
    pieces = _prefixes if how == "prefix" else _substrings
    inside = (
        left.select("name", F.explode(F.array_distinct(pieces(F.col("name")))).alias("_piece"))
        .join(right.withColumnRenamed("_key", "_piece"), "_piece")
        .select("name", "table_name", "position", (F.col("_piece") != F.col("name")).alias("_partial"))
    )
    around = (
        right.select(
            "table_name", "position", F.explode(F.array_distinct(pieces(F.col("_key")))).alias("name")
        )
        .join(left, "name")
        .select("name", "table_name", "position", F.lit(True).alias("_partial"))
    )
    best = inside.unionByName(around).groupBy("name").agg(
        F.min(F.struct("_partial", "position", "table_name")).alias("_best")
    )
    return left.join(best, "name", "left").select(
        "name",
        F.col("_best.table_name").alias("table_name"),
        F.when(F.col("_best").isNull(), F.lit("default"))
        .when(F.col("_best._partial"), F.lit("partial"))
        .otherwise(F.lit("exact"))
        .alias("match"),
    )


def _prefixes(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda n: F.substring(text, F.lit(1), n))


def _substrings(text: Column) -> Column:
    starts = F.sequence(F.lit(1), F.length(text))
    return F.flatten(
        F.transform(
            starts,
            lambda s: F.transform(
                F.sequence(F.lit(1), F.length(text) - s + 1), lambda n: F.substring(text, s, n)
            ),
        )
    )
