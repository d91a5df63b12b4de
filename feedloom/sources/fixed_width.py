"""Fixed-width text cut into string columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.sources.delimited import CORRUPT, position_columns
from feedloom.specs import FeedSpec


def cut(line: Column, widths: Iterable[tuple[str, int]]) -> list[Column]:
    """Consecutive slices of a line."""
    out, start = [], 1
    for name, size in widths:
        out.append(F.substring(line, start, size).alias(name))
        start += size
    return out


def scan(
    spark: SparkSession, path: str | list[str], spec: FeedSpec, accept: Column | None = None
) -> DataFrame:
    """Widths count characters of the feed's charset, in which a line break must be a single byte."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    if accept is not None:
        lines = lines.where(accept)
    plain = spec.charset.upper() in ("UTF-8", "UTF8")
    # The reader keeps the bytes of a line as they are.
    line = F.col("value") if plain else F.decode(F.col("value").cast("binary"), spec.charset)
    return lines.select(
        *cut(line, [(f.name, f.size) for f in spec.fields]),
        F.lit(None).cast("string").alias(CORRUPT),
        *position_columns(),
    )
