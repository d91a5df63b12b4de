"""Lines of the files inside ZIP archives.

The one place where Python runs on executors: Spark has no reader for ZIP. Archives are spread over
tasks by Spark; one task streams the entries of its archives as lines, batch by batch, so an entry is
never held in memory whole. A broken archive becomes a row with an error, not a failed job.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.filenames import archive_feed, base_name

LINES = "path string, entry string, line_no long, line string, error string"
BATCH = 20_000


def is_data_entry(name: str) -> bool:
    return not (name.startswith(("__MACOSX", ".")) or name.endswith("/"))


def _entry_lines(path: str, content: bytes, charset: str) -> Iterator[tuple]:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            entries = [n for n in archive.namelist() if is_data_entry(n)]
            if not entries:
                yield path, None, None, None, "No valid files in ZIP"
            # A fault anywhere makes the whole archive invalid, so it is looked for before any line.
            if broken := archive.testzip():
                raise zipfile.BadZipFile(f"entry {broken} is damaged")
            for name in entries:
                archive.read(name).decode(charset)
            for name in entries:
                with archive.open(name) as raw:
                    text = io.TextIOWrapper(raw, encoding=charset, newline=None)
                    for number, line in enumerate(text, start=1):
                        yield path, name, number, line.rstrip("\n"), None
    except (zipfile.BadZipFile, UnicodeDecodeError, OSError, EOFError, zlib.error) as problem:
        yield path, None, None, None, f"Invalid ZIP file: {problem}"


def expand(archives: DataFrame, charset: str = "UTF-8") -> DataFrame:
    """One row per line from a frame with ``path`` and ``content``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["path", "entry", "line_no", "line", "error"]
        pending: list[tuple] = []
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                for row in _entry_lines(path, content, charset):
                    pending.append(row)
                    if len(pending) == BATCH:
                        yield _frame(pending, names)
                        pending = []
        if pending:
            yield _frame(pending, names)

    lines = archives.select("path", "content").mapInPandas(run, LINES)
    return lines.withColumns(
        {"archive": base_name(F.col("path")), "feed": archive_feed(F.col("path"))}
    )


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    frame["line_no"] = frame["line_no"].astype("Int64")
    return frame


def read_archives(spark: SparkSession, path: str, charset: str = "UTF-8") -> DataFrame:
    """Lines of every archive below a folder. One archive must fit a task (a row is below 2 GB)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return expand(files.option("pathGlobFilter", "*.zip").load(path), charset)


def parse_lines(lines: DataFrame, schema: T.StructType, sep: str = ",", skip_first: bool = True) -> DataFrame:
    """Delimited lines of :func:`expand` as string columns, errors left out."""
    good = lines.where(F.col("error").isNull())
    if skip_first:
        good = good.where(F.col("line_no") > 1)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parsed = F.from_csv("line", ddl, {"sep": sep, "mode": "PERMISSIVE"})
    return good.select("archive", "feed", "entry", "line_no", parsed.alias("r")).select(
        "archive", "feed", "entry", "line_no", "r.*"
    )
