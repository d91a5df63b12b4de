"""Incremental load of text files with Structured Streaming.

The file source remembers in its checkpoint which files it has read, so a run picks up only new
ones and a repeated run adds nothing. All runs use ``availableNow``: they take what is there, in
batches of a bounded number of files, and stop.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.filenames import belongs_to, received_name, stream_name_parts
from feedloom.observability.reports import table_inventory
from feedloom.plans.ingest import ingest_rows, reason
from feedloom.sinks.tables import TableStore
from feedloom.sources.delimited import BLOCK, CORRUPT, FILE, PATH, ROW, csv_options, first_line
from feedloom.sources.listing import by_feed, list_files, match_config
from feedloom.specs import NAMES, FeedSpec, FieldSpec

FILES_PER_BATCH = 10_000
STREAM_META = ("FILE_NAME_RECEIVED", "FILE_PATH_RECEIVED", "yyyy", "mm", "dd", "INGESTION_TIMESTAMP")


@dataclass(frozen=True)
class StreamResult:
    status: str
    rows: int
    batches: int
    message: str = ""


def read_stream(
    spark: SparkSession, path: str, spec: FeedSpec, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Stream of one feed's files with lower-case source columns.

    Files of other feeds are left out by a condition on the file name, which Spark applies to the
    listing. Where names come from the header, a file with other names or another order stops the
    stream: its values would end up in the wrong columns.
    """
    names = [c.lower() for c in spec.columns]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    rows = (
        spark.readStream.schema(schema)
        .options(**csv_options(spec))
        .option("quote", '"')
        .option("escape", "\\")
        .option("header", str(spec.header == NAMES).lower())
        .option("enforceSchema", str(spec.header != NAMES).lower())
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(files_per_batch))
        .csv(path)
    )
    return with_metadata(rows.where(belongs_to(received_name(F.col("_metadata.file_path")), spec.table)))


def with_metadata(rows: DataFrame) -> DataFrame:
    """Source file and path, date parts of the name, time of ingestion."""
    path = F.col("_metadata.file_path")
    name = received_name(path)
    return rows.select(
        *rows.columns,
        name.alias("FILE_NAME_RECEIVED"),
        path.alias("FILE_PATH_RECEIVED"),
        *[value.alias(part) for part, value in stream_name_parts(name).items()],
        F.current_timestamp().alias("INGESTION_TIMESTAMP"),
    )


def run_into_staging(stream: DataFrame, target: str, checkpoint: str) -> StreamResult:
    """Append everything new to the staging table; rows are counted after the feed filter."""
    counter = Counter(stream.sparkSession)
    query = (
        stream.observe(counter.name, F.count(F.lit(1)).alias("rows"))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    return counter.wait(query)


def run_batches(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, str], None]
) -> StreamResult:
    """Hand every micro-batch to a batch load, with a load id that is the same on a retry.

    The id is made of the query id, which lives in the checkpoint, and the batch number: another
    checkpoint starts again from number zero but under another id.
    """
    counter = Counter(stream.sparkSession)

    def on_batch(batch: DataFrame, epoch: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("a micro-batch without the id of its query")
        handle(batch, f"{query_id}-{epoch:09d}")

    query = (
        stream.observe(counter.name, F.count(F.lit(1)).alias("rows"))
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return counter.wait(query)


class Counter:
    """Rows a query has let through, summed over its progress reports."""

    def __init__(self, spark: SparkSession) -> None:
        self.name = "feed_rows"
        self.seen: dict[int, int] = {}

    def wait(self, query) -> StreamResult:
        """Reads reports as they come: a query forgets all but its last hundred."""
        while not query.awaitTermination(1):
            self._read(query)
        self._read(query)
        rows = sum(self.seen.values())
        return StreamResult("SUCCESS" if rows else "NO_DATA", rows, len(self.seen))

    def _read(self, query) -> None:
        for progress in query.recentProgress:
            found = (progress["observedMetrics"] or {}).get(self.name)
            if found is not None:
                self.seen[progress["batchId"]] = found["rows"]


def stream_feeds(
    spark: SparkSession, source: str, specs: dict[str, FeedSpec], root: str
) -> dict[str, StreamResult]:
    """Every feed found below ``source`` into its own staging table under ``root``.

    A feed without a configuration is read with the names of its header. The loop runs over feeds,
    of which there are as many as configured tables; each stream is spread by Spark.
    """
    found = by_feed(list_files(spark, source, "*.[cC][sS][vV]")).select(F.col("feed").alias("name"))
    config = spark.createDataFrame(list(enumerate(specs)), "position int, table_name string")
    results = {}
    for row in match_config(found, config, "substring").collect():
        spec = specs.get(row["table_name"]) or _from_header(spark, source, row["name"])
        try:
            rows = read_stream(spark, source, spec.with_(table=row["name"]))
            results[row["name"]] = run_into_staging(
                rows, f"{root}/{spec.table}_staging", f"{root}/checkpoints/{row['name']}"
            )
        except Exception as problem:  # noqa: BLE001 - one broken feed must not stop the others
            results[row["name"]] = StreamResult("ERROR", 0, 0, reason(problem))
    return results


def stream_into_tables(
    spark: SparkSession, source: str, spec: FeedSpec, store: TableStore, log_root: str, checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamResult:
    """New files of a feed through typing, gates and merge into its tables, with logs per micro-batch.

    A micro-batch that is sent again after a failure has the same load id and changes nothing twice.
    """

    lowered = spec.with_(fields=tuple(replace(f, name=f.name.lower()) for f in spec.fields))

    def handle(batch: DataFrame, load_id: str) -> None:
        rows = batch.select(
            *lowered.columns, CORRUPT, F.col("FILE_NAME_RECEIVED").alias(FILE),
            F.col("FILE_PATH_RECEIVED").alias(PATH), F.lit(0).cast("long").alias(BLOCK),
            F.monotonically_increasing_id().alias(ROW),
        )
        ingest_rows(rows, lowered, store, log_root, load_id)

    return run_batches(read_stream(spark, source, spec, files_per_batch), checkpoint, handle)


def _from_header(spark: SparkSession, source: str, feed: str) -> FeedSpec:
    spec = FeedSpec(feed, header=NAMES, imposed=False)
    mine = belongs_to(received_name(F.col("_metadata.file_path")), feed)
    return spec.with_(fields=tuple(FieldSpec(n) for n in first_line(spark, spec, source, mine)))


def staging_stats(staging: dict[str, DataFrame]) -> DataFrame:
    """Rows and source files of every staging table."""
    return table_inventory(staging).select("table_name", "rows", "sources")
