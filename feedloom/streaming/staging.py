"""Staging tables between a file stream and the load of a feed, emptied by the loads.

A stream fills the staging table: every micro-batch is a folder of its own, put in force by an entry of
the staging table's ledger. A load claims what is there at that moment, loads it under the id of the
claim, notes which source files it took, closes the claim and removes the folders.

The ledger is a numbered list of small files (see ``sinks.commits``), so what a run does that was stopped
at any point is known to the next one: a micro-batch sent again writes the same folder; a claim left open
is loaded again under its id, which changes nothing where the tables have that load already; folders of
closed claims that are still there are removed. Nothing is lost or loaded twice. Two loads of a feed that
start at once get different claims, or one of them none; a claim that is being loaded must not be taken
up by another run, so a scheduler runs one load per feed at a time.

Source files are known by their path, as the file stream itself knows them: a file that an earlier load
took is left out and counted when it is staged once more, for example by a stream with a new checkpoint.

Defined results: an empty or missing staging table loads nothing; a load that fails leaves its claim open
and the staged rows where they are; a file whose rows are all refused counts as taken, since the logs
hold its outcome. The driver holds one entry per micro-batch and two per load, never files or rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.plans.ingest import ingest_rows, reason
from feedloom.sinks.commits import CommitLog, Conflict
from feedloom.sinks.tables import TableStore
from feedloom.sources.delimited import BLOCK, CORRUPT, FILE, PATH, ROW
from feedloom.specs import FeedSpec
from feedloom.streaming.files import FILES_PER_BATCH, STREAM_META, StreamResult, read_stream, run_batches

# Kinds of ledger entries.
FILLED, CLAIMED, CLOSED = "filled", "claimed", "closed"
TAKEN = "source_path string, source_file string, row_count bigint"
BATCH = "batch_id"


@dataclass(frozen=True)
class Consumed:
    """What one load took out of a staging table."""

    load_id: str | None
    files: int = 0
    rows: int = 0
    repeated: int = 0  # files left out because an earlier load took them


@dataclass(frozen=True)
class Staging:
    """The staging table of one feed below ``root``."""

    spark: SparkSession
    root: str
    spec: FeedSpec

    @property
    def path(self) -> str:
        return f"{self.root}/{self.spec.table}_staging"

    @property
    def ledger(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.path}/ledger")

    def _schema(self) -> T.StructType:
        names = [*(c.lower() for c in self.spec.columns), CORRUPT]
        kinds = {p: T.IntegerType() for p in ("yyyy", "mm", "dd")} | {"INGESTION_TIMESTAMP": T.TimestampType()}
        places = [T.StructField(BLOCK, T.LongType()), T.StructField(ROW, T.LongType())]
        meta = [T.StructField(n, kinds.get(n, T.StringType())) for n in STREAM_META]
        return T.StructType([*(T.StructField(n, T.StringType()) for n in names), *meta, *places])

    def fill(self, source: str, checkpoint: str, files_per_batch: int = FILES_PER_BATCH) -> StreamResult:
        """Everything new below ``source`` into the staging table."""
        stream = read_stream(self.spark, source, self.spec, files_per_batch)
        # Lines keep their place in the file, which decides between rows that are equally new.
        placed = stream.withColumn(BLOCK, F.col("_metadata.file_block_start"))
        return run_batches(placed, checkpoint, self.add)

    def add(self, batch: DataFrame, batch_id: str) -> None:
        """One micro-batch. Added again under its id it changes nothing."""
        if any(r["load_id"] == batch_id for r in self.ledger.rows()):
            return
        numbered = batch.withColumn(ROW, F.monotonically_increasing_id())
        rows = numbered.select(*[F.col(f.name).cast(f.dataType) for f in self._schema()])
        rows.write.mode("overwrite").parquet(f"{self.path}/rows/{BATCH}={batch_id}")
        self.ledger.append(lambda before: {"kind": FILLED}, batch_id)

    def rows(self) -> DataFrame:
        """What is staged and not yet loaded, with ``batch_id``."""
        waiting, claims, _ = self._state(self.ledger.rows())
        return self._read([*waiting, *[b for c in claims.values() for b in c]])

    def taken(self) -> DataFrame:
        """Source files taken by closed loads, with their rows and ``load_id``."""
        return self._taken([r["claim"] for r in self.ledger.rows() if r["kind"] == CLOSED])

    def consume(self, store: TableStore, log_root: str, env: str = "dev") -> list[Consumed]:
        """Loads what is staged into the tables of the feed and empties the staging table.

        Claims an earlier run left open come first, each under its own id.
        """
        _, claims, closed = self._state(self.ledger.rows())
        self._remove([b for batches in closed.values() for b in batches])
        done = [self._load(load_id, batches, store, log_root, env) for load_id, batches in claims.items()]
        fresh = self._claim()
        if fresh:
            done.append(self._load(*fresh, store, log_root, env))
        return done

    def _claim(self) -> tuple[str, list[str]] | None:
        """Takes all that waits, unless another load came first, which then has it."""
        while True:
            before = self.ledger.rows()
            waiting, _, _ = self._state(before)
            if not waiting:
                return None
            load_id = uuid.uuid4().hex
            try:
                self.ledger.append(lambda _: {"kind": CLAIMED, "batches": waiting}, load_id, before[-1]["seq"])  # noqa: B023
            except Conflict:
                continue
            return load_id, waiting

    def _load(self, load_id: str, batches: list[str], store: TableStore, log_root: str, env: str) -> Consumed:
        staged = self._read(batches)
        earlier = self.taken().select("source_path")
        # One row per source file from here on; the rows themselves are only scanned.
        files = staged.groupBy("FILE_PATH_RECEIVED", "FILE_NAME_RECEIVED").agg(F.count(F.lit(1)).alias("row_count"))
        named = files.select(
            F.col("FILE_PATH_RECEIVED").alias("source_path"), F.col("FILE_NAME_RECEIVED").alias("source_file"), "row_count"
        )
        # Written before the load and in force once the claim is closed.
        place = f"{self.path}/taken/load_id={load_id}"
        named.join(earlier, "source_path", "left_anti").write.mode("overwrite").parquet(place)
        mine = self.spark.read.schema(TAKEN).parquet(place)
        counted = mine.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows")).first()
        repeated = named.count() - counted["files"]
        if counted["files"]:
            fresh = staged
            if repeated:
                fresh = staged.join(mine.select(F.col("source_path").alias("FILE_PATH_RECEIVED")), "FILE_PATH_RECEIVED", "left_semi")
            lowered = self.spec.with_(fields=tuple(replace(f, name=f.name.lower()) for f in self.spec.fields))
            text = fresh.select(
                *lowered.columns, CORRUPT, F.col("FILE_NAME_RECEIVED").alias(FILE),
                F.col("FILE_PATH_RECEIVED").alias(PATH), BLOCK, ROW,
            )
            ingest_rows(text, lowered, store, log_root, load_id, env)
        self.ledger.append(lambda before: {"kind": CLOSED, "claim": load_id}, f"{load_id}-closed")
        self._remove(batches)
        return Consumed(load_id, counted["files"], counted["rows"], repeated)

    def _state(self, entries: list[dict]) -> tuple[list[str], dict[str, list[str]], dict[str, list[str]]]:
        """Batches that wait, and the batches of open and of closed claims."""
        over = {r["claim"] for r in entries if r["kind"] == CLOSED}
        claims = {r["load_id"]: r["batches"] for r in entries if r["kind"] == CLAIMED}
        held = {b for batches in claims.values() for b in batches}
        waiting = [r["load_id"] for r in entries if r["kind"] == FILLED and r["load_id"] not in held]
        return waiting, {k: v for k, v in claims.items() if k not in over}, {k: v for k, v in claims.items() if k in over}

    def _read(self, batches: list[str]) -> DataFrame:
        return self._folders(f"{self.path}/rows", BATCH, batches, self._schema())

    def _taken(self, loads: list[str]) -> DataFrame:
        return self._folders(f"{self.path}/taken", "load_id", loads, T._parse_datatype_string(TAKEN))

    def _folders(self, path: str, key: str, names: list[str], schema: T.StructType) -> DataFrame:
        whole = T.StructType([*schema, T.StructField(key, T.StringType())])
        if not names:
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).parquet(path).where(F.col(key).isin(*names))

    def _remove(self, batches: list[str]) -> None:
        """Folders of loaded micro-batches; those already gone are passed over."""
        jvm = self.spark._jvm.org.apache.hadoop.fs
        folder = jvm.Path(f"{self.path}/rows")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        there = {x.getPath().getName() for x in files.listStatus(folder)} if files.exists(folder) else set()
        for batch in batches:
            if f"{BATCH}={batch}" in there:
                files.delete(jvm.Path(folder, f"{BATCH}={batch}"), True)


def consume_all(
    tables: list[Staging], store: TableStore, log_root: str, env: str = "dev"
) -> dict[str, list[Consumed] | str]:
    """Every staging table in turn; one that fails keeps its rows and does not stop the others."""
    outcome: dict[str, list[Consumed] | str] = {}
    for table in tables:
        try:
            outcome[table.spec.table] = table.consume(store, log_root, env)
        except Exception as problem:  # noqa: BLE001 - one broken feed must not lose the rest
            outcome[table.spec.table] = f"Ingestion error: {reason(problem)}"
    return outcome
