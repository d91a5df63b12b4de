"""Load of one feed: read, type, judge, merge, log.

The text files are parsed once. The typed rows with their issues are written to the shared folder;
gates, logs, history and current table all read that columnar copy. The number of Spark jobs is
fixed: it depends neither on the number of columns nor on the number of files.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.filenames import name_parts, received_name, stem
from feedloom.operators import errors as E
from feedloom.operators import gates
from feedloom.operators.columns import (
    DATE_PARTS,
    align_to_string,
    gap_errors,
    missing_column_errors,
    missing_columns,
    stamp,
)
from feedloom.operators.quality import duplicate_keys, empty_units
from feedloom.operators.typing import ISSUES, field_at, type_rows
from feedloom.plans.modes import merges_keys, next_state, rewrites
from feedloom.session import Scratch, open_files, staged, together, tune
from feedloom.sinks import logs
from feedloom.sinks.commits import Conflict
from feedloom.sinks.keys import signature
from feedloom.sinks.tables import ALL, DATES, TableStore, date_key
from feedloom.sources import delimited, fixed_width, headers
from feedloom.sources.delimited import BLOCK, CORRUPT, FILE, PATH, ROW
from feedloom.sources.listing import (
    check_names,
    choose,
    empty_files,
    list_files,
    load_units,
    match_pattern,
    run_log_reason,
)
from feedloom.specs import EACH, FIRST, FULL_SNAPSHOT, MERGE, PARTITION_REPLACE, FeedSpec

CONFLICTS = 10  # times a load is merged again because others were committed first
UNIT, STEM = "_unit", "_stem"
ORDER = (PATH, BLOCK, ROW)


@dataclass
class Load:
    """What a batch turned into. All frames are lazy views of the staged rows."""

    spec: FeedSpec
    accepted: DataFrame
    refused: DataFrame
    errors: DataFrame
    runs: DataFrame


def read_feed(
    spark: SparkSession, path: str | list[str], spec: FeedSpec, accept: Column | None = None
) -> DataFrame:
    reader = fixed_width if spec.input_format == "fixed" else delimited
    return reader.scan(spark, path, spec, accept)


def read_deliveries(
    spark: SparkSession, path: str, spec: FeedSpec, accept: Column, keep: Callable[[DataFrame, str], DataFrame]
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the deliveries and, where each brings its own header, the columns each lacks (``file_name,
    column_name``), ``None`` if none does."""
    if spec.fields and headers.applies(spec):
        found = headers.scan(spark, path, spec, accept, keep)
        return found.rows, found.gaps
    return read_feed(spark, path, spec, accept), None


def stage(
    rows: DataFrame, spec: FeedSpec, keep: Callable[[DataFrame, str], DataFrame] = staged
) -> DataFrame:
    """Aligned, trimmed and typed rows with their issues, written to the shared folder.

    Everything downstream filters on the issues. Over written rows these are plain columns; over the
    lazy projection Spark would copy all the typing expressions into every one of those filters.
    """
    tune(rows.sparkSession)
    aligned = align_to_string(rows, spec.columns, trim=spec.trim)
    return keep(type_rows(aligned, spec.fields), f"stage-{spec.table}")


def judge(
    spec: FeedSpec,
    typed: DataFrame,
    files: DataFrame,
    missing: list[str] = (),
    keep: Callable[[DataFrame, str], DataFrame] = staged,
    gaps: DataFrame | None = None,
) -> Load:
    """Gates, policies and quality checks over staged rows.

    ``typed`` comes from :func:`stage`; ``files`` lists what was to be loaded (``file_name``).
    ``keep`` writes the small results per file and unit once; the rows are then only scanned and filtered
    against tables of known size, which Spark broadcasts while they are small. Left to an estimate, these
    joins would shuffle and sort the rows by file, with a task for each of a few files. Columns that are
    allowed to be missing come as ``missing``, if no file has them, or as ``gaps`` per file.
    """
    corrupt = gates.corrupt_counts(typed, FILE, CORRUPT)
    corrupt = keep(corrupt.withColumn("_gate", gates.too_corrupt(corrupt, spec.tolerance)), "corrupt")
    stopped = corrupt.where("_gate").select(F.col(FILE).alias("file_name"))
    remaining = files.select("file_name").join(stopped, "file_name", "left_anti")
    good_files = keep(file_facts(remaining, spec.file_policy), "units")
    sound = typed.join(good_files, FILE)

    sizes = (
        corrupt.join(good_files.select(FILE, UNIT), FILE)
        .groupBy(UNIT)
        .agg(F.sum("rows").alias("rows"))
    )
    counts = keep(gates.issue_counts(sound, UNIT), "issues")
    verdicts = keep(gates.unit_verdicts(gates.ict_columns(counts, sizes, spec.fields, UNIT), UNIT), "verdicts")
    judged = gates.judge_rows(sound, verdicts, UNIT)
    accepted = judged.where("_kept")

    unit_names = good_files.select(UNIT).distinct()
    frames = [
        gates.policy_errors(judged, counts, verdicts, spec.fields, spec.table, UNIT, ORDER,
                            spec.max_logged_errors),
        empty_units(unit_names, accepted, UNIT, spec.columns, spec.table),
        duplicate_keys(accepted, spec.merge_keys, spec.table, UNIT),
    ]
    if missing:
        # Under the name the log has: that of the unit, not of each merged file.
        named = unit_names.select(F.col(UNIT).alias("file_name"))
        frames.append(missing_column_errors(named, list(missing), spec.table, lenient=True))
    if gaps is not None:
        of_unit = gaps.join(good_files.select(F.col(FILE).alias("file_name"), UNIT), "file_name")
        named = of_unit.select(F.col(UNIT).alias("file_name"), "column_name").distinct()
        frames.append(gap_errors(named, spec.table, lenient=True))
    return Load(
        spec=spec,
        accepted=accepted,
        refused=judged.where(~F.col("_kept")),
        errors=E.union_errors(frames),
        runs=run_rows(spec, unit_names, accepted, corrupt),
    )


def file_facts(files: DataFrame, policy: str) -> DataFrame:
    """What rows take from the name of their file, worked out once per file instead of per row."""
    units = load_units(files, policy)
    source = F.col("file_name")
    if policy == MERGE:
        # Merged files are stored under the name and date of the first one.
        source = files.agg(F.min("file_name")).scalar()
    named = units.withColumn("_source", source)
    return named.select(
        F.col("file_name").alias(FILE),
        F.col("unit").alias(UNIT),
        stem(F.col("_source")).alias(STEM),
        *[v.alias(f"_{k}") for k, v in name_parts(F.col("_source")).items()],
    )


def run_rows(spec: FeedSpec, units: DataFrame, accepted: DataFrame, corrupt: DataFrame) -> DataFrame:
    """Outcome of every unit: rows kept, and the files refused as too corrupt."""
    kept = accepted.groupBy(UNIT).agg(F.count(F.lit(1)).alias("row_count"))
    loaded = units.join(kept, UNIT, "left").select(
        F.col(UNIT).alias("filename"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.lit(logs.SUCCESS).alias("status"),
    )
    refused = corrupt.where("_gate").select(
        F.col(FILE).alias("filename"), F.col("rows").alias("row_count"), F.lit(logs.FAILED).alias("status")
    )
    return loaded.unionByName(refused).select(*describe(spec), "*")


def with_error_counts(runs: DataFrame, errors: DataFrame) -> DataFrame:
    """Error rows per unit, and the message of the execution log."""
    counted = errors.groupBy("filename").agg(F.count(F.lit(1)).alias("_n"))
    failed = F.col("status") == logs.FAILED
    n = F.when(failed, F.lit(0)).otherwise(F.coalesce("_n", F.lit(0))).cast("long")
    text = (
        F.when(failed, F.lit("Too many corrupted lines"))
        .when(n > 0, F.concat(n, F.lit(" errors detected")))
        .otherwise("")
    )
    joined = runs.join(counted, "filename", "left")
    return joined.withColumns({"error_count": n, "error_message": text}).drop("_n")


def describe(spec: FeedSpec) -> list[Column]:
    return [
        F.lit(spec.table).alias("table_name"),
        F.lit(spec.input_format).alias("input_format"),
        F.lit(spec.mode).alias("ingestion_mode"),
        F.lit(spec.zone).alias("output_zone"),
        F.lit(len(spec.fields)).alias("column_count"),
        F.lit(spec.masked).alias("masking_applied"),
    ]


def batch_rows(load: Load, processed: Column, today: Column | None = None) -> DataFrame:
    """Accepted rows with the metadata columns of the tables."""
    parts = {p: F.col(f"_{p}") for p in DATE_PARTS}
    rows = load.accepted.select(*load.spec.columns, FILE, *ORDER, STEM, *[f"_{p}" for p in DATE_PARTS])
    return stamp(rows, F.col(STEM), processed, parts, today).drop(STEM, *[f"_{p}" for p in DATE_PARTS])


def tie_order(spec: FeedSpec) -> list[Column]:
    """Which of equally new rows wins, as if files had been loaded one after the other.

    With a validity column the earlier file stays; with the process time the later file is newer.
    """
    file = F.col(FILE).asc() if spec.validity_column else F.col(FILE).desc()
    return [file, *[F.col(c).desc() for c in ORDER]]


def write_load(
    load: Load, store: TableStore, load_id: str, processed: Column | None = None, today: Column | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = staged,
) -> Callable[[], None]:
    """Writes the folders of a load and returns the commit that puts them in force.

    A mode that replaces keys or dates rewrites only the dates of the current table it touches; a mode
    that appends, or a snapshot that is one unit, writes its rows once, for both tables.
    """
    spec, internal = load.spec, [FILE, *ORDER]
    rows = batch_rows(load, processed if processed is not None else F.current_timestamp(), today)
    history = rows.drop(*internal)
    if not rewrites(spec.mode):
        store.add_history(spec.table, history, load_id)
        return lambda: store.append_current(spec.table, history, load_id)
    if spec.mode == FULL_SNAPSHOT and spec.file_policy == EACH:
        # Files loaded one after the other: the last snapshot is what remains.
        rows = rows.where(F.col(FILE) == rows.agg(F.max(FILE)).scalar())
    commits = store.commits(spec.table)
    last = store.current(spec.table, commits)
    dates = touched_dates(last, rows, spec, lambda: store.may_hold(spec.table, commits, rows, spec.merge_keys))
    # Snapshots and whole dates stand for themselves; what was merged holds for the table it was merged with.
    alone = spec.mode == FULL_SNAPSHOT or (spec.mode == PARTITION_REPLACE and dates is not None)
    base = None if alone else (commits[-1]["seq"] if commits else 0)
    if dates is not None:
        # Of the other dates no row can change.
        replaced = spec.mode != PARTITION_REPLACE and bool(dates)
        last = last.where(date_key().isin(*dates) if replaced else F.lit(False))
    state = next_state(
        last, rows, spec.mode, spec.merge_keys, spec.validity_column,
        tie_order(spec), keep=lambda df: keep(df, f"newest-{spec.table}"),
    ).drop(*internal)
    if spec.mode == FULL_SNAPSHOT and spec.file_policy != EACH:
        # The snapshot is what the history gets, so both tables read the same files.
        store.add_history(spec.table, history, load_id)
        return lambda: store.commit(spec.table, load_id, history.schema, state.schema, in_history=True)
    keyed = merges_keys(spec.mode) and set(DATE_PARTS) <= set(state.columns)
    keys = signature(state.schema, spec.merge_keys) if keyed else None

    def write_current() -> None:
        store.write_current(spec.table, state, load_id, scattered=spec.mode != FULL_SNAPSHOT)
        if keys:
            store.write_keys(spec.table, load_id, state.schema, spec.merge_keys)

    together(lambda: store.add_history(spec.table, history, load_id), write_current)
    replaces = ALL if dates is None else DATES
    return lambda: store.commit(
        spec.table, load_id, history.schema, state.schema, replaces, dates or (), base=base, keys=keys
    )


def put_in_force(commit: Callable[[], None], write: Callable[[], Callable[[], None]]) -> None:
    """Commits a load; where another one came first, its folders are written again from the new table."""
    for _ in range(CONFLICTS):
        try:
            return commit()
        except Conflict:
            commit = write()
    commit()


def touched_dates(
    last: DataFrame | None, batch: DataFrame, spec: FeedSpec, holding: Callable[[], DataFrame]
) -> list[int] | None:
    """Dates of the current table in which a batch replaces rows, ``None`` for the whole table.

    They are folders of the table: as many as it has days at most. ``holding`` is the part of the table
    that may hold keys of the batch.
    """
    if last is None or spec.mode == FULL_SNAPSHOT or not set(DATE_PARTS) <= set(last.columns):
        return None
    if spec.mode == PARTITION_REPLACE:
        hit = batch.where(" AND ".join(f"{p} IS NOT NULL" for p in DATE_PARTS))
    elif spec.merge_keys:
        hit = holding().join(batch.select(*spec.merge_keys).distinct(), spec.merge_keys, "left_semi")
    else:
        return None
    return sorted(r["k"] for r in hit.select(date_key().alias("k")).distinct().collect())


def apply_load(
    load: Load, store: TableStore, load_id: str, processed: Column | None = None, today: Column | None = None
) -> None:
    """History and current table. Loading the same ``load_id`` again changes nothing."""
    if not store.is_loaded(load.spec.table, load_id):
        write = lambda: write_load(load, store, load_id, processed, today)
        put_in_force(write(), write)


def refused_names(spec: FeedSpec, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quality rows and execution rows of the files refused for their name."""
    bad = files.where(F.col("reason").isNotNull())
    name = F.col("file_name")
    quality = bad.select(
        *E.error_row(spec.table, name, "filename", "INVALID_FILENAME", F.col("reason"), F.col("invalid_value"))
    )
    runs = bad.select(
        *describe(spec),
        name.alias("filename"),
        F.lit(0).cast("long").alias("row_count"),
        F.lit(0).cast("long").alias("error_count"),
        run_log_reason(name).alias("error_message"),
        F.lit(logs.FAILED).alias("status"),
    )
    return quality, runs.withColumn("column_count", F.lit(0))


def ingest_rows(
    rows: DataFrame, spec: FeedSpec, store: TableStore, log_root: str, load_id: str, env: str = "dev",
) -> None:
    """Load rows already read as text, with where they came from (``_file``, ``_path``, ``_block``,
    ``_row``, ``_corrupt_record``), such as a micro-batch, through the same typing, gates and merge.

    Loading the same ``load_id`` again changes nothing; what a load that was stopped after its commit
    had not logged yet is logged then.
    """
    started = time.time()
    spark = rows.sparkSession
    loaded = store.is_loaded(spec.table, load_id)
    if loaded and logs.is_logged(spark, f"{log_root}/execution", load_id):
        return
    scratch = Scratch(spark, f"load-{spec.table}")
    try:
        typed = stage(rows, spec, scratch.staged)
        files = typed.select(F.col(FILE).alias("file_name")).distinct()
        load = judge(spec, typed, files, keep=lambda df, label: scratch.staged(df, f"{label}-{spec.table}"))
        ready: dict = {}

        def write_tables() -> Callable[[], None]:
            ready["commit"] = write_load(load, store, load_id, keep=scratch.staged)
            return ready["commit"]

        def stage_errors() -> None:
            ready["errors"] = scratch.staged(load.errors, f"errors-{spec.table}")

        if loaded:
            stage_errors()
        else:
            with open_files(spark):
                together(write_tables, stage_errors)
                put_in_force(ready["commit"], write_tables)
        _log(spec, ready["errors"], with_error_counts(load.runs, ready["errors"]), log_root, env, started, load_id)
    finally:
        scratch.remove()


class LoadFailed(Exception):
    """A load that ended without taking effect; its files are in the execution log as FAILED."""


def ingest(
    spark: SparkSession,
    path: str,
    spec: FeedSpec,
    store: TableStore,
    log_root: str,
    env: str = "dev",
    load_id: str | None = None,
    today: Column | None = None,
) -> None:
    """Load every matching file below ``path`` and write both logs.

    The tables change with one commit, then the logs are written, under the id of the load. A load
    that fails before leaves the tables as they were and every file it was to load FAILED in the log;
    one that was committed before is not done again.
    """
    started, load_id = time.time(), load_id or uuid.uuid4().hex
    if store.is_loaded(spec.table, load_id):
        return
    scratch = Scratch(spark, f"load-{spec.table}")
    try:
        _ingest(spark, path, spec, store, log_root, env, load_id, today, started, scratch)
    finally:
        scratch.remove()


def _ingest(
    spark: SparkSession, path: str, spec: FeedSpec, store: TableStore, log_root: str, env: str, load_id: str,
    today: Column | None, started: float, scratch: Scratch,
) -> None:
    # Written once: a table of known size, and the folder is listed a single time.
    listed = match_pattern(list_files(spark, path).select("file_name").distinct(), spec.filename_pattern)
    matched = scratch.staged(check_names(listed), f"files-{spec.table}")
    named_badly, failed = refused_names(spec, matched)
    if not spec.ignore_empty:
        named_badly = named_badly.unionByName(empty_deliveries(spark, path, spec))
    valid = matched.where(F.col("reason").isNull())
    chosen = choose(valid, spec.file_policy).select("file_name")

    def log(errors: DataFrame, runs: DataFrame) -> None:
        _log(spec, errors, failed.unionByName(runs, True), log_root, env, started, load_id)

    def all_failed(text: str, errors: DataFrame) -> None:
        log(errors, chosen.select(
            *describe(spec), F.col("file_name").alias("filename"), F.lit(text).alias("error_message"),
            F.lit(logs.FAILED).alias("status"),
        ))

    if chosen.isEmpty():
        text = "No file matching" if matched.isEmpty() else "All files rejected"
        log(named_badly, spark.range(1).select(
            *describe(spec), F.lit("N/A").alias("filename"), F.lit(text).alias("error_message"),
            F.lit(logs.FAILED).alias("status"),
        ))
        return
    try:
        raw, gaps = read_deliveries(spark, path, spec, name_filter(spec, chosen), scratch.staged)
        if gaps is not None and not spec.delete_columns_allowed:
            # Files that lack columns are refused, each for its own; the others are loaded.
            short = scratch.staged(gaps.join(chosen, "file_name", "left_semi"), f"gaps-{spec.table}")
            refused = short.select("file_name").distinct()
            named_badly = E.union_errors([named_badly, gap_errors(short, spec.table)])
            failed = failed.unionByName(refused.select(
                *describe(spec), F.col("file_name").alias("filename"), F.lit(0).cast("long").alias("row_count"),
                F.lit(0).cast("long").alias("error_count"), F.lit("Missing columns").alias("error_message"),
                F.lit(logs.FAILED).alias("status"),
            ))
            chosen = chosen.join(refused, "file_name", "left_anti")
            if chosen.isEmpty():
                log(named_badly, failed.limit(0))
                return
        missing = missing_columns(raw, spec.columns) if gaps is None else []
        if missing and not spec.delete_columns_allowed:
            all_failed("Missing columns", E.union_errors([named_badly, missing_column_errors(chosen, missing, spec.table)]))
            return
        wanted = raw.join(chosen.withColumnRenamed("file_name", FILE), FILE, "left_semi")
        typed = stage(wanted, spec, scratch.staged)
        load = judge(
            spec, typed, chosen, missing, lambda df, label: scratch.staged(df, f"{label}-{spec.table}"),
            gaps if spec.delete_columns_allowed else None,
        )
        ready: dict = {}

        def write_tables() -> Callable[[], None]:
            ready["commit"] = write_load(load, store, load_id, today=today, keep=scratch.staged)
            return ready["commit"]

        def stage_errors() -> None:
            ready["errors"] = scratch.staged(load.errors.unionByName(named_badly), f"errors-{spec.table}")

        def write_rejects() -> None:
            if spec.keep_rejects:
                rejects = rejected_lines(load, typed)
                logs.write_rejects(rejects, f"{log_root}/badrecords/{env}", spec.table, load_id)

        # Independent writes over the same staged rows: together they keep the executors busy while
        # one of them waits for its last tasks. None of them changes a table yet.
        with open_files(spark):
            together(write_tables, stage_errors, write_rejects)
            put_in_force(ready["commit"], write_tables)
    except Exception as problem:
        all_failed(f"Ingestion error: {reason(problem)}", named_badly)
        raise LoadFailed(reason(problem)) from problem
    log(ready["errors"], with_error_counts(load.runs, ready["errors"]))


def rejected_lines(load: Load, typed: DataFrame) -> DataFrame:
    """Lines that were refused, with their source texts: those of rejected rows, column by column,
    and the whole line where a file was refused as too corrupt."""
    names = load.spec.columns
    told = F.transform(ISSUES, lambda i: F.struct(field_at(load.spec.fields, i["pos"], lambda f: f.name).alias("column"), i["kind"].alias("kind")))
    bad = lambda n: F.filter(ISSUES, lambda i: (i["pos"] == names.index(n)) & i["raw"].isNotNull())
    texts = F.create_map(*[x for n in names for x in (
        F.lit(n), F.coalesce(F.try_element_at(F.transform(bad(n), lambda i: i["raw"]), F.lit(1)), F.col(f"`{n}`").cast("string")))])
    place = [F.col(FILE).alias("filename"), F.col(PATH).alias("path"), F.col(BLOCK).alias("block_start"), F.col(ROW).alias("line")]
    rows = load.refused.select(*place, F.lit(None).cast("string").alias("line_text"), texts.alias("texts"), told.alias("issues"))
    corrupt = typed.where(F.col(CORRUPT).isNotNull()).select(
        *place, F.col(CORRUPT).alias("line_text"), F.lit(None).cast("map<string, string>").alias("texts"),
        F.array(F.struct(F.lit("ALL_COLUMNS").alias("column"), F.lit("CORRUPT").alias("kind"))).alias("issues"),
    )
    return rows.unionByName(corrupt)


def reason(problem: Exception) -> str:
    """What went wrong, in one line: the innermost cause that Spark reports, else the message itself."""
    lines = [x.strip() for x in str(problem).splitlines() if x.strip()]
    causes = [x.removeprefix("Caused by: ") for x in lines if x.startswith("Caused by: ")]
    plain = next((x for x in lines if not x.startswith("An error occurred while calling")), type(problem).__name__)
    return causes[-1] if causes else plain


def empty_deliveries(spark: SparkSession, path: str, spec: FeedSpec) -> DataFrame:
    """FILE_EMPTY for matching files without a byte, which a scan does not even see."""
    empty = match_pattern(empty_files(spark, path), spec.filename_pattern)
    return empty.select(*E.error_row(spec.table, F.col("file_name"), "ALL_COLUMNS", E.FILE_EMPTY))


def ingest_feeds(
    spark: SparkSession, path: str, specs: dict[str, FeedSpec], store: TableStore, log_root: str, env: str = "dev"
) -> dict[str, str]:
    """Every configured feed in turn; a feed that fails is logged and does not stop the others."""
    outcome = {}
    for table, spec in specs.items():
        started = time.time()
        try:
            ingest(spark, path, spec, store, log_root, env)
            outcome[table] = "DONE"
        except LoadFailed as problem:
            outcome[table] = f"Ingestion error: {problem}"
        except Exception as problem:  # noqa: BLE001 - one broken feed must not lose the rest
            outcome[table] = f"Ingestion error: {reason(problem)}"
            failed = spark.range(1).select(
                *describe(spec), F.lit("N/A").alias("filename"), F.lit(outcome[table]).alias("error_message"),
                F.lit(logs.FAILED).alias("status"),
            )
            timed = failed.withColumn("duration", F.lit(round(time.time() - started, 2)))
            logs.append_log(logs.execution_rows(timed, env), f"{log_root}/execution")
    return outcome


def name_filter(spec: FeedSpec, chosen: DataFrame) -> Column:
    """A cheap condition on the file name, which Spark applies when it lists the folder.

    It is also evaluated per row, so it is a plain comparison: the fixed start of the name pattern,
    or the one name to be loaded. What else it lets through is left out by the list of files.
    """
    name = received_name(F.col("_metadata.file_path"))
    if spec.file_policy == FIRST:
        return name == F.lit(chosen.first()["file_name"])
    return name.startswith(re.split(r"[<*]", spec.filename_pattern)[0])


def _log(
    spec: FeedSpec, errors: DataFrame, runs: DataFrame, root: str, env: str, started: float, load_id: str
) -> None:
    quality = logs.quality_rows(errors, spec.table, spec.zone, env)
    timed = runs.withColumn("duration", F.lit(round(time.time() - started, 2)))
    # The execution log tells that a load was logged, so it comes second.
    logs.append_log(quality, f"{root}/quality", load_id)
    logs.append_log(logs.execution_rows(timed, env), f"{root}/execution", load_id)
