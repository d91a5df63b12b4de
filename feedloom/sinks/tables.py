"""Parquet tables a feed is loaded into.

Every feed has a history table (append only) and a current table. Each load writes folders of its own,
named by its load id, and takes effect with one commit row. The row says which dates of the current
table the load replaces (all of them, none, or a list), so a merge rewrites only the dates it touches
and leaves the files of the others where they are. Reading takes the folders that commits put in force
and nothing else: what a load that died has written is never read, and a retry overwrites it.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.columns import DATE_PARTS, dedup_columns, metadata_first
from feedloom.session import path_exists
from feedloom.sinks import keys as key_filters
from feedloom.sinks.commits import CommitLog

# How much of the current table a load replaces.
ALL, NONE, DATES = "all", "none", "dates"
ROWS_PER_FILE = 1_000_000  # Fixed value: rows a written file should not exceed.


def write_partitioned(
    df: DataFrame, path: str, mode: str = "append", scattered: bool = False, parts=DATE_PARTS
) -> None:
    """Partitioned Parquet, with no count and no fixed partition number.

    Rows fresh from files come date by date, so tasks write what they hold and nothing is shuffled.
    ``scattered`` rows, as after a join, would make every task write to every date: those are
    rebalanced by date first, which also splits a date that is too large for one task.
    """
    by = [p for p in parts if p in df.columns]
    ready = metadata_first(dedup_columns(df))
    if scattered:
        ready = ready.hint("rebalance", *[F.col(p) for p in by])
    writer = ready.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def merged_schema(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Additive evolution: known columns keep their type, new ones are added at the end."""
    if old is None:
        return new
    known = {f.name.lower() for f in old}
    return T.StructType([*old, *[f for f in new if f.name.lower() not in known]])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Table with additive schema changes merged; the load folder is not part of the rows."""
    return spark.read.option("mergeSchema", "true").parquet(path).drop("load_id")


def date_key(columns: Sequence[str] = DATE_PARTS) -> Column:
    """The date of a row as one number, 0 for parts that are NULL."""
    y, m, d = (F.coalesce(F.col(c), F.lit(0)) for c in columns)
    return y * 10_000 + m * 100 + d


@dataclass(frozen=True)
class TableStore:
    spark: SparkSession
    root: str

    def _folder(self, name: str, side: str) -> str:
        return f"{self.root}/{name}_{side}"

    def _log(self, name: str) -> CommitLog:
        return CommitLog(self.spark, self._folder(name, "commits"))

    def commits(self, name: str) -> list[dict]:
        """Loads in force, in their order: one row per load of this table."""
        return self._log(name).rows()

    def is_loaded(self, name: str, load_id: str) -> bool:
        return any(r["load_id"] == load_id for r in self.commits(name))

    def commit(
        self, name: str, load_id: str, history: T.StructType, current: T.StructType,
        replaces: str = ALL, dates: Sequence[int] = (), in_history: bool = False, base: int | None = None,
        keys: list[list[str]] | None = None,
    ) -> None:
        """Puts a load in force. ``in_history``: its current rows are those it added to the history.
        ``base``: the last commit of the table its rows were computed from; ``Conflict`` if others followed.
        ``keys``: names and types of the keys it wrote filters for.

        The schemas of both tables are kept here, so that reading a table does not have to open the
        footers of its files.
        """

        def row(before: list[dict]) -> dict:
            known = _schemas(before[-1]) if before else (None, None)
            kept = None if replaces == ALL else known[1]
            return {
                "at": time.time_ns(), "replaces": replaces, "dates": list(dates), "in_history": in_history, "keys": keys,
                "history": merged_schema(known[0], history).json(), "current": merged_schema(kept, current).json(),
            }

        self._log(name).append(row, load_id, base)

    def history(self, name: str, commits: list[dict] | None = None) -> DataFrame | None:
        commits = self.commits(name) if commits is None else commits
        if not commits:
            return None
        return self._read(name, "all", _schemas(commits[-1])[0], {frozenset(): [r["load_id"] for r in commits]})

    def current(self, name: str, commits: list[dict] | None = None) -> DataFrame | None:
        """Rows in force, as of ``commits`` where these were read before."""
        commits = self.commits(name) if commits is None else commits
        if not commits:
            return None
        schema = _schemas(commits[-1])[1]
        sides = [self._read(name, side, schema, loads) for side, loads in in_force(commits).items() if loads]
        return reduce(DataFrame.unionByName, sides)

    def may_hold(self, name: str, commits: list[dict], batch: DataFrame, keys: Sequence[str]) -> DataFrame | None:
        """The part of the current table that may hold keys of the batch: of loads with filters for these
        keys, the dates whose filters say so; all of the others."""
        if not commits:
            return None
        loads, mine = in_force(commits), key_filters.signature(batch.schema, keys)
        with_keys = {r["load_id"] for r in commits if mine is not None and r.get("keys") == mine}
        known = {gone: [i for i in ids if i in with_keys] for gone, ids in loads["last"].items()}
        known = {gone: ids for gone, ids in known.items() if ids}
        if not known:
            return self.current(name, commits)
        dates = key_filters.dates_holding(self._filters(name, known), batch, keys)
        if dates is None:
            return self.current(name, commits)
        schema = _schemas(commits[-1])[1]
        parts = [self._read(name, "last", schema, known).where(date_key().isin(*dates) if dates else F.lit(False))]
        rest = {gone: [i for i in ids if i not in with_keys] for gone, ids in loads["last"].items()}
        for side, others in (("last", rest), ("all", loads["all"])):
            others = {gone: ids for gone, ids in others.items() if ids}
            if others:
                parts.append(self._read(name, side, schema, others))
        return reduce(DataFrame.unionByName, parts)

    def write_keys(self, name: str, load_id: str, schema: T.StructType, keys: Sequence[str]) -> None:
        """Filters of the keys of a load, from its written rows."""
        rows = self._read(name, "last", schema, {frozenset(): [load_id]})
        found = key_filters.filters(rows, keys, date_key())
        found.write.mode("overwrite").parquet(f"{self._folder(name, 'keys')}/load_id={load_id}")

    def _filters(self, name: str, loads: dict[frozenset, list[str]]) -> DataFrame:
        """Filters of the dates in force."""
        found = self.spark.read.schema(f"{key_filters.SCHEMA}, load_id string").parquet(self._folder(name, "keys"))
        return found.where(_wanted(loads, F.col("date")))

    def _read(self, name: str, side: str, schema: T.StructType, loads: dict[frozenset, list[str]]) -> DataFrame:
        """Rows of the loads, without the dates that later loads replaced. Load and date are folders, so
        Spark lists but does not open the others."""
        path = self._folder(name, side)
        # An empty load writes no date folder; nothing to list then.
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(T.StructType([*schema, T.StructField("load_id", T.StringType())])).parquet(path)
        return rows.where(_wanted(loads, date_key())).select(*schema.names)

    def add_history(self, name: str, df: DataFrame, load_id: str) -> None:
        write_partitioned(df, f"{self._folder(name, 'all')}/load_id={load_id}", "overwrite")

    def append_current(self, name: str, df: DataFrame, load_id: str) -> None:
        """Puts rows already added to the history in force in the current table too."""
        self.commit(name, load_id, df.schema, df.schema, NONE, in_history=True)

    def write_current(self, name: str, df: DataFrame, load_id: str, scattered: bool = True) -> None:
        """Rows of a load; they may be computed from the current table, which stays untouched."""
        write_partitioned(df, f"{self._folder(name, 'last')}/load_id={load_id}", "overwrite", scattered)

    def replace_current(self, name: str, df: DataFrame, load_id: str, scattered: bool = True) -> None:
        self.write_current(name, df, load_id, scattered)
        self.commit(name, load_id, df.schema, df.schema)

    def register(self, name: str) -> None:
        """Views over both tables of a feed."""
        for suffix, df in (("all", self.history(name)), ("last", self.current(name))):
            if df is not None:
                df.createOrReplaceTempView(f"{name}_{suffix}")

    def tables(self, *suffixes: str) -> dict[str, DataFrame]:
        """Tables of the store by name, for inventories (``_all``, ``_last``)."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [x.getPath().getName() for x in files.listStatus(path)] if files.exists(path) else []
        names = [n.removesuffix("_commits") for n in found if n.endswith("_commits")]
        sides = {"_all": self.history, "_last": self.current}
        return {f"{n}{s}": sides[s](n) for n in sorted(names) for s in (suffixes or tuple(sides))}


def _wanted(loads: dict[frozenset, list[str]], date: Column) -> Column:
    """Rows of the loads, but for the dates replaced in them."""
    wanted = F.lit(False)
    for gone, ids in loads.items():
        mine = F.col("load_id").isin(*ids)
        wanted = wanted | (mine & ~date.isin(*sorted(gone)) if gone else mine)
    return wanted


def in_force(commits: list[dict]) -> dict[str, dict[frozenset, list[str]]]:
    """Per folder (``all``, ``last``) the loads that make up the current table, grouped by the dates
    of theirs that later loads replaced."""
    gone: dict[str, set[int]] = {}
    side: dict[str, str] = {}
    for r in commits:
        if r["replaces"] == ALL:
            gone.clear()
        elif r["replaces"] == DATES:
            for dates in gone.values():
                dates.update(r["dates"])
        gone[r["load_id"]], side[r["load_id"]] = set(), "all" if r["in_history"] else "last"
    out: dict[str, dict[frozenset, list[str]]] = {"all": {}, "last": {}}
    for load, dates in gone.items():
        out[side[load]].setdefault(frozenset(dates), []).append(load)
    return out


def _schemas(commit: dict) -> tuple[T.StructType, T.StructType]:
    return tuple(T.StructType.fromJson(json.loads(commit[side])) for side in ("history", "current"))


def catalog_tables(spark: SparkSession, *suffixes: str, database: str | None = None) -> dict[str, DataFrame]:
    """Catalog tables, no views of the session, whose names end in one of the suffixes (``_all``, ``_last``, ``_staging``)."""
    found = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    own = [t for t in found if not t.isTemporary and t.name.endswith(suffixes)]
    return {t.name: spark.table(".".join([*(t.namespace or []), t.name])) for t in own}
