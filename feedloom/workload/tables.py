"""Queries over table writes, maintenance and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.observability import maintenance
from feedloom.operators.columns import stamp
from feedloom.session import fresh_dir
from feedloom.sinks.tables import TableStore, read_table, write_partitioned
from feedloom.sources.listing import list_files
from feedloom.specs import DELTA_FROM_NON_HISTORIZED, NAMES, FeedSpec, FieldSpec
from feedloom.streaming import files as stream
from feedloom.streaming.staging import Staging
from feedloom.workload import feeds
from feedloom.workload.registry import duck, query, sql, table

_LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
_LINE_SQL = ", ".join(_LINE)
LINES = f"SELECT {_LINE_SQL}, CAST(year(l_shipdate) AS INT) AS yyyy, CAST(1 + l_linenumber % 12 AS INT) AS mm, CAST(1 AS INT) AS dd FROM {{lineitem}}"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, LINES)


PART_BYTES, LEAST_PARTS = 32 << 20, 8  # of the given table per part of the stored one, and its parts at least


def _parts(spark: SparkSession, sf_dir: str) -> int:
    """Parts of the stored table: each holds as many rows at any size of the given one."""
    given = list_files(spark, f"{sf_dir}/lineitem.parquet").agg(F.sum("bytes")).first()[0] or 0
    return max(LEAST_PARTS, -(-given // PART_BYTES))


def _stored(spark: SparkSession, sf_dir: str) -> str:
    """The line items as a table of many small files: every part has one per date."""
    return feeds.landed(
        spark, sf_dir, "lines-table",
        lambda p: _lines(spark, sf_dir).repartition(_parts(spark, sf_dir)).write.partitionBy("yyyy", "mm", "dd").parquet(p),
    )


@query(
    "table_write_roundtrip",
    duck(f"SELECT 'lineitem' AS FILE_NAME_RECEIVED, '2025-09-06 10:00:00' AS FILE_PROCESS_DATE, {_LINE_SQL}, yyyy, mm, dd FROM ({LINES}) l"),
)
def table_write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = _lines(spark, sf_dir), fresh_dir(spark, "table")
    parts = {p: F.col(p) for p in ("yyyy", "mm", "dd")}
    stamped = stamp(rows, F.lit("lineitem"), F.lit("2025-09-06 10:00:00"), parts)
    write_partitioned(stamped, path, scattered=True)
    return read_table(spark, path)


@query("compact_table", duck(LINES))
def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fresh_dir(spark, "compact")
    maintenance.compact(spark, _stored(spark, sf_dir), target)
    return spark.read.parquet(target)


@query("cluster_table", duck(LINES))
def cluster_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fresh_dir(spark, "cluster")
    maintenance.cluster(spark, _stored(spark, sf_dir), target, ["l_partkey", "l_suppkey"])
    return spark.read.parquet(target)


_STAT_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query(
    "column_stats",
    duck(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(min({c}) AS STRING) AS min_value, CAST(max({c}) AS STRING) AS max_value, CAST(count(*) - count({c}) AS BIGINT) AS null_count, TRUE AS estimate_near FROM {{orders}}"
            for c in _STAT_COLUMNS
        )
    ),
)
def column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct estimate is checked against the exact number here, within ten percent."""
    rows = table(spark, sf_dir, "orders").select(*_STAT_COLUMNS)
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in _STAT_COLUMNS]).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("exact")) for c in _STAT_COLUMNS]))
    )
    near = F.abs(F.col("distinct_estimate") - F.col("exact")) <= 0.1 * F.col("exact")
    return maintenance.column_stats(rows).join(exact, "column_name").select(
        "column_name", "min_value", "max_value", "null_count", near.alias("estimate_near")
    )


@query(
    "table_stats",
    duck("SELECT 'lines' AS table_name, CAST(count(*) AS BIGINT) AS row_count, 14 AS column_count, TRUE AS has_bytes FROM {lineitem}"),
)
def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = maintenance.table_stats(spark, "lines", _stored(spark, sf_dir))
    return stats.select("table_name", "row_count", "column_count", ((F.col("size_bytes") > 0) & (F.col("size_mb") >= 0)).alias("has_bytes"))


@query(
    "describe_table",
    duck(
        "SELECT p AS position, c AS column_name, t AS data_type, CAST(n AS BIGINT) AS value_count FROM ("
        "SELECT 1 AS p, 'o_orderkey' AS c, 'bigint' AS t, count(o_orderkey) AS n FROM {orders} UNION ALL SELECT 2, 'o_custkey', 'bigint', count(o_custkey) FROM {orders} "
        "UNION ALL SELECT 3, 'o_orderstatus', 'string', count(o_orderstatus) FROM {orders} UNION ALL SELECT 4, 'o_totalprice', 'double', count(o_totalprice) FROM {orders} "
        "UNION ALL SELECT 5, 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM {orders} "
        "UNION ALL SELECT 6, 'o_orderpriority', 'string', count(o_orderpriority) FROM {orders}) d"
    ),
)
def describe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.describe(table(spark, sf_dir, "orders"))


@query("maintain_tables", duck("SELECT t AS table_name, m AS moment, n AS row_count FROM (SELECT 'customer' AS t, CAST(count(*) AS BIGINT) AS n FROM {customer} UNION ALL SELECT 'lines', CAST(count(*) AS BIGINT) FROM {lineitem}) x, (SELECT 'before' AS m UNION ALL SELECT 'after') y"))
def maintain_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"lines": _stored(spark, sf_dir), "customer": f"{sf_dir}/customer.parquet"}
    done = maintenance.maintain(spark, tables, fresh_dir(spark, "maintained"), {"lines": ["l_partkey"]})
    return done.select("table_name", "moment", "row_count")


# --- streams ------------------------------------------------------------------------------------
EVENT_SPEC = FeedSpec(
    "events",
    (
        FieldSpec("event_id", "LONG", nullable=False, role="ismergekey"), FieldSpec("user_id", "LONG"),
        FieldSpec("event_type"), FieldSpec("value", "DECIMAL", 18, 2),
    ),
    header=NAMES, mode=DELTA_FROM_NON_HISTORIZED, file_policy="each",
)
_SHOWN = ", ".join(feeds.EVENT_COLUMNS)
_OF_FEED = f"SELECT * FROM ({feeds.EVENTS}) e WHERE received LIKE 'events_2%'"


def _staged_events(spark: SparkSession, sf_dir: str, runs: int = 1) -> tuple[DataFrame, list[stream.StreamResult]]:
    target, checkpoint = fresh_dir(spark, "staging"), fresh_dir(spark, "checkpoint")
    source = feeds.events_csv(spark, sf_dir)
    results = [
        stream.run_into_staging(stream.read_stream(spark, source, EVENT_SPEC), target, checkpoint)
        for _ in range(runs)
    ]
    return spark.read.parquet(target), results


@query("stream_ingest", duck(f"SELECT received AS FILE_NAME_RECEIVED, {_SHOWN} FROM ({_OF_FEED}) f"))
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _staged_events(spark, sf_dir)
    return rows.select("FILE_NAME_RECEIVED", *feeds.EVENT_COLUMNS)


@query("stream_file_filter", duck(f"SELECT received AS FILE_NAME_RECEIVED, CAST(count(*) AS BIGINT) AS rows FROM ({_OF_FEED}) f GROUP BY 1"))
def stream_file_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _staged_events(spark, sf_dir)
    return rows.groupBy("FILE_NAME_RECEIVED").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "stream_metadata",
    duck(
        "SELECT event_id, received AS FILE_NAME_RECEIVED, received AS path_end, CAST(substr(received, 8, 4) AS INT) AS yyyy, CAST(substr(received, 12, 2) AS INT) AS mm, CAST(substr(received, 14, 2) AS INT) AS dd, TRUE AS stamped "
        f"FROM ({_OF_FEED}) f"
    ),
)
def stream_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedloom.functions.filenames import received_name

    rows, _ = _staged_events(spark, sf_dir)
    return rows.select(
        "event_id", "FILE_NAME_RECEIVED", received_name(F.col("FILE_PATH_RECEIVED")).alias("path_end"),
        "yyyy", "mm", "dd", F.col("INGESTION_TIMESTAMP").isNotNull().alias("stamped"),
    )


@query("stream_idempotent", duck(f"SELECT received AS FILE_NAME_RECEIVED, {_SHOWN} FROM ({_OF_FEED}) f"))
def stream_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream run three times over the same files."""
    rows, results = _staged_events(spark, sf_dir, runs=3)
    if [r.status for r in results[1:]] != ["NO_DATA", "NO_DATA"]:
        raise RuntimeError(f"a repeated run took rows again: {results}")
    return rows.select("FILE_NAME_RECEIVED", *feeds.EVENT_COLUMNS)


@query(
    "staging_to_final",
    duck(
        f"SELECT side, replace(received, '.csv', '') AS FILE_NAME_RECEIVED, CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS BIGINT) AS user_id, event_type, CAST(value AS DOUBLE) AS value, "
        f"CAST(substr(received, 8, 4) AS INT) AS yyyy, CAST(substr(received, 14, 2) AS INT) AS dd FROM ({_OF_FEED}) f, (SELECT 'all' AS side UNION ALL SELECT 'last') s"
    ),
)
def staging_to_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream fills a staging table, a load takes what is there and leaves it empty."""
    store, staging = TableStore(spark, fresh_dir(spark, "tables")), Staging(spark, fresh_dir(spark, "staging"), EVENT_SPEC)
    staging.fill(feeds.events_csv(spark, sf_dir), fresh_dir(spark, "checkpoint"))
    staging.consume(store, fresh_dir(spark, "logs"))
    if not staging.rows().isEmpty():
        raise RuntimeError("rows are left in the staging table")
    sides = [
        df.select(
            F.lit(side).alias("side"), "FILE_NAME_RECEIVED", "event_id", "user_id", "event_type",
            F.col("value").cast("double").alias("value"), "yyyy", "dd",
        )
        for side, df in (("all", store.history("events")), ("last", store.current("events")))
    ]
    return sides[0].unionByName(sides[1])


@query(
    "staging_stats",
    duck(f"SELECT 'events_staging' AS table_name, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT received) AS BIGINT) AS sources FROM ({_OF_FEED}) f"),
)
def staging_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _staged_events(spark, sf_dir)
    return stream.staging_stats({"events_staging": rows})


@query(
    "schema_evolution",
    duck(f"SELECT event_id, event_type, CASE WHEN CAST(event_id AS BIGINT) % 2 = 1 THEN value END AS value FROM ({feeds.EVENTS}) e"),
)
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column appears with the second append; the older rows read as NULL."""
    rows, path = sql(spark, sf_dir, feeds.EVENTS), fresh_dir(spark, "evolving")
    even = F.col("event_id").cast("long") % 2 == 0
    write_partitioned(rows.where(even).select("event_id", "event_type"), path)
    write_partitioned(rows.where(~even).select("event_id", "event_type", "value"), path)
    return read_table(spark, path)
