"""Queries over the two logs: dashboards and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.observability import dashboards, reports
from feedloom.workload import feeds
from feedloom.workload.registry import TABLES, duck, query, sql, table

RUN_DAY, ERROR_DAY = feeds.AS_OF_RUNS, feeds.AS_OF_ERRORS
_X, _Q = feeds.EXECUTION, feeds.QUALITY
_TODAY = f"CAST(log_ts AS DATE) = DATE '{RUN_DAY}'"
_ERR_TODAY = f"CAST(log_ts AS DATE) = DATE '{ERROR_DAY}'"
_MONTH = "yyyy = 1998 AND mm = 7"
_ERR_MONTH = "yyyy = 2024 AND mm = 1"
_ERRORS = "CAST(sum(error_count) AS BIGINT)"
_OK = "CAST(count(*) FILTER (status = 'SUCCESS') AS BIGINT)"
_KO = "CAST(count(*) FILTER (status = 'FAILED') AS BIGINT)"


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, _X)


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, _Q)


def _times(df: DataFrame) -> DataFrame:
    return df.withColumn("log_ts", F.col("log_ts").cast("string"))


@query(
    "recent_executions",
    duck(
        f"SELECT table_name, input_format, filename, row_count, column_count, status, error_count, env, round(duration, 2) AS duration_sec, CAST(log_ts AS STRING) AS log_ts FROM ({_X}) x ORDER BY x.log_ts DESC, filename LIMIT 20"
    ),
)
def recent_executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(dashboards.recent_executions(executions(spark, sf_dir)))


@query(
    "stats_by_table",
    duck(
        f"SELECT table_name, CAST(count(*) AS BIGINT) AS total_runs, {_OK} AS success_count, {_KO} AS failed_count, round(avg(duration), 2) AS avg_duration_sec, "
        f"CAST(sum(row_count) AS BIGINT) AS total_rows_processed, {_ERRORS} AS total_errors FROM ({_X}) x WHERE {_MONTH} GROUP BY table_name"
    ),
)
def stats_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.stats_by_table(executions(spark, sf_dir), RUN_DAY)


@query(
    "top_errors",
    duck(
        f"SELECT error_message, CAST(count(*) AS BIGINT) AS occurrence_count, {_ERRORS} AS total_error_count FROM ({_Q}) q WHERE {_ERR_MONTH} AND error_message IS NOT NULL GROUP BY error_message ORDER BY total_error_count DESC, error_message LIMIT 10"
    ),
)
def top_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.top_errors(errors(spark, sf_dir), ERROR_DAY)


@query(
    "errors_by_table",
    duck(
        f"SELECT table_name, CAST(count(DISTINCT filename) AS BIGINT) AS file_count, CAST(count(*) AS BIGINT) AS error_occurrence_count, {_ERRORS} AS total_errors FROM ({_Q}) q WHERE {_ERR_MONTH} GROUP BY table_name"
    ),
)
def errors_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.errors_by_table(errors(spark, sf_dir), ERROR_DAY)


@query(
    "errors_by_column",
    duck(
        f"SELECT table_name, column_name, error_message, {_ERRORS} AS total_errors FROM ({_Q}) q WHERE {_ERR_MONTH} GROUP BY ALL ORDER BY total_errors DESC, table_name, column_name, error_message LIMIT 20"
    ),
)
def errors_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.errors_by_column(errors(spark, sf_dir), ERROR_DAY)


_TREND = f"SELECT yyyy, mm, dd, CAST(count(*) AS BIGINT) AS total_executions, {_OK} AS successes, {_KO} AS failures, CAST(sum(row_count) AS BIGINT) AS total_rows FROM ({_X}) x WHERE log_ts >= DATE '{RUN_DAY}' - {{days}} GROUP BY yyyy, mm, dd"


@query("daily_trend", duck(_TREND.replace("{days}", "7")))
def daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.daily_trend(executions(spark, sf_dir), RUN_DAY, 7)


@query(
    "daily_trend_label",
    duck(
        "SELECT yyyy || '-' || lpad(CAST(mm AS STRING), 2, '0') || '-' || lpad(CAST(dd AS STRING), 2, '0') AS date, total_executions AS nb_executions, successes AS nb_success, total_rows FROM ("
        + _TREND.replace("{days}", "30") + ") t"
    ),
)
def daily_trend_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.daily_trend_label(executions(spark, sf_dir), RUN_DAY, 30)


@query(
    "duration_by_table",
    duck(
        f"SELECT table_name, round(avg(duration), 2) AS avg_duration_sec, round(max(duration), 2) AS max_duration_sec, CAST(count(*) AS BIGINT) AS nb_executions FROM ({_X}) x WHERE log_ts >= DATE '{RUN_DAY}' - 7 GROUP BY table_name"
    ),
)
def duration_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.duration_by_table(executions(spark, sf_dir), RUN_DAY)


@query(
    "failures_last_week",
    duck(f"SELECT table_name, filename, error_message, CAST(log_ts AS STRING) AS log_ts FROM ({_X}) x WHERE log_ts >= DATE '{RUN_DAY}' - 7 AND status = 'FAILED'"),
)
def failures_last_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(dashboards.failures_last_week(executions(spark, sf_dir), RUN_DAY))


_SITES = "SELECT DISTINCT 'n' || CAST(o_custkey % 400 AS STRING) || '_all' AS table_name FROM {orders} UNION SELECT DISTINCT 'n' || CAST(o_custkey % 5 AS STRING) || '_last' AS table_name FROM {orders}"
_SITE_RUNS = "SELECT 'n' || CAST(o_custkey % 400 AS STRING) || '_all' AS table_name, o_orderdate AS log_ts, CAST(year(o_orderdate) AS INT) AS yyyy, CAST(month(o_orderdate) AS INT) AS mm, CAST(day(o_orderdate) AS INT) AS dd FROM {orders}"


@query(
    "untreated_tables",
    duck(f"SELECT table_name FROM ({_SITES}) s WHERE table_name LIKE '%_all' AND table_name NOT IN (SELECT table_name FROM ({_SITE_RUNS}) r WHERE {_TODAY})"),
)
def untreated_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.untreated_tables(sql(spark, sf_dir, _SITES), sql(spark, sf_dir, _SITE_RUNS), RUN_DAY)


# --- reports ------------------------------------------------------------------------------------
@query(
    "today_details",
    duck(f"SELECT table_name, filename, row_count, column_count, error_count, status, round(duration, 2) AS duration, strftime(log_ts, '%H:%M:%S') AS time FROM ({_X}) x WHERE {_TODAY}"),
)
def today_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.today_details(executions(spark, sf_dir), RUN_DAY)


@query(
    "today_file_stats",
    duck(f"SELECT CAST(sum(row_count) AS BIGINT) AS total_rows, {_ERRORS} AS total_errors, round(avg(duration), 2) AS avg_duration, round(max(duration), 2) AS max_duration FROM ({_X}) x WHERE {_TODAY}"),
)
def today_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.today_file_stats(executions(spark, sf_dir), RUN_DAY)


@query(
    "successful_files",
    duck(f"SELECT table_name, filename, row_count, round(duration, 1) AS duration, strftime(log_ts, '%H:%M:%S') AS time FROM ({_X}) x WHERE {_TODAY} AND status = 'SUCCESS'"),
)
def successful_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.successful_files(executions(spark, sf_dir), RUN_DAY)


@query(
    "failed_today",
    duck(f"SELECT table_name, filename, error_message, strftime(log_ts, '%H:%M:%S') AS time FROM ({_X}) x WHERE {_TODAY} AND status = 'FAILED'"),
)
def failed_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.failed_today(executions(spark, sf_dir), RUN_DAY)


# The execution log moved to the day of the errors, so that both speak of the same day and files.
_SAME_DAY = f"""
SELECT table_name, 'orders_' || CAST(row_count % 400 AS STRING) || '.csv' AS filename, error_message, status,
  TIMESTAMP '{ERROR_DAY} 08:30:00' AS log_ts, 2024 AS yyyy, 1 AS mm, 15 AS dd FROM ({_X}) x
"""


@query(
    "rejected_files",
    duck(
        f"""WITH x AS ({_SAME_DAY}), f AS (SELECT * FROM x WHERE status = 'FAILED'),
        n AS (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY log_ts, table_name, error_message) AS rn FROM ({_Q}) q WHERE {_ERR_TODAY} AND column_name = 'filename')
        SELECT filename, table_name, CASE WHEN error_message = '' THEN 'Unknown error' ELSE error_message END AS reason, '08:30:00' AS time FROM f
        UNION ALL SELECT filename, table_name, error_message, strftime(log_ts, '%H:%M:%S') FROM n WHERE rn = 1 AND filename NOT IN (SELECT filename FROM f)"""
    ),
)
def rejected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rejected_files(sql(spark, sf_dir, _SAME_DAY), errors(spark, sf_dir), ERROR_DAY)


@query(
    "quality_by_type",
    duck(f"SELECT error_message, {_ERRORS} AS total_errors, CAST(count(DISTINCT table_name) AS BIGINT) AS tables_affected FROM ({_Q}) q WHERE {_ERR_TODAY} GROUP BY error_message ORDER BY total_errors DESC, error_message LIMIT 10"),
)
def quality_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.quality_by_type(errors(spark, sf_dir), ERROR_DAY)


@query(
    "quality_by_table",
    duck(f"SELECT table_name, {_ERRORS} AS total_errors, CAST(count(DISTINCT column_name) AS BIGINT) AS columns_affected FROM ({_Q}) q WHERE {_ERR_TODAY} GROUP BY table_name"),
)
def quality_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.quality_by_table(errors(spark, sf_dir), ERROR_DAY)


@query(
    "quality_totals",
    duck(f"SELECT coalesce({_ERRORS}, 0) AS total_errors, CAST(count(DISTINCT table_name) AS BIGINT) AS tables_affected FROM ({_Q}) q WHERE {_ERR_TODAY}"),
)
def quality_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.quality_totals(errors(spark, sf_dir), ERROR_DAY)


@query(
    "throughput_by_table",
    duck(
        f"SELECT table_name, CAST(count(*) AS BIGINT) AS executions, CAST(sum(row_count) AS BIGINT) AS total_rows, round(avg(duration), 2) AS avg_dur, round(min(duration), 2) AS min_dur, round(max(duration), 2) AS max_dur, "
        f"round(sum(row_count) / sum(duration), 0) AS rows_per_sec FROM ({_X}) x WHERE {_TODAY} GROUP BY table_name"
    ),
)
def throughput_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.throughput_by_table(executions(spark, sf_dir), RUN_DAY)


@query(
    "slowest_files",
    duck(
        f"SELECT table_name, filename, row_count, round(duration, 2) AS duration, round(row_count / d, 0) AS rows_per_sec FROM (SELECT *, duration AS d FROM ({_X}) x WHERE {_TODAY} ORDER BY duration DESC, filename LIMIT 5) y"
    ),
)
def slowest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.slowest_files(executions(spark, sf_dir), RUN_DAY)


@query(
    "critical_errors",
    duck(f"SELECT DISTINCT table_name, filename, error_message FROM ({_Q}) q WHERE {_ERR_TODAY} AND (contains(error_message, 'ABORT') OR contains(error_message, 'REJECT'))"),
)
def critical_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.critical_errors(errors(spark, sf_dir), ERROR_DAY)


_RATE = f"SELECT {_OK} AS succeeded, {_KO} AS failed FROM ({_X}) x WHERE {_TODAY}"


@query(
    "success_rate",
    duck(
        f"SELECT succeeded, failed, round(succeeded * 100.0::DOUBLE / (succeeded + failed), 0) AS success_rate, CASE WHEN failed = 0 THEN 'COMPLETE' WHEN succeeded * 100.0 / (succeeded + failed) >= 75 THEN 'PARTIAL' ELSE 'FAILURE' END AS run_status FROM ({_RATE}) r"
    ),
)
def success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.success_rate(executions(spark, sf_dir), RUN_DAY)


_SLOW = "SELECT table_name, filename, row_count, error_count, error_message, status, duration, TIMESTAMP '2024-01-15 08:30:00' AS log_ts, 2024 AS yyyy, 1 AS mm, 15 AS dd FROM ({x}) x".format(x=_X)
_TOP3 = f"SELECT error_message, {_ERRORS} AS total FROM ({_Q}) q WHERE {_ERR_TODAY} GROUP BY error_message ORDER BY total DESC, error_message LIMIT 3"


@query(
    "alerts",
    duck(
        f"SELECT 'QUALITY' AS alert, CASE WHEN n < 100 THEN 'warning' ELSE 'critical' END AS severity, n AS occurrences, (SELECT string_agg(error_message || ': ' || total, '; ' ORDER BY total DESC, error_message) FROM ({_TOP3}) t) AS details "
        f"FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM ({_Q}) q WHERE {_ERR_TODAY}) c WHERE n > 0 "
        f"UNION ALL SELECT 'PERFORMANCE', 'info', n, '' FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM ({_SLOW}) s WHERE status = 'SUCCESS' AND duration > 60) p WHERE n > 0"
    ),
)
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.alerts(sql(spark, sf_dir, _SLOW), errors(spark, sf_dir), ERROR_DAY)


_INVENTORY = "SELECT c_nationkey AS table_name, CAST(count(*) AS BIGINT) * 100000 AS rows FROM {customer} GROUP BY c_nationkey"


@query(
    "recommendations",
    duck(
        f"SELECT 'high failure rate' AS rule, 'files' AS subject, round(v, 1) AS value FROM (SELECT count(*) FILTER (status = 'FAILED') * 100.0::DOUBLE / count(*) AS v FROM ({_SLOW}) s) a WHERE v > 10 "
        f"UNION ALL SELECT 'many tables', 'tables', v FROM (SELECT CAST(count(*) AS DOUBLE) AS v FROM ({_INVENTORY}) i) b WHERE v > 10 "
        f"UNION ALL SELECT 'large table', CAST(table_name AS STRING), CAST(rows AS DOUBLE) FROM ({_INVENTORY}) i WHERE rows > 10000000 "
        f"UNION ALL SELECT 'many quality errors', 'quality log', v FROM (SELECT CAST(count(*) AS DOUBLE) AS v FROM ({_Q}) q WHERE {_ERR_TODAY}) c WHERE v > 100"
    ),
)
def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    inventory = sql(spark, sf_dir, _INVENTORY).withColumn("table_name", F.col("table_name").cast("string"))
    return reports.recommendations(sql(spark, sf_dir, _SLOW), errors(spark, sf_dir), inventory, ERROR_DAY)


@query(
    "report_json",
    duck(f"SELECT filename, table_name, row_count, status FROM ({_X}) x WHERE {_TODAY}"),
)
def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as JSON lines and read back."""
    from feedloom.session import fresh_dir

    path = fresh_dir(spark, "report")
    reports.export_json(executions(spark, sf_dir), RUN_DAY).write.text(path)
    return spark.read.schema("filename string, table_name string, row_count bigint, status string").json(path)


# --- loaded tables ------------------------------------------------------------------------------
STORED = """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'site_last' ELSE 'site_all' END AS target, o_orderkey AS k,
  'orders_' || CAST(o_custkey % 40 AS STRING) AS FILE_NAME_RECEIVED, o_orderdate AS FILE_PROCESS_DATE,
  CAST(year(o_orderdate) AS INT) AS yyyy, CAST(month(o_orderdate) AS INT) AS mm, CAST(1 AS INT) AS dd FROM {orders}
"""


def _stored(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    rows = sql(spark, sf_dir, STORED)
    return {t: rows.where(F.col("target") == t).drop("target") for t in ("site_all", "site_last")}


@query(
    "table_inventory",
    duck(
        "SELECT 'site' AS base, target AS table_name, CASE WHEN target = 'site_all' THEN 'history' ELSE 'current' END AS kind, CAST(count(*) AS BIGINT) AS rows, 6 AS columns, "
        f"CAST(count(DISTINCT yyyy * 10000 + mm * 100 + dd) AS BIGINT) AS partitions, CAST(count(DISTINCT FILE_NAME_RECEIVED) AS BIGINT) AS sources FROM ({STORED}) s GROUP BY target "
        "UNION ALL SELECT 'customer', 'customer_all', 'history', CAST(count(*) AS BIGINT), 5, CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM {customer}"
    ),
)
def table_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.table_inventory({**_stored(spark, sf_dir), "customer_all": table(spark, sf_dir, "customer")})


@query("rows_per_partition", duck(f"SELECT yyyy, mm, dd, CAST(count(*) AS BIGINT) AS row_count FROM ({STORED}) s WHERE target = 'site_all' GROUP BY ALL"))
def rows_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rows_per_partition(_stored(spark, sf_dir)["site_all"])


@query(
    "table_coverage",
    duck(f"SELECT CAST(min(FILE_PROCESS_DATE) AS STRING) AS date_min, CAST(max(FILE_PROCESS_DATE) AS STRING) AS date_max, CAST(count(DISTINCT FILE_NAME_RECEIVED) AS BIGINT) AS nb_fichiers FROM ({STORED}) s WHERE target = 'site_all'"),
)
def table_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = reports.table_coverage(_stored(spark, sf_dir)["site_all"])
    return shown.select(F.col("date_min").cast("string"), F.col("date_max").cast("string"), "nb_fichiers")


@query(
    "row_counts",
    duck(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {{{t}}}"
            for t in TABLES
        )
    ),
)
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.row_counts({t: table(spark, sf_dir, t) for t in TABLES})


@query("all_vs_last", duck(f"SELECT replace(target, 'site_', '') AS table_type, CAST(count(*) AS BIGINT) AS row_count FROM ({STORED}) s GROUP BY target"))
def all_vs_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, sf_dir)
    return reports.all_vs_last(stored["site_all"], stored["site_last"])
