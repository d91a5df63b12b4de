"""Dashboard panels: functions from a log to a DataFrame, without actions inside.

``as_of`` stands for today. Where a panel filters by time, the partition columns of the log are
filtered too, so only the partitions of the period are listed and read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.columns import DATE_PARTS


def day(as_of: str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def _partitioned(log: DataFrame) -> bool:
    return all(p in log.columns for p in DATE_PARTS)


def _partition_date() -> Column:
    return F.make_date("yyyy", "mm", "dd")


def of_month(log: DataFrame, as_of: str | None) -> DataFrame:
    """Rows of the month of ``as_of``; a log without date columns is taken whole."""
    if not ("yyyy" in log.columns and "mm" in log.columns):
        return log
    today = day(as_of)
    return log.where((F.col("yyyy") == F.year(today)) & (F.col("mm") == F.month(today)))


def of_day(log: DataFrame, as_of: str | None) -> DataFrame:
    today = day(as_of)
    rows = log.where(F.to_date("log_ts") == today)
    return rows.where(_partition_date() == today) if _partitioned(log) else rows


def since(log: DataFrame, as_of: str | None, days: int) -> DataFrame:
    first = F.date_sub(day(as_of), days)
    rows = log.where(F.col("log_ts") >= first)
    return rows.where(_partition_date() >= first) if _partitioned(log) else rows


def count_status(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def _errors() -> Column:
    return F.sum(F.col("error_count").cast("bigint"))


def recent_executions(log: DataFrame, limit: int = 20) -> DataFrame:
    return (
        log.select(
            "table_name", "input_format", "filename", "row_count", "column_count", "status",
            "error_count", "env", F.round("duration", 2).alias("duration_sec"), "log_ts",
        )
        .orderBy(F.desc("log_ts"), "filename")
        .limit(limit)
    )


def stats_by_table(log: DataFrame, as_of: str | None = None) -> DataFrame:
    return (
        of_month(log, as_of)
        .groupBy("table_name")
        .agg(
            F.count(F.lit(1)).alias("total_runs"),
            count_status("SUCCESS").alias("success_count"),
            count_status("FAILED").alias("failed_count"),
            F.round(F.avg("duration"), 2).alias("avg_duration_sec"),
            F.sum("row_count").alias("total_rows_processed"),
            F.sum("error_count").alias("total_errors"),
        )
        .orderBy(F.desc("total_runs"), "table_name")
    )


def top_errors(quality: DataFrame, as_of: str | None = None, limit: int = 10) -> DataFrame:
    return (
        of_month(quality, as_of)
        .where(F.col("error_message").isNotNull())
        .groupBy("error_message")
        .agg(F.count(F.lit(1)).alias("occurrence_count"), _errors().alias("total_error_count"))
        .orderBy(F.desc("total_error_count"), "error_message")
        .limit(limit)
    )


def errors_by_table(quality: DataFrame, as_of: str | None = None) -> DataFrame:
    return (
        of_month(quality, as_of)
        .groupBy("table_name")
        .agg(
            F.count_distinct("filename").alias("file_count"),
            F.count(F.lit(1)).alias("error_occurrence_count"),
            _errors().alias("total_errors"),
        )
        .orderBy(F.desc("total_errors"), "table_name")
    )


def errors_by_column(
    quality: DataFrame, as_of: str | None = None, table: str | None = None, limit: int | None = 20
) -> DataFrame:
    rows = of_month(quality, as_of)
    if table is not None:
        rows = rows.where(F.col("table_name") == table)
    ranked = (
        rows.groupBy("table_name", "column_name", "error_message")
        .agg(_errors().alias("total_errors"))
        .orderBy(F.desc("total_errors"), "table_name", "column_name", "error_message")
    )
    return ranked if limit is None else ranked.limit(limit)


def daily_trend(log: DataFrame, as_of: str | None = None, days: int = 7) -> DataFrame:
    return (
        since(log, as_of, days)
        .groupBy(*DATE_PARTS)
        .agg(
            F.count(F.lit(1)).alias("total_executions"),
            count_status("SUCCESS").alias("successes"),
            count_status("FAILED").alias("failures"),
            F.sum("row_count").alias("total_rows"),
        )
        .orderBy(*[F.desc(p) for p in DATE_PARTS])
    )


def daily_trend_label(log: DataFrame, as_of: str | None = None, days: int = 30) -> DataFrame:
    label = F.concat_ws(
        "-", F.col("yyyy").cast("string"), F.lpad(F.col("mm").cast("string"), 2, "0"),
        F.lpad(F.col("dd").cast("string"), 2, "0"),
    )
    return daily_trend(log, as_of, days).select(
        label.alias("date"), F.col("total_executions").alias("nb_executions"),
        F.col("successes").alias("nb_success"), "total_rows",
    )


def duration_by_table(log: DataFrame, as_of: str | None = None, days: int = 7) -> DataFrame:
    return (
        since(log, as_of, days)
        .groupBy("table_name")
        .agg(
            F.round(F.avg("duration"), 2).alias("avg_duration_sec"),
            F.round(F.max("duration"), 2).alias("max_duration_sec"),
            F.count(F.lit(1)).alias("nb_executions"),
        )
        .orderBy(F.desc("avg_duration_sec"), "table_name")
    )


def failures_last_week(log: DataFrame, as_of: str | None = None, days: int = 7) -> DataFrame:
    return (
        since(log, as_of, days)
        .where(F.col("status") == "FAILED")
        .select("table_name", "filename", "error_message", "log_ts")
        .orderBy(F.desc("log_ts"), "filename")
    )


def untreated_tables(tables: DataFrame, log: DataFrame, as_of: str | None = None) -> DataFrame:
    """History tables without a run today; ``tables`` has a column ``table_name``."""
    wanted = tables.select("table_name").where(F.col("table_name").endswith("_all")).distinct()
    ran = of_day(log, as_of).where(F.col("table_name").isNotNull()).select("table_name").distinct()
    return wanted.join(ran, "table_name", "left_anti")


def display(log: DataFrame, quality: DataFrame, as_of: str | None = None) -> dict[str, DataFrame]:
    """All panels by title."""
    return {
        "recent_executions": recent_executions(log),
        "stats_by_table": stats_by_table(log, as_of),
        "top_errors": top_errors(quality, as_of),
        "errors_by_table": errors_by_table(quality, as_of),
        "daily_trend": daily_trend(log, as_of),
    }
