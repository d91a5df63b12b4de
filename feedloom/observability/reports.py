"""Run reports: file details, quality, throughput, alerts, recommendations, table inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.observability.dashboards import count_status, of_day
from feedloom.operators import errors as E
from feedloom.operators.columns import DATE_PARTS

# Thresholds of the reports.
CRITICAL_ERRORS = 100
SLOW_SECONDS = 60
PARTIAL_SUCCESS = 75
HIGH_FAILURE = 10
MANY_TABLES = 10
LARGE_TABLE = 10_000_000


def clock(ts: str = "log_ts") -> Column:
    return F.date_format(ts, "HH:mm:ss")


def today_details(log: DataFrame, as_of: str | None = None) -> DataFrame:
    return (
        of_day(log, as_of)
        .orderBy("log_ts", "filename")
        .select(
            "table_name", "filename", "row_count", "column_count", "error_count", "status",
            F.round("duration", 2).alias("duration"), clock().alias("time"),
        )
    )


def today_file_stats(log: DataFrame, as_of: str | None = None) -> DataFrame:
    return of_day(log, as_of).agg(
        F.sum("row_count").alias("total_rows"),
        F.sum("error_count").alias("total_errors"),
        F.round(F.avg("duration"), 2).alias("avg_duration"),
        F.round(F.max("duration"), 2).alias("max_duration"),
    )


def successful_files(log: DataFrame, as_of: str | None = None) -> DataFrame:
    return (
        of_day(log, as_of)
        .where(F.col("status") == "SUCCESS")
        .orderBy("log_ts", "filename")
        .select("table_name", "filename", "row_count", F.round("duration", 1).alias("duration"), clock().alias("time"))
    )


def failed_today(log: DataFrame, as_of: str | None = None) -> DataFrame:
    return (
        of_day(log, as_of)
        .where(F.col("status") == "FAILED")
        .orderBy("log_ts", "filename")
        .select("table_name", "filename", "error_message", clock().alias("time"))
    )


def rejected_files(log: DataFrame, quality: DataFrame, as_of: str | None = None) -> DataFrame:
    """Files refused in either log; a file already failed in the execution log is not repeated."""

    def reason(default: str) -> Column:
        text = F.col("error_message")
        return F.when(text.isNull() | (text == ""), F.lit(default)).otherwise(text)

    def shaped(rows: DataFrame, default: str) -> DataFrame:
        return rows.select(
            "filename", "table_name", reason(default).alias("reason"),
            F.coalesce(clock(), F.lit("N/A")).alias("time"),
        )

    failed = of_day(log, as_of).where(F.col("status") == "FAILED")
    named = of_day(quality, as_of).where(F.col("column_name") == "filename")
    first = named.groupBy("filename").agg(
        F.min(F.struct("log_ts", "table_name", "error_message")).alias("_f")
    ).select("filename", "_f.*")
    extra = first.join(failed.select("filename").distinct(), "filename", "left_anti")
    return shaped(failed, "Unknown error").unionByName(shaped(extra, "Validation failed"))


def quality_by_type(quality: DataFrame, as_of: str | None = None, limit: int = 10) -> DataFrame:
    return (
        of_day(quality, as_of)
        .groupBy("error_message")
        .agg(F.sum("error_count").alias("total_errors"), F.count_distinct("table_name").alias("tables_affected"))
        .orderBy(F.desc("total_errors"), "error_message")
        .limit(limit)
    )


def quality_by_table(quality: DataFrame, as_of: str | None = None) -> DataFrame:
    return (
        of_day(quality, as_of)
        .groupBy("table_name")
        .agg(F.sum("error_count").alias("total_errors"), F.count_distinct("column_name").alias("columns_affected"))
        .orderBy(F.desc("total_errors"), "table_name")
    )


def quality_totals(quality: DataFrame, as_of: str | None = None) -> DataFrame:
    return of_day(quality, as_of).agg(
        F.coalesce(F.sum("error_count"), F.lit(0)).alias("total_errors"),
        F.count_distinct("table_name").alias("tables_affected"),
    )


def throughput_by_table(log: DataFrame, as_of: str | None = None) -> DataFrame:
    return (
        of_day(log, as_of)
        .groupBy("table_name")
        .agg(
            F.count(F.lit(1)).alias("executions"),
            F.sum("row_count").alias("total_rows"),
            F.round(F.avg("duration"), 2).alias("avg_dur"),
            F.round(F.min("duration"), 2).alias("min_dur"),
            F.round(F.max("duration"), 2).alias("max_dur"),
            F.round(F.try_divide(F.sum("row_count"), F.sum("duration")), 0).alias("rows_per_sec"),
        )
    )


def slowest_files(log: DataFrame, as_of: str | None = None, limit: int = 5) -> DataFrame:
    return (
        of_day(log, as_of)
        .orderBy(F.desc("duration"), "filename")
        .limit(limit)
        .select(
            "table_name", "filename", "row_count", F.round("duration", 2).alias("duration"),
            F.round(F.try_divide(F.col("row_count"), F.col("duration")), 0).alias("rows_per_sec"),
        )
    )


def critical_errors(quality: DataFrame, as_of: str | None = None) -> DataFrame:
    text = F.col("error_message")
    return (
        of_day(quality, as_of)
        .where(text.contains("ABORT") | text.contains("REJECT"))
        .select("table_name", "filename", "error_message")
        .distinct()
    )


def success_rate(log: DataFrame, as_of: str | None = None) -> DataFrame:
    """Share of files that went well, and the class of the run."""
    both = of_day(log, as_of).agg(count_status("SUCCESS").alias("succeeded"), count_status("FAILED").alias("failed"))
    total = F.col("succeeded") + F.col("failed")
    rate = F.when(total > 0, F.col("succeeded") * 100.0 / total).otherwise(F.lit(0.0))
    return both.select(
        "succeeded", "failed", F.round(rate, 0).alias("success_rate"),
        F.when(rate == 100, "COMPLETE").when(rate >= PARTIAL_SUCCESS, "PARTIAL").otherwise("FAILURE").alias("run_status"),
    )


def alerts(log: DataFrame, quality: DataFrame, as_of: str | None = None) -> DataFrame:
    """At most two alerts: errors of the day with their three main messages, and slow files."""
    messages = of_day(quality, as_of).groupBy("error_message").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("error_count").alias("_total")
    )
    # Only three rows leave the ranking, so the list built from them is bounded.
    top = messages.orderBy(F.desc("_total"), "error_message").limit(3).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("_total")).alias("o"), "error_message"))).alias("_t")
    )
    details = F.concat_ws(
        "; ", F.transform("_t", lambda x: F.concat(x["error_message"], F.lit(": "), (-x["o"]).cast("string")))
    )
    n = F.sum("_rows")
    quality_alert = messages.agg(n.alias("n")).where(F.col("n") > 0).select(
        F.lit("QUALITY").alias("alert"),
        F.when(F.col("n") < CRITICAL_ERRORS, "warning").otherwise("critical").alias("severity"),
        F.col("n").cast("long").alias("occurrences"),
        top.select(details).scalar().alias("details"),
    )
    slow = of_day(log, as_of).agg(
        F.count_if((F.col("status") == "SUCCESS") & (F.col("duration") > SLOW_SECONDS)).alias("n")
    )
    slow_alert = slow.where(F.col("n") > 0).select(
        F.lit("PERFORMANCE").alias("alert"), F.lit("info").alias("severity"),
        F.col("n").alias("occurrences"), F.lit("").alias("details"),
    )
    return quality_alert.unionByName(slow_alert)


def recommendations(log: DataFrame, quality: DataFrame, inventory: DataFrame, as_of: str | None = None) -> DataFrame:
    """Rules over the day's runs, the day's errors and the table inventory."""
    failed, total = count_status("FAILED"), F.count_if(F.col("status").isin("SUCCESS", "FAILED"))
    rate = of_day(log, as_of).agg((failed * 100.0 / F.nullif(total, F.lit(0))).alias("value"))
    tables = inventory.agg(F.count(F.lit(1)).cast("double").alias("value"))
    errors = of_day(quality, as_of).agg(F.count(F.lit(1)).cast("double").alias("value"))

    def rule(rows: DataFrame, name: str, limit: float, subject: Column) -> DataFrame:
        return rows.where(F.col("value") > limit).select(
            F.lit(name).alias("rule"), subject.alias("subject"), F.round("value", 1).alias("value")
        )

    large = inventory.select("table_name", F.col("rows").cast("double").alias("value"))
    return reduce(
        DataFrame.unionByName,
        [
            rule(rate, "high failure rate", HIGH_FAILURE, F.lit("files")),
            rule(tables, "many tables", MANY_TABLES, F.lit("tables")),
            rule(large, "large table", LARGE_TABLE, F.col("table_name")),
            rule(errors, "many quality errors", CRITICAL_ERRORS, F.lit("quality log")),
        ],
    )


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns, dates and source files of many tables, in one aggregate."""
    tagged = []
    for name, df in sorted(tables.items()):
        parts = [F.col(p) if p in df.columns else F.lit(None) for p in DATE_PARTS]
        source = F.col("FILE_NAME_RECEIVED") if "FILE_NAME_RECEIVED" in df.columns else F.lit(None)
        tagged.append(
            df.select(
                F.lit(name).alias("table_name"),
                F.lit(len(df.columns)).alias("columns"),
                *[c.cast("int").alias(p) for c, p in zip(parts, DATE_PARTS)],
                source.cast("string").alias("source"),
            )
        )
    # Rows collapse to one per table, date and file before anything is counted distinct.
    level = reduce(DataFrame.unionByName, tagged).groupBy("table_name", "columns", *DATE_PARTS, "source").agg(
        F.count(F.lit(1)).alias("n")
    )
    counted = level.groupBy("table_name", "columns").agg(
        F.sum("n").alias("rows"),
        F.count_distinct(F.when(F.col("yyyy").isNotNull(), F.struct(*DATE_PARTS))).alias("partitions"),
        F.count_distinct("source").alias("sources"),
    )
    history = F.col("table_name").contains("_all")
    return counted.select(
        F.regexp_replace("table_name", "_all|_last", "").alias("base"),
        "table_name",
        F.when(history, "history").otherwise("current").alias("kind"),
        "rows", "columns", "partitions", "sources",
    )


def final_metrics(rows: DataFrame, errors: DataFrame) -> DataFrame:
    """Rows after the load, rows behind typing and reject errors, rows clean, error rows.

    ``by_text`` looks for the words in the message (case-sensitive, so INVALID_DATE is left out);
    ``by_kind`` goes by the kind of error.
    """
    text = F.col("error_message")
    worded = text.contains("Invalid") | text.contains("TYPE MISMATCH") | text.contains("REJECT")
    kinds = [E.INVALID_DATE, E.REJECT, E.LINE_REJECT, E.TYPE_MISMATCH, "INVALID_FILENAME"]
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("error_count"))), F.lit(0))
    found = errors.agg(
        total(worded).alias("corrupt_rows"),
        total(F.col("error_kind").isin(kinds)).alias("corrupt_rows_by_kind"),
        F.count(F.lit(1)).alias("anomalies_total"),
    )
    after = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    return found.select(
        after.alias("total_rows_after"), "corrupt_rows", "corrupt_rows_by_kind",
        (after - F.col("corrupt_rows")).alias("cleaned_rows"), "anomalies_total",
    )


def error_summary(errors: DataFrame, limit: int = 50) -> DataFrame:
    """Largest error messages, those about nulls told apart."""
    return (
        errors.groupBy("error_message")
        .agg(F.sum("error_count").alias("total_count"))
        .orderBy(F.desc("total_count"), "error_message")
        .limit(limit)
        .withColumn(
            "family", F.when(F.lower("error_message").contains("null"), "null").otherwise("type")
        )
    )


def file_line(runs: DataFrame) -> DataFrame:
    """One line per file: clean or not, rows, errors."""
    return runs.select(
        "filename", F.when(F.col("error_count") == 0, "ok").otherwise("warning").alias("state"),
        "row_count", "error_count",
    )


def export_json(log: DataFrame, as_of: str | None = None) -> DataFrame:
    """The day's executions as JSON lines."""
    rows = of_day(log, as_of)
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("json"))


def rows_per_partition(table: DataFrame) -> DataFrame:
    return (
        table.groupBy(*DATE_PARTS).agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(*[F.desc(p) for p in DATE_PARTS])
    )


def table_coverage(table: DataFrame) -> DataFrame:
    return table.agg(
        F.min("FILE_PROCESS_DATE").alias("date_min"),
        F.max("FILE_PROCESS_DATE").alias("date_max"),
        F.count_distinct("FILE_NAME_RECEIVED").alias("nb_fichiers"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n, df in sorted(tables.items())
    ]
    return reduce(DataFrame.unionByName, counts)


def all_vs_last(history: DataFrame, current: DataFrame) -> DataFrame:
    sides = {"all": history, "last": current}
    return row_counts(sides).withColumnRenamed("table_name", "table_type")
