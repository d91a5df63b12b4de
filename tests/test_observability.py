import pytest
from pyspark.sql import functions as F

from feedloom.observability import dashboards, maintenance, reports
from feedloom.sinks.tables import catalog_tables
from feedloom.sources.listing import list_files

DAY = "2025-09-06"
PARTS = "yyyy int, mm int, dd int"


def run_log(spark, statuses, duration=1.0):
    rows = [("t", f"f{i}", s, 5, 0, duration, "", 2025, 9, 6) for i, s in enumerate(statuses)]
    df = spark.createDataFrame(rows, f"table_name string, filename string, status string, row_count long, error_count long, duration double, error_message string, {PARTS}")
    return df.withColumn("log_ts", F.lit(f"{DAY} 10:00:00").cast("timestamp"))


def quality_log(spark, n, message="REJECT"):
    rows = [("t", f"f{i % 3}", "c", message, 2) for i in range(n)]
    df = spark.createDataFrame(rows, "table_name string, filename string, column_name string, error_message string, error_count long")
    return df.withColumn("log_ts", F.lit(f"{DAY} 10:00:00").cast("timestamp"))


@pytest.mark.parametrize("ok,ko,label", [(4, 0, "COMPLETE"), (3, 1, "PARTIAL"), (2, 1, "FAILURE"), (0, 0, "FAILURE")])
def test_success_rate(spark, ok, ko, label):
    log = run_log(spark, ["SUCCESS"] * ok + ["FAILED"] * ko) if ok + ko else run_log(spark, ["SUCCESS"]).where("false")
    row = reports.success_rate(log, DAY).first()
    assert (row["succeeded"], row["failed"], row["run_status"]) == (ok, ko, label)


@pytest.mark.parametrize("n,severity", [(0, None), (99, "warning"), (100, "critical")])
def test_alert_severity(spark, n, severity):
    found = {r["alert"]: r for r in reports.alerts(run_log(spark, ["SUCCESS"]), quality_log(spark, n) if n else quality_log(spark, 1).where("false"), DAY).collect()}
    assert found.get("QUALITY", {"severity": None})["severity"] == severity and "PERFORMANCE" not in found
    if n:
        assert found["QUALITY"]["details"] == f"REJECT: {2 * n}"


def test_slow_files_and_recommendations(spark, rows):
    slow = reports.alerts(run_log(spark, ["SUCCESS", "FAILED"], 61.0), quality_log(spark, 1), DAY)
    assert ("PERFORMANCE", "info", 1) in rows(slow, "alert", "severity", "occurrences")
    inventory = spark.createDataFrame([("a_all", 10_000_001), ("b_all", 10_000_000)], "table_name string, rows long")
    advice = reports.recommendations(run_log(spark, ["FAILED"] + ["SUCCESS"] * 9), quality_log(spark, 101), inventory, DAY)
    assert rows(advice, "rule", "subject") == [("large table", "a_all"), ("many quality errors", "quality log")]


def test_panels_work_without_date_columns(spark, rows):
    log = quality_log(spark, 4)
    assert rows(dashboards.top_errors(log, DAY)) == [("REJECT", 4, 8)]
    assert rows(dashboards.errors_by_table(log, DAY)) == [("t", 3, 4, 8)]
    assert rows(dashboards.errors_by_column(log, DAY, table="other")) == []


def test_rates_of_files_without_duration(spark):
    assert reports.slowest_files(run_log(spark, ["SUCCESS"], 0.0), DAY).first()["rows_per_sec"] is None


def test_compaction_and_clustering(spark, tmp_path):
    source, small, ordered = (str(tmp_path / n) for n in ("t", "small", "ordered"))
    rows = spark.range(4000).select((F.col("id") * 7919 % 4001).alias("k"), F.lit(2025).alias("yyyy"), F.lit(9).alias("mm"), F.lit(2).alias("dd"))
    rows.repartition(12).write.partitionBy("yyyy", "mm", "dd").parquet(source)
    maintenance.compact(spark, source, small)
    maintenance.cluster(spark, source, ordered, ["k"])
    before, after = list_files(spark, source, "*.parquet").count(), list_files(spark, small, "*.parquet").count()
    assert before == 12 and after == 1
    for path in (small, ordered):
        assert spark.read.parquet(path).exceptAll(rows).isEmpty() and spark.read.parquet(path).count() == 4000
    spread = spark.read.parquet(ordered).groupBy(F.input_file_name()).agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("a").collect()
    assert all(x["b"] <= y["a"] for x, y in zip(spread, spread[1:]))


def test_statistics_of_a_catalog_table(spark):
    spark.sql("DROP TABLE IF EXISTS stat_all")
    spark.range(10).write.saveAsTable("stat_all")
    try:
        maintenance.analyze(spark, "stat_all")
        told = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED stat_all").collect()}
        assert "10 rows" in told["Statistics"]
        spark.range(3).createOrReplaceTempView("seen_all")
        found = catalog_tables(spark, "_all")
        assert "seen_all" not in found
        assert reports.table_inventory({"stat_all": found["stat_all"]}).first()["rows"] == 10
    finally:
        spark.sql("DROP TABLE stat_all")


def test_clustered_files_are_sorted_and_cover_small_ranges(spark, tmp_path):
    from pathlib import Path

    import pyarrow.parquet as pq

    from feedloom.sinks.tables import TableStore

    rows = spark.range(4000).select(
        F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("k"), F.lit(2025).alias("yyyy"), (F.col("id") % 3 + 1).cast("int").alias("mm"), F.lit(1).alias("dd")
    )
    rows.repartition(6).write.parquet(str(tmp_path / "in"))
    maintenance.cluster(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["k"])
    files = list(Path(tmp_path / "out").rglob("*.parquet"))
    assert len(files) < 12
    for f in files:
        keys = pq.read_table(f, partitioning=None)["k"].to_pylist()
        assert keys == sorted(keys)
    store = TableStore(spark, str(tmp_path / "tables"))
    store.replace_current("t", rows, "a")
    maintenance.cluster_current(store, "t", "b", ["k"])
    maintenance.compact_current(store, "t", "c")
    assert store.current("t").exceptAll(rows).isEmpty() and store.current("t").count() == 4000
    assert [c["load_id"] for c in store.commits("t")] == ["a", "b", "c"]
