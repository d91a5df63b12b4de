"""Work per task that must not grow with the tables."""

import os

import pytest
from pyspark.sql import functions as F

from feedloom.operators import gates
from feedloom.plans import ingest
from feedloom.sinks.tables import TableStore
from feedloom.sources.delimited import FILE
from feedloom.specs import FULL_SNAPSHOT, MERGE, FeedSpec, FieldSpec
from feedloom.workload import feeds
from feedloom.workload import rows as row_queries
from feedloom.workload import tables as table_queries
from feedloom.workload.scans import order_spec

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_broadcasts(spark):
    """Tables of a few rows are broadcast, the rows of the feed are not, as at large sizes."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "20000")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("policy", ["each", "merge"])
def test_judged_rows_are_joined_without_a_shuffle(spark, small_broadcasts, policy):
    fields = feeds.fields(qty={"on_error": "REJECT"}) if policy == "merge" else feeds.ORDER_FIELDS
    spec = order_spec(fields=fields, file_policy=policy)
    rows = ingest.stage(row_queries.orders(spark, DATA), spec)
    load = ingest.judge(spec, rows, rows.select(F.col(FILE).alias("file_name")).distinct())
    for df in (load.accepted, load.refused, ingest.rejected_lines(load, rows)):
        assert "SortMergeJoin" not in plan(df) and "hashpartitioning" not in plan(df)
    for df in (load.errors, load.runs):
        assert "hashpartitioning(_file" not in plan(df)
    assert load.accepted.count() + load.refused.count() == rows.count() == 1500


def test_rows_meet_verdicts_without_a_shuffle(spark, small_broadcasts):
    rows = row_queries.typed(spark, DATA)
    _, verdicts = row_queries.verdicts_of(rows, feeds.ORDER_FIELDS)
    found = plan(gates.judge_rows(rows, verdicts, row_queries.UNIT))
    assert "SortMergeJoin" not in found and "hashpartitioning" not in found


def test_a_snapshot_of_one_unit_is_written_once_and_unsorted(spark, tmp_path, monkeypatch, rows):
    (tmp_path / "in").mkdir()
    for day in ("02", "03"):
        (tmp_path / "in" / f"site_202509{day}_120001.csv").write_text("".join(f"{i},a{i}\n" for i in range(5)))
    spec = FeedSpec("site", (FieldSpec("id", "LONG"), FieldSpec("name")), filename_pattern="site_<yyyy><mm><dd>_<hhmmss>.csv", mode=FULL_SNAPSHOT, file_policy=MERGE)
    store, key, seen = TableStore(spark, str(tmp_path / "tables")), "spark.sql.maxConcurrentOutputFileWriters", []
    add = TableStore.add_history
    monkeypatch.setattr(TableStore, "add_history", lambda self, *a: (seen.append(spark.conf.get(key)), add(self, *a))[1])
    for load in ("one", "two"):
        ingest.ingest(spark, str(tmp_path / "in"), spec, store, str(tmp_path / "logs"), load_id=load)
    assert seen == ["8", "8"] and spark.conf.get(key) == "0"
    assert not (tmp_path / "tables" / "site_last").exists()
    assert store.history("site").count() == 20 and "FILE_PROCESS_DATE" not in store.current("site").columns
    assert rows(store.current("site"), "id", "name", "dd") == sorted([(i, f"a{i}", 2) for i in range(5)] * 2)


def test_parts_of_the_stored_lines_grow_with_the_table(spark, monkeypatch):
    assert table_queries._parts(spark, DATA) == table_queries.LEAST_PARTS
    monkeypatch.setattr(table_queries, "PART_BYTES", 4096)
    assert table_queries._parts(spark, DATA) == -(-os.path.getsize(f"{DATA}/lineitem.parquet") // 4096) > table_queries.LEAST_PARTS
