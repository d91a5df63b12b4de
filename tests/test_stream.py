from feedloom.specs import NAMES, FeedSpec, FieldSpec
from feedloom.streaming import files as stream

SPEC = FeedSpec("site", (FieldSpec("ID"), FieldSpec("Name")), header=NAMES)


def test_only_new_files_are_read(spark, tmp_path, rows):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    run = lambda: stream.run_into_staging(stream.read_stream(spark, source, SPEC, 1), target, state)
    (tmp_path / "in" / "site_20250902_120001.csv").write_text("ID,Name\n1,a\n2,b\n")
    (tmp_path / "in" / "sitex_20250902.csv").write_text("ID,Name\n9,z\n")
    first = run()
    assert (first.status, first.rows) == ("SUCCESS", 2)
    assert run().status == "NO_DATA"
    (tmp_path / "in" / "site.csv").write_text("ID,Name\n3,c\n")
    assert run().rows == 1
    back = spark.read.parquet(target)
    assert rows(back, "id", "name", "FILE_NAME_RECEIVED", "yyyy", "mm", "dd") == [
        ("1", "a", "site_20250902_120001.csv", 2025, 9, 2), ("2", "b", "site_20250902_120001.csv", 2025, 9, 2), ("3", "c", "site.csv", None, None, None)
    ]
    assert rows(stream.staging_stats({"site_staging": back})) == [("site_staging", 3, 2)]


def test_feeds_are_discovered_and_matched(spark, tmp_path, rows):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "site_20250902_120001.csv").write_text("ID,Name\n1,a\n")
    (tmp_path / "in" / "deep" / "other_20250902.csv").write_text("X,Y,Z\n1,2,3\n4,5,6\n")
    (tmp_path / "in" / "notes.txt").write_text("no feed\n")
    results = stream.stream_feeds(spark, str(tmp_path / "in"), {"site": SPEC}, str(tmp_path / "out"))
    assert {k: (v.status, v.rows) for k, v in results.items()} == {"site": ("SUCCESS", 1), "other": ("SUCCESS", 2)}
    assert rows(spark.read.parquet(str(tmp_path / "out" / "other_staging")), "x", "z") == [("1", "3"), ("4", "6")]


def test_load_ids_differ_between_checkpoints(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "site_1.csv").write_text("ID,Name\n1,a\n")
    seen = []
    for state in ("a", "b", "a"):
        rows = stream.read_stream(spark, str(tmp_path / "in"), SPEC)
        stream.run_batches(rows, str(tmp_path / state), lambda df, load_id: seen.append(load_id))
    assert len(seen) == 2 and seen[0] != seen[1] and all(s.endswith("-000000000") for s in seen)


def test_a_file_with_its_columns_in_another_order_is_not_taken_wrong(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "site_1.csv").write_text("Name,ID\nann,1\n")
    (tmp_path / "in" / "other_1.csv").write_text("X,Y\n1,2\n")
    results = stream.stream_feeds(spark, str(tmp_path / "in"), {"site": SPEC}, str(tmp_path / "out"))
    assert results["site"].status == "ERROR" and "site_1.csv" in results["site"].message
    assert (results["other"].status, results["other"].rows) == ("SUCCESS", 1)


def test_stream_into_tables_with_logs(spark, tmp_path, rows):
    from feedloom.sinks import logs
    from feedloom.sinks.tables import TableStore

    (tmp_path / "in").mkdir()
    store, state, log = TableStore(spark, str(tmp_path / "tables")), str(tmp_path / "state"), str(tmp_path / "log")
    spec = FeedSpec("site", (FieldSpec("ID", "INT", nullable=False), FieldSpec("Name")), header=NAMES)
    run = lambda: stream.stream_into_tables(spark, str(tmp_path / "in"), spec, store, log, state)
    (tmp_path / "in" / "site_20250902.csv").write_text("ID,Name\n1,a\n2,b\n")
    assert run().rows == 2
    (tmp_path / "in" / "site_20250903.csv").write_text("ID,Name\n3,c\n")
    assert run().rows == 1 and run().status == "NO_DATA"
    assert rows(store.current("site"), "id", "name") == [(1, "a"), (2, "b"), (3, "c")]
    runs = logs.read_log(spark, f"{log}/execution", logs.EXECUTION_LOG)
    assert rows(runs, "filename", "row_count", "status") == [("site_20250902.csv", 2, "SUCCESS"), ("site_20250903.csv", 1, "SUCCESS")]
