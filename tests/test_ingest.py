import pytest
from pyspark.sql import functions as F

from feedloom.observability import dashboards, reports
from feedloom.plans.ingest import LoadFailed, ingest
from feedloom.sinks import logs
from feedloom.sinks.tables import TableStore
from feedloom.specs import DELTA_FROM_NON_HISTORIZED, EACH, FIRST, FULL_SNAPSHOT, MERGE, NAMES, FeedSpec, FieldSpec, Tolerance

FIELDS = (
    FieldSpec("id", "LONG", nullable=False, role="ismergekey"), FieldSpec("name"), FieldSpec("qty", "INT", nullable=False),
    FieldSpec("since", "DATE", role="isstartvalidity"),
)
SITE = FeedSpec("site", FIELDS, filename_pattern="site_<yyyy><mm><dd>_<hhmmss>.csv", mode=FULL_SNAPSHOT, file_policy=EACH, tolerance=Tolerance(0.1, True))


class Place:
    def __init__(self, spark, root):
        self.spark, self.root, self.store = spark, root, TableStore(spark, str(root / "tables"))

    def put(self, folder="in", **files):
        (self.root / folder).mkdir(exist_ok=True)
        for name, text in files.items():
            (self.root / folder / f"{name}.csv").write_text(text)

    def load(self, spec, load_id=None, folder="in"):
        ingest(self.spark, str(self.root / folder), spec, self.store, str(self.root / "logs"), load_id=load_id)

    def runs(self):
        return logs.read_log(self.spark, str(self.root / "logs/execution"), logs.EXECUTION_LOG)

    def errors(self):
        return logs.read_log(self.spark, str(self.root / "logs/quality"), logs.QUALITY_LOG)


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path)


def lines(n, start=0, day="02/09/2025", name="n"):
    return "".join(f"{i},{name},{i % 7},{day}\n" for i in range(start, start + n))


def test_three_files_one_refused(place, rows):
    place.put(site_20250902_120001=lines(40), site_20250906_120001=lines(40, name="m"), site_20251302_120001=lines(40), other_20250902=lines(3))
    place.load(SITE)
    assert place.store.history("site").count() == 80
    last = place.store.current("site")
    assert last.count() == 40 and "FILE_PROCESS_DATE" not in last.columns
    assert rows(last.select("FILE_NAME_RECEIVED", "name", "yyyy", "mm", "dd").distinct()) == [("site_20250906_120001", "m", 2025, 9, 6)]
    runs = {r["filename"]: (r["status"], r["row_count"], r["error_message"]) for r in place.runs().collect()}
    assert runs == {
        "site_20250902_120001.csv": ("SUCCESS", 40, ""), "site_20250906_120001.csv": ("SUCCESS", 40, ""),
        "site_20251302_120001.csv": ("FAILED", 0, "Invalid date: Month 13 invalid"),
    }
    assert rows(place.errors(), "filename", "column_name", "error_message", "raw_value") == [
        ("site_20251302_120001.csv", "filename", "Invalid date: Month 13 invalid", "2025-13-02")
    ]
    rate = reports.success_rate(place.runs()).first()
    assert (rate["success_rate"], rate["run_status"]) == (67.0, "FAILURE")
    refused = reports.rejected_files(place.runs(), place.errors()).collect()
    assert [(r["filename"], r["reason"]) for r in refused] == [("site_20251302_120001.csv", "Invalid date: Month 13 invalid")]
    assert set(dashboards.display(place.runs(), place.errors())) == {"recent_executions", "stats_by_table", "top_errors", "errors_by_table", "daily_trend"}
    assert reports.all_vs_last(place.store.history("site"), last).orderBy("table_type").collect()[0]["row_count"] == 80


def test_merge_over_two_loads_and_a_retry(place, rows):
    spec = SITE.with_(mode=DELTA_FROM_NON_HISTORIZED)
    place.put(site_20250902_120001=lines(10))
    place.load(spec, "one")
    place.put("next", site_20250903_120001=lines(3, day="03/09/2025", name="newer") + lines(2, 5, "01/09/2025", "older") + lines(2, 20))
    for _ in range(2):
        place.load(spec, "two", "next")
    last = place.store.current("site")
    assert last.count() == 12 and last.select("id").distinct().count() == 12
    assert rows(last.where("name = 'newer'"), "id", "dd", "FILE_NAME_RECEIVED") == [(i, 3, "site_20250903_120001") for i in range(3)]
    assert last.where("name = 'older'").isEmpty()
    assert place.store.history("site").count() == 17


def test_files_of_one_batch_are_merged_as_if_loaded_in_turn(place, rows):
    spec = SITE.with_(mode=DELTA_FROM_NON_HISTORIZED)
    place.put(site_20250902_120001=lines(2, name="first"), site_20250903_120001=lines(2, name="second") + lines(1, 1, "09/09/2025", "latest"))
    place.load(spec)
    assert rows(place.store.current("site"), "id", "name") == [(0, "first"), (1, "latest")]


def test_merged_and_first(place, rows):
    place.put(site_20250902_120001=lines(5), site_20250903_120001=lines(5, 5))
    place.load(SITE.with_(file_policy=MERGE))
    last = place.store.current("site")
    assert last.count() == 10 and rows(last.select("FILE_NAME_RECEIVED", "dd").distinct()) == [("site_20250902_120001", 2)]
    assert rows(place.runs(), "filename") == [("merged_2_files",)]
    place.load(SITE.with_(file_policy=FIRST))
    assert place.store.current("site").count() == 5


def test_corrupt_file_and_rejects(place, rows):
    spec = SITE.with_(keep_rejects=True, fields=(FIELDS[0], FIELDS[1], FieldSpec("qty", "INT", nullable=False, on_error="REJECT"), FIELDS[3]))
    place.put(site_20250902_120001=lines(10) + "1,2\n" * 5, site_20250903_120001=lines(9) + "77,z,bad,03/09/2025\n")
    place.load(spec)
    runs = {r["filename"]: (r["status"], r["row_count"], r["error_count"], r["error_message"]) for r in place.runs().collect()}
    assert runs == {"site_20250902_120001.csv": ("FAILED", 15, 0, "Too many corrupted lines"), "site_20250903_120001.csv": ("SUCCESS", 9, 1, "1 errors detected")}
    assert rows(place.errors(), "column_name", "error_kind", "raw_value") == [("qty", "REJECT", "bad")]
    kept = place.spark.read.parquet(str(place.root / "logs/badrecords/dev"))
    bad = [r for r in kept.collect() if r["texts"]]
    assert [(r["table_name"], r["texts"]["id"], r["texts"]["qty"], r["issues"][0]["column"]) for r in bad] == [("site", "77", "bad", "qty")]
    assert rows(kept.where("texts IS NULL"), "filename", "line_text") == [("site_20250902_120001.csv", "1,2")] * 5


def test_missing_columns(place, rows):
    place.put(site_20250902_120001="id,name,qty\n1,a,2\n")
    spec = SITE.with_(header=NAMES, imposed=False)
    place.load(spec)
    assert place.store.current("site") is None
    assert rows(place.runs(), "status", "error_message") == [("FAILED", "Missing columns")]
    assert rows(place.errors(), "column_name", "error_message", "table_name") == [("since", "MISSING_COLUMN", "site")]
    place.load(spec.with_(delete_columns_allowed=True))
    assert rows(place.store.current("site"), "id", "name", "qty", "since") == [(1, "a", 2, None)]
    assert ("since", "INFO_MISSING_COLUMN") in rows(place.errors(), "column_name", "error_kind")


def test_headers_of_files_may_differ(place, rows):
    spec = SITE.with_(header=NAMES, imposed=False)
    place.put(
        site_20250902_120001="id,name,qty,since\n1,a,2,02/09/2025\n", site_20250903_120001="since,extra,qty,id,name\n03/09/2025,e,5,2,b\n",
        site_20250904_120001="qty,id\n7,3\n1\n", site_20250905_120001="id,name,qty\n4,d,9\n",
    )
    place.load(spec.with_(mode="DELTA_FROM_FLOW"), "strict")
    assert rows(place.store.current("site"), "id", "name", "qty", "dd") == [(1, "a", 2, 2), (2, "b", 5, 3)]
    runs = {r["filename"]: (r["status"], r["row_count"], r["error_message"]) for r in place.runs().collect()}
    assert runs == {
        "site_20250902_120001.csv": ("SUCCESS", 1, ""), "site_20250903_120001.csv": ("SUCCESS", 1, ""),
        "site_20250904_120001.csv": ("FAILED", 0, "Missing columns"), "site_20250905_120001.csv": ("FAILED", 0, "Missing columns"),
    }
    missing = [("site_20250904_120001.csv", "name"), ("site_20250904_120001.csv", "since"), ("site_20250905_120001.csv", "since")]
    assert rows(place.errors().where("error_message = 'MISSING_COLUMN'"), "filename", "column_name") == missing

    lenient = spec.with_(mode=FULL_SNAPSHOT, delete_columns_allowed=True, file_policy=MERGE, tolerance=Tolerance(0.5, True))
    place.load(lenient, "lenient")
    want = [(1, "a", 2), (2, "b", 5), (3, None, 7), (4, "d", 9)]
    assert rows(place.store.current("site").where("id IS NOT NULL"), "id", "name", "qty") == want
    told = place.errors().where("error_kind = 'INFO_MISSING_COLUMN'")
    assert rows(told, "filename", "column_name") == [("merged_4_files", "name"), ("merged_4_files", "since")]
    place.load(lenient.with_(file_policy=EACH, mode="DELTA_FROM_FLOW"), "each")
    each = place.errors().where("error_kind = 'INFO_MISSING_COLUMN' AND filename LIKE 'site%'")
    assert rows(each, "filename", "column_name") == missing


@pytest.mark.parametrize("name,message", [("nothing_20250902", "No file matching"), ("site_20251302", "All files rejected")])
def test_nothing_to_load(place, rows, name, message):
    place.put(**{name: lines(1)})
    place.load(SITE)
    assert ("N/A", "FAILED", message) in rows(place.runs(), "filename", "status", "error_message")


def test_jobs_do_not_grow_with_columns(place):
    def jobs(width):
        fields = (FIELDS[0], *[FieldSpec(f"c{i}", "INT", nullable=False) for i in range(width)])
        spec = SITE.with_(table=f"w{width}", fields=fields, filename_pattern=f"w{width}_<yyyy><mm><dd>.csv")
        place.put(**{f"w{width}_20250902": "1" + ",2" * width + "\n"})
        group = f"width-{width}"
        place.spark.sparkContext.setJobGroup(group, group)
        place.load(spec)
        return len(place.spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    narrow, wide = jobs(2), jobs(10)
    assert 0 < wide <= narrow + 2


def test_logs_as_tables(place):
    place.put(site_20250902_120001=lines(2))
    root = str(place.root / "logs/execution")
    logs.register_log(place.spark, "empty_log", str(place.root / "none"), logs.QUALITY_LOG)
    assert place.spark.table("empty_log").isEmpty()
    place.load(SITE)
    logs.register_log(place.spark, "run_log", root, logs.EXECUTION_LOG)
    assert place.spark.sql("SELECT status FROM run_log").collect()[0][0] == "SUCCESS"
    place.store.register("site")
    assert place.spark.sql("SELECT count(*) FROM site_last").first()[0] == 2
    for view in ("site_all", "site_last"):
        place.spark.catalog.dropTempView(view)
    place.spark.sql("DROP TABLE run_log")
    place.spark.sql("DROP TABLE empty_log")


def test_month_panels_read_one_partition(place):
    rows = place.spark.range(24).select(
        F.lit("t").alias("table_name"), F.lit("f").alias("filename"), F.lit("SUCCESS").alias("status"),
        F.make_timestamp(F.lit(2025), (F.col("id") / 2 + 1).cast("int"), F.lit(3), F.lit(1), F.lit(1), F.lit(1)).alias("log_ts"),
    )
    shaped = logs.execution_rows(rows, "dev")
    logs.append_log(shaped, str(place.root / "log"))
    log = logs.read_log(place.spark, str(place.root / "log"), logs.EXECUTION_LOG)
    panel = dashboards.stats_by_table(log, "2025-03-20")
    assert panel.first()["total_runs"] == 2
    for df in (panel, reports.today_details(log, "2025-03-03"), dashboards.daily_trend(log, "2025-12-03", 1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan and "PartitionFilters" in plan


def test_feeds_in_turn_and_empty_files(place, rows):
    place.put(site_20250902_120001=lines(2), site_20250903_120001="", bad_20250902=lines(1))
    specs = {
        "bad": SITE.with_(table="bad", filename_pattern="bad_<yyyy><mm><dd>.csv", mode="FULL_KEY_REPLACE", fields=FIELDS[1:]),
        "site": SITE.with_(ignore_empty=False),
    }
    from feedloom.plans.ingest import ingest_feeds

    done = ingest_feeds(place.spark, str(place.root / "in"), specs, place.store, str(place.root / "logs"))
    assert done["site"] == "DONE" and "needs merge keys" in done["bad"]
    assert ("bad", "FAILED", done["bad"]) in rows(place.runs(), "table_name", "status", "error_message")
    assert ("site_20250903_120001.csv", "FILE_EMPTY") in rows(place.errors(), "filename", "error_kind")
    assert place.store.current("site").count() == 2


def test_new_columns_are_added(place, rows):
    place.put("a", site_20250902_120001=lines(1))
    place.load(SITE.with_(mode="DELTA_FROM_FLOW"), "one", "a")
    wider = (*FIELDS, FieldSpec("extra"))
    place.put("b", site_20250903_120001="5,n,1,02/09/2025,e\n")
    place.load(SITE.with_(mode="DELTA_FROM_FLOW", fields=wider), "two", "b")
    for table in (place.store.current("site"), place.store.history("site")):
        assert rows(table, "id", "extra") == [(0, None), (5, "e")]


def dying(monkeypatch, at="commit"):
    """Lets the next load die at a step of the store."""

    def fail(self, *a, **k):
        raise OSError("disk lost")

    monkeypatch.setattr(TableStore, at, fail)


@pytest.mark.parametrize("mode", [FULL_SNAPSHOT, "DELTA_FROM_FLOW", DELTA_FROM_NON_HISTORIZED])
def test_a_load_that_dies_before_its_commit_changes_nothing(place, rows, monkeypatch, mode):
    spec = SITE.with_(mode=mode)
    place.put("a", site_20250902_120001=lines(10))
    place.put("b", site_20250903_120001=lines(10, 5, "03/09/2025", "newer"))
    place.load(spec, "one", "a")
    before = [rows(place.store.history("site"), "id"), rows(place.store.current("site"), "id", "name")]
    with monkeypatch.context() as m:
        dying(m)
        with pytest.raises(LoadFailed, match="disk lost"):
            place.load(spec, "two", "b")
    assert before == [rows(place.store.history("site"), "id"), rows(place.store.current("site"), "id", "name")]
    assert rows(place.runs().where("status = 'FAILED'"), "filename", "error_message", "row_count") == [("site_20250903_120001.csv", "Ingestion error: disk lost", 0)]
    # The next load, under an id of its own, does not see what the dead one wrote.
    place.load(spec, "three", "b")
    assert place.store.history("site").count() == 20
    want = {FULL_SNAPSHOT: 10, "DELTA_FROM_FLOW": 20, DELTA_FROM_NON_HISTORIZED: 15}[mode]
    assert place.store.current("site").count() == want


def test_a_retry_adds_nothing_to_tables_or_logs(place, rows):
    place.put(site_20250902_120001=lines(15) + "x,n,1,02/09/2025\n", site_20250903_120001=lines(3))
    for _ in range(3):
        place.load(SITE, "same")
    assert place.store.history("site").count() == 19 and place.runs().count() == 2
    # One unreadable value of a NOT NULL column: invalid when typed, missing in the final check.
    assert rows(place.errors(), "error_kind") == [("ICT_DRIVEN",), ("NULL_VALUE",)]


def test_a_failed_load_is_logged_as_failed_only(place, rows):
    place.put(site_20250902_120001=lines(2))
    spec = SITE.with_(mode="FULL_KEY_REPLACE", fields=FIELDS[1:])
    with pytest.raises(LoadFailed, match="needs merge keys"):
        place.load(spec)
    assert rows(place.runs(), "filename", "status") == [("site_20250902_120001.csv", "FAILED")]


def test_two_loads_at_once_write_apart(place, rows):
    from feedloom.session import together

    place.put("a", site_20250902_120001=lines(4))
    place.put("b", site_20250903_120001=lines(4, 10))
    spec = SITE.with_(mode="DELTA_FROM_FLOW")
    together(lambda: place.load(spec, "one", "a"), lambda: place.load(spec, "two", "b"))
    assert place.store.current("site").count() == place.store.history("site").count() == 8


def test_two_merges_at_once_lose_no_rows(place, rows):
    from feedloom.session import together

    spec = SITE.with_(mode=DELTA_FROM_NON_HISTORIZED)
    place.put("a", site_20250902_120001=lines(6))
    place.load(spec, "zero", "a")
    place.put("b", site_20250903_120001=lines(3, 0, "03/09/2025", "b") + lines(2, 50))
    place.put("c", site_20250904_120001=lines(3, 3, "04/09/2025", "c") + lines(2, 70))
    together(lambda: place.load(spec, "one", "b"), lambda: place.load(spec, "two", "c"))
    last = place.store.current("site")
    want = [*[(i, "b") for i in range(3)], *[(i, "c") for i in range(3, 6)], (50, "n"), (51, "n"), (70, "n"), (71, "n")]
    assert rows(last, "id", "name") == want
    assert [c["load_id"] for c in place.store.commits("site")][0] == "zero" and place.store.history("site").count() == 16


def test_a_merge_computed_from_an_older_table_is_done_again(place, rows, monkeypatch):
    from feedloom.plans import ingest as plan

    spec = SITE.with_(mode=DELTA_FROM_NON_HISTORIZED)
    place.put("a", site_20250902_120001=lines(4))
    place.load(spec, "zero", "a")
    place.put("b", site_20250903_120001=lines(2, 0, "03/09/2025", "b"))
    place.put("c", site_20250904_120001=lines(2, 2, "04/09/2025", "c"))
    write, other = plan.write_load, []

    def overtaken(load, store, load_id, *args, **options):
        ready = write(load, store, load_id, *args, **options)
        if load_id == "slow" and not other:
            other.append(1)
            place.load(spec, "fast", "c")
        return ready

    monkeypatch.setattr(plan, "write_load", overtaken)
    place.load(spec, "slow", "b")
    assert [c["load_id"] for c in place.store.commits("site")] == ["zero", "fast", "slow"]
    assert rows(place.store.current("site"), "id", "name") == [(0, "b"), (1, "b"), (2, "c"), (3, "c")]


def test_every_error_is_logged_by_default(place, rows):
    fields = (FIELDS[0], FIELDS[1], FieldSpec("qty", "INT", nullable=False, on_error="REJECT"), FIELDS[3])
    place.put(site_20250902_120001=lines(3) + "".join(f"{i},n,bad,02/09/2025\n" for i in range(100, 2600)))
    place.load(SITE.with_(fields=fields))
    assert place.errors().count() == 2500
    assert rows(place.runs(), "row_count", "error_count") == [(3, 2500)]


def test_a_merge_rewrites_only_the_dates_it_touches(place, rows):
    spec = SITE.with_(mode=DELTA_FROM_NON_HISTORIZED)
    place.put("a", site_20250902_120001=lines(10), site_20250903_120001=lines(10, 100))
    place.load(spec, "one", "a")
    place.put("b", site_20250904_120001=lines(1, 3, "05/09/2025", "newer") + lines(1, 500))
    place.load(spec, "two", "b")
    commit = place.store.commits("site")[-1]
    assert (commit["replaces"], commit["dates"]) == ("dates", [20250902])
    written = place.spark.read.parquet(str(place.root / "tables/site_last/load_id=two"))
    assert written.where("dd = 3").isEmpty() and written.count() == 11
    last = place.store.current("site")
    assert last.count() == 21 and rows(last.where("name = 'newer'"), "id", "dd") == [(3, 4)]


def test_a_load_leaves_no_folders_of_its_own(place):
    from pathlib import Path

    from feedloom.session import shared_dir

    # Loads of other runs may share the folder.
    there = lambda: set(Path(shared_dir(place.spark)).glob("load-site-*"))
    before = there()
    place.put(site_20250902_120001=lines(2))
    place.load(SITE)
    assert there() <= before
