"""Staging tables that loads empty: runs stopped at any point lose and repeat nothing."""

import pytest

from feedloom.sinks import logs
from feedloom.sinks.tables import TableStore
from feedloom.specs import NAMES, FeedSpec, FieldSpec
from feedloom.streaming import staging
from feedloom.streaming.staging import Staging, consume_all

SPEC = FeedSpec("site", (FieldSpec("ID", "INT", nullable=False), FieldSpec("Name")), header=NAMES)


class Place:
    def __init__(self, spark, tmp_path):
        self.spark, self.source, self.state = spark, tmp_path / "in", str(tmp_path / "state")
        self.source.mkdir()
        self.store, self.logs = TableStore(spark, str(tmp_path / "tables")), str(tmp_path / "log")
        self.staging = Staging(spark, str(tmp_path / "staging"), SPEC)

    def deliver(self, name, *lines):
        (self.source / name).write_text("\n".join(["ID,Name", *lines]) + "\n")

    def fill(self, state=None, files=1):
        return self.staging.fill(str(self.source), state or self.state, files)

    def consume(self):
        return self.staging.consume(self.store, self.logs)

    def both(self, rows):
        last = rows(self.store.current("site"), "id", "name")
        assert rows(self.store.history("site"), "id", "name") == last
        return last

    def runs(self, rows):
        return rows(logs.read_log(self.spark, f"{self.logs}/execution", logs.EXECUTION_LOG), "filename", "row_count", "status")

    def folders(self):
        return sorted(p.name for p in (self.source.parent / "staging" / "site_staging" / "rows").glob("*"))


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path)


def test_staged_rows_are_loaded_per_file_and_gone(place, rows):
    place.deliver("site_20250902.csv", "1,a", "2,b")
    place.deliver("site_20250903.csv", "3,c", "x,d")
    filled = place.fill()
    assert (filled.rows, filled.batches) == (4, 2) and place.store.current("site") is None
    assert rows(place.staging.rows(), "id", "name") == [("1", "a"), ("2", "b"), ("3", "c"), ("x", "d")]
    (done,) = place.consume()
    assert (done.files, done.rows, done.repeated) == (2, 4, 0)
    assert rows(place.store.current("site"), "id", "name")[:2] == [(1, "a"), (2, "b")]
    assert [r[0] for r in place.runs(rows)] == ["site_20250902.csv", "site_20250903.csv"]
    assert place.staging.rows().count() == 0 and place.folders() == []
    assert rows(place.staging.taken(), "source_file", "row_count", "load_id") == [
        ("site_20250902.csv", 2, done.load_id), ("site_20250903.csv", 2, done.load_id)
    ]
    assert place.consume() == [] and place.fill().status == "NO_DATA"


def test_later_files_come_in_a_load_of_their_own(place, rows):
    place.deliver("site_20250902.csv", "1,a")
    place.fill()
    first = place.consume()
    place.deliver("site_20250903.csv", "2,b")
    place.fill()
    second = place.consume()
    assert first[0].load_id != second[0].load_id and place.both(rows) == [(1, "a"), (2, "b")]


def stop(monkeypatch, owner, name, after=False):
    """Lets ``name`` fail once, before or after it has done its work."""
    real = getattr(owner, name)

    def broken(*args, **kwargs):
        monkeypatch.setattr(owner, name, real)
        if after:
            real(*args, **kwargs)
        raise RuntimeError("stopped")

    monkeypatch.setattr(owner, name, broken)


# Where a load may be stopped: before it and before the commit, after the commit but before the logs, between
# the two logs, before the claim is closed, and before the folders are removed.
@pytest.mark.parametrize(
    "where,name,after",
    [
        ("feedloom.streaming.staging", "ingest_rows", False), ("feedloom.plans.ingest", "put_in_force", False),
        ("feedloom.plans.ingest", "put_in_force", True), ("feedloom.sinks.logs", "append_log", True),
        ("feedloom.streaming.staging", "ingest_rows", True), ("Staging", "_remove", False),
    ],
)
def test_a_stopped_load_loses_and_repeats_nothing(place, rows, monkeypatch, where, name, after):
    import importlib

    place.deliver("site_20250902.csv", "1,a", "2,b", ",c")
    place.fill()
    owner = staging.Staging if where == "Staging" else importlib.import_module(where)
    if name == "_remove":
        # The first call removes what earlier claims left; the second one follows the load.
        real, calls = Staging._remove, []
        monkeypatch.setattr(Staging, "_remove", lambda self, b: calls.append(b) or (len(calls) != 2 and real(self, b)) or
                            (len(calls) == 2 and (_ for _ in ()).throw(RuntimeError("stopped"))))
    else:
        stop(monkeypatch, owner, name, after)
    with pytest.raises(RuntimeError, match="stopped"):
        place.consume()
    assert place.folders()  # nothing is removed before the claim is closed
    place.deliver("site_20250903.csv", "3,d")
    place.fill()
    place.consume()
    wanted = [(1, "a"), (2, "b"), (3, "d")]
    assert [r for r in place.both(rows) if r[0] is not None] == wanted
    assert [r[:1] + r[2:] for r in place.runs(rows)] == [("site_20250902.csv", "SUCCESS"), ("site_20250903.csv", "SUCCESS")]
    quality = logs.read_log(place.spark, f"{place.logs}/quality", logs.QUALITY_LOG)
    kinds = rows(quality.groupBy("filename", "error_kind").count())
    assert kinds and all(n == 1 for *_, n in kinds)
    assert place.folders() == [] and place.staging.rows().count() == 0


def test_a_micro_batch_sent_again_is_staged_once(place, rows, monkeypatch):
    place.deliver("site_20250902.csv", "1,a")
    stop(monkeypatch, staging.CommitLog, "append")
    with pytest.raises(Exception, match="stopped"):
        place.fill()
    assert place.staging.rows().count() == 0 and place.consume() == []
    place.fill()
    place.consume()
    assert place.both(rows) == [(1, "a")]


def test_files_already_taken_are_left_out_of_a_new_stream(place, rows, tmp_path):
    place.deliver("site_20250902.csv", "1,a")
    place.fill()
    place.consume()
    place.deliver("site_20250903.csv", "2,b")
    place.fill(str(tmp_path / "other_state"), files=10)
    (done,) = place.consume()
    assert (done.files, done.repeated) == (1, 1) and place.both(rows) == [(1, "a"), (2, "b")]
    place.fill(str(tmp_path / "third_state"), files=10)
    (none,) = place.consume()
    assert (none.files, none.rows, none.repeated) == (0, 0, 2) and place.both(rows) == [(1, "a"), (2, "b")]


def test_a_failing_feed_keeps_its_rows_and_stops_no_other(place, rows, tmp_path):
    place.deliver("site_20250902.csv", "1,a")
    place.fill()
    broken = Staging(place.spark, str(tmp_path / "staging"), SPEC.with_(table="broken"))
    broken.ledger.append(lambda before: {"kind": staging.FILLED}, "gone")  # its folder is missing
    outcome = consume_all([broken, place.staging], place.store, place.logs)
    assert outcome["broken"].startswith("Ingestion error") and outcome["site"][0].files == 1
    assert place.both(rows) == [(1, "a")]


def test_an_empty_staging_table(place):
    assert place.consume() == [] and place.staging.rows().count() == 0 and place.staging.taken().count() == 0
