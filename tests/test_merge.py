import random

import pytest
from pyspark.sql import functions as F

from feedloom import specs
from feedloom.operators.merge import key_replace, merge_latest
from feedloom.plans.modes import next_state, rewrites
from feedloom.sinks.tables import TableStore


def test_merge_against_plain_python(spark):
    rng = random.Random(5)
    target = [(rng.choice([None, *range(40)]), rng.choice([None, 1, 5, 9]), f"t{i}", "keep") for i in range(80)]
    batch = [(rng.choice([None, *range(60)]), rng.choice([None, 2, 5, 8]), f"u{i}", "drop") for i in range(90)]
    t = spark.createDataFrame(target, "k int, v int, name string, only_target string")
    u = spark.createDataFrame(batch, "k int, v int, name string, only_batch string")
    got = merge_latest(t, u, ["k"], "v", [F.col("name").asc()])
    best = {}
    for k, v, name, _ in sorted(batch, key=lambda r: (-(r[1] if r[1] is not None else -1), r[2])):
        if k is not None:
            best.setdefault(k, (v, name))
    want = []
    for k, v, name, extra in target:
        new = best.get(k)
        if new and new[0] is not None and v is not None and new[0] > v:
            v, name = new
        want.append((k, v, name, extra))
    known = {r[0] for r in target}
    want += [(k, v, n, None) for k, (v, n) in best.items() if k not in known]
    want += [(None, v, n, None) for k, v, n, _ in batch if k is None]
    assert got.columns == t.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_merge_needs_the_compare_column(spark):
    t = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        merge_latest(t, t.withColumn("v", F.lit(1)), ["k"], "v")


def test_merge_does_not_shuffle_the_target_for_a_small_batch(spark, tmp_path):
    spark.range(50_000).select(F.col("id").alias("k"), F.lit(1).alias("v")).write.parquet(str(tmp_path / "t"))
    spark.range(10).select(F.col("id").alias("k"), F.lit(2).alias("v")).write.parquet(str(tmp_path / "u"))
    t, u = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "u"))
    plan = merge_latest(t, u, ["k"], "v", keep=lambda df: spark.read.parquet(str(tmp_path / "u")))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3


def test_newest_is_limited_on_the_map_side(spark):
    t = spark.createDataFrame([(1, 1)], "k int, v int")
    plan = merge_latest(t, t, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_key_replace(spark, rows):
    t = spark.createDataFrame([(1, 1, "t"), (1, 2, "t"), (2, 3, "t"), (None, 1, "t")], "a int, b int, s string")
    u = spark.createDataFrame([(1, 1, "u"), (None, 3, "u")], "a int, b int, s string")
    assert rows(key_replace(t, u, ["a", "b"])) == sorted([(1, 2, "t"), (2, 3, "t"), (None, 1, "t"), (1, 1, "u"), (None, 3, "u")], key=repr)
    assert rows(key_replace(t, u, ["a", "b"], "any")) == sorted([(1, 1, "u"), (None, 3, "u")], key=repr)


def test_modes(spark, rows):
    last = spark.createDataFrame([(1, "old"), (2, "old")], "k int, s string")
    batch = spark.createDataFrame([(2, "new"), (3, "new")], "k int, s string")
    both = rows(last.union(batch))
    for mode in ("DELTA_FROM_FLOW", "delta_from_historized", "", "anything"):
        assert not rewrites(mode) and rows(next_state(last, batch, mode)) == both
    assert rows(next_state(last, batch, "full_snapshot")) == rows(batch)
    assert rows(next_state(last, batch, specs.FULL_KEY_REPLACE, ["k"])) == [(1, "old"), (2, "new"), (3, "new")]
    for mode in (specs.FULL_KEY_REPLACE, specs.DELTA_FROM_NON_HISTORIZED):
        with pytest.raises(ValueError):
            next_state(last, batch, mode)


def test_versions_and_retries(spark, tmp_path, rows):
    store = TableStore(spark, str(tmp_path))
    frame = lambda *k: spark.createDataFrame([(i, 2025, 9, 2) for i in k], "k int, yyyy int, mm int, dd int")
    assert store.current("t") is None and store.history("t") is None
    for _ in range(2):
        store.add_history("t", frame(1, 2), "a")
        store.append_current("t", frame(1, 2), "a")
    assert rows(store.history("t"), "k") == [(1,), (2,)] == rows(store.current("t"), "k")
    assert store.is_loaded("t", "a") and not store.is_loaded("t", "b")
    # Rows written without their commit, as after a lost driver, are not in force on either side.
    store.add_history("t", frame(9), "b")
    store.write_current("t", frame(9), "b")
    assert rows(store.current("t"), "k") == [(1,), (2,)] == rows(store.history("t"), "k")
    store.replace_current("t", frame(7), "c")
    assert rows(store.current("t"), "k") == [(7,)] and rows(store.history("t"), "k") == [(1,), (2,)]
    assert sorted(store.tables()) == ["t_all", "t_last"]


def test_dates_of_later_loads_replace_those_of_earlier_ones(spark, tmp_path, rows):
    store = TableStore(spark, str(tmp_path))
    frame = lambda *kd: spark.createDataFrame([(k, 2025, 9, d) for k, d in kd], "k int, yyyy int, mm int, dd int")
    store.replace_current("t", frame((1, 1), (2, 2), (3, 3)), "a")
    new = frame((20, 2), (40, 4))
    store.write_current("t", new, "b")
    store.commit("t", "b", new.schema, new.schema, "dates", [20250902])
    assert rows(store.current("t"), "k") == [(1,), (20,), (3,), (40,)]
    more = frame((41, 4))
    store.write_current("t", more, "c")
    store.commit("t", "c", more.schema, more.schema, "dates", [20250904, 20250901])
    assert rows(store.current("t"), "k") == [(20,), (3,), (41,)]
    plan = store.current("t").where("dd = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan


def test_thousands_of_commits_are_read_in_few_files(spark, tmp_path, monkeypatch):
    from feedloom.sinks import commits

    log = commits.CommitLog(spark, str(tmp_path / "t_commits"))
    assert log.rows() == []
    for i in range(40):
        log.append(lambda before: {"at": len(before), "history": "h", "current": "c"}, f"load-{i}")
        if i == 20:
            log.append(lambda before: {"at": -1}, "load-7")
    found = log.rows()
    assert [r["load_id"] for r in found] == [f"load-{i}" for i in range(40)] == [f"load-{r['at']}" for r in found]
    assert [r["seq"] for r in found] == list(range(1, 41)) and found[-1]["history"] == "h" and "history" not in found[0]
    assert len(list((tmp_path / "t_commits").glob("0*"))) == 9
    # Ten thousand loads are one file and what followed it.
    log._sum_up([{"seq": i + 1, "load_id": f"old-{i}", "history": "h"} for i in range(10_000)])
    log.append(lambda before: {"at": len(before)}, "next")
    opened, read = [], commits.CommitLog._read
    monkeypatch.setattr(commits.CommitLog, "_read", lambda self, *name: opened.append(name) or read(self, *name))
    assert len(log.rows()) == 10_001 and opened == [(10_000, "summary"), (10_001, "json")]


def test_a_commit_is_refused_after_others(spark, tmp_path):
    from feedloom.sinks.commits import Conflict

    store, day = TableStore(spark, str(tmp_path)), F.lit(1)
    frame = spark.range(3).withColumns({"yyyy": day, "mm": day, "dd": day})
    store.replace_current("t", frame, "a")
    store.write_current("t", frame, "b")
    store.write_current("t", frame, "c")
    store.commit("t", "b", frame.schema, frame.schema, base=1)
    with pytest.raises(Conflict, match="from commit 1, the table is at 2"):
        store.commit("t", "c", frame.schema, frame.schema, base=1)
    store.commit("t", "b", frame.schema, frame.schema, base=1)
    assert [c["load_id"] for c in store.commits("t")] == ["a", "b"]
    assert list(store.tables("_last")) == ["t_last"]
