"""Filters of keys by date: nothing is missed, and a merge of few keys opens few dates."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.observability import maintenance
from feedloom.sinks import keys
from feedloom.sinks.tables import TableStore, date_key
from feedloom.specs import DELTA_FROM_NON_HISTORIZED, FULL_KEY_REPLACE
from tests.test_ingest import SITE, lines, place  # noqa: F401

DAYS = [dt.date(2025, 1, 1) + dt.timedelta(i) for i in range(24)]


@pytest.fixture
def by_day(spark):
    """60,000 keys, a third of them on the first day, the rest over 23 days."""
    n = F.col("id")
    day = F.when(n % 3 == 0, 0).otherwise(n % 23 + 1).cast("int")
    date = F.date_add(F.lit(DAYS[0]), day)
    return spark.range(60_000).select(
        n.alias("k"), F.concat(F.lit("s"), n).alias("s"), F.year(date).alias("yyyy"), F.month(date).alias("mm"), F.day(date).alias("dd"),
    )


def test_no_key_is_missed_and_few_dates_are_named_in_vain(spark, by_day, tmp_path):
    keys.filters(by_day, ["k", "s"], date_key()).write.parquet(str(tmp_path / "f"))
    found = spark.read.parquet(str(tmp_path / "f"))
    # Blocks grow with the keys of a date: 20,000 on the first day, about 1740 on the others.
    assert {r["blocks"] for r in found.where("date = 20250101").collect()} == {32}
    assert {r["blocks"] for r in found.where("date > 20250101").collect()} == {2}
    for some in (by_day.where("k IN (0, 1, 70)"), by_day.where("k % 997 = 5"), by_day):
        true = {r[0] for r in some.select(date_key()).distinct().collect()}
        assert true <= set(keys.dates_holding(found, some, ["k", "s"]))
    one = by_day.where("k = 70")
    assert keys.dates_holding(found, one, ["k", "s"]) == [r[0] for r in one.select(date_key()).collect()]
    unknown = spark.range(10**6, 10**6 + 300).select(F.col("id").alias("k"), F.lit("s").alias("s"))
    assert len(keys.dates_holding(found, unknown, ["k", "s"])) <= 3
    nothing = spark.createDataFrame([(None, "s1"), (5, None)], "k long, s string")
    assert keys.dates_holding(found, nothing, ["k", "s"]) == []
    assert keys.dates_holding(found.limit(0), one, ["k", "s"]) == []


def test_batches_of_many_keys_are_not_asked_one_by_one(by_day, monkeypatch):
    monkeypatch.setattr(keys, "MOST_ASKED", 10)
    found = keys.filters(by_day.limit(100), ["k"], date_key())
    assert keys.dates_holding(found, by_day, ["k"]) is None
    assert keys.dates_holding(found, by_day.limit(10), ["k"]) is not None


def test_keys_that_have_filters():
    schema = T.StructType.fromDDL("a int, b string, c double, d decimal(5,2), e array<int>")
    assert keys.signature(schema, ["a", "d"]) == [["a", "int"], ["d", "decimal(5,2)"]]
    assert [keys.signature(schema, k) for k in (["c"], ["a", "e"], [], ["z"])] == [None] * 4


def garbled(folder, kept_days):
    """Files of all other days become unreadable; returns what they were."""
    before = {}
    for file in Path(folder).glob("**/*.parquet"):
        if not any(f"dd={d}/" in str(file) for d in kept_days):
            before[file] = file.read_bytes()
            file.write_bytes(b"x" * len(before[file]))
    return before


@pytest.mark.parametrize("mode", [DELTA_FROM_NON_HISTORIZED, FULL_KEY_REPLACE])
def test_a_merge_of_few_keys_opens_only_dates_that_may_hold_them(place, rows, mode):  # noqa: F811
    spec = SITE.with_(mode=mode)
    place.put("a", **{f"site_202509{d:02d}_120001": lines(30, 100 * d) for d in range(1, 16)})
    place.load(spec, "one", "a")
    assert place.store.commits("site")[-1]["keys"] == [["id", "bigint"]]
    before = garbled(place.root / "tables/site_last/load_id=one", [4, 11])
    assert len(before) >= 13
    place.put("b", site_20250920_120001=lines(1, 405, "05/09/2025", "newer") + lines(1, 1110, "05/09/2025", "newer") + lines(1, 9000, name="newer"))
    place.load(spec, "two", "b")
    for file, data in before.items():
        file.write_bytes(data)
    assert place.store.commits("site")[-1]["dates"] == [20250904, 20250911]
    last = place.store.current("site")
    assert last.count() == 15 * 30 + 1
    assert sorted(rows(last.where("name = 'newer'"), "id")) == [(405,), (1110,), (9000,)]
    # What the second load wrote has filters of its own.
    place.put("c", site_20250921_120001=lines(2, 9000, "06/09/2025", "newest"))
    place.load(spec, "three", "c")
    assert rows(place.store.current("site").where("name = 'newest'"), "id") == [(9000,), (9001,)]
    assert place.store.current("site").count() == 15 * 30 + 2


def test_loads_without_filters_are_read_whole(spark, by_day, tmp_path, rows):
    store = TableStore(spark, str(tmp_path))
    few = by_day.where("k < 300")
    store.replace_current("t", few, "a")  # no filters
    batch = by_day.where("k IN (1, 2, 500)")
    whole = lambda df: df.count()
    assert store.may_hold("t", [], batch, ["k"]) is None
    assert whole(store.may_hold("t", store.commits("t"), batch, ["k"])) == 300
    store.write_current("t", few, "b")
    store.write_keys("t", "b", few.schema, ["k"])
    store.commit("t", "b", few.schema, few.schema, keys=keys.signature(few.schema, ["k"]))
    part = store.may_hold("t", store.commits("t"), batch, ["k"])
    assert rows(part.where("k IN (1, 2, 500)"), "k") == [(1,), (2,)] and whole(part) < 60
    # Other types hash otherwise, other keys are not in the filters.
    assert whole(store.may_hold("t", store.commits("t"), batch.withColumn("k", F.col("k").cast("int")), ["k"])) == 300
    assert whole(store.may_hold("t", store.commits("t"), batch, ["s"])) == 300
    # Appended rows have none, the others keep theirs.
    more = by_day.where("k BETWEEN 300 AND 309")
    store.add_history("t", more, "c")
    store.append_current("t", more, "c")
    assert 10 <= whole(store.may_hold("t", store.commits("t"), batch, ["k"])) < 70
    maintenance.compact_current(store, "t", "d")
    assert store.commits("t")[-1]["keys"] == [["k", "bigint"]]
    part = store.may_hold("t", store.commits("t"), batch, ["k"])
    assert rows(part.where("k IN (1, 2, 500)"), "k") == [(1,), (2,)] and whole(part) < 70
