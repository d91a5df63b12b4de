import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from feedloom.functions.dates import parse_first, pattern_shape
from feedloom.operators import errors as E
from feedloom.operators import gates, quality, typing
from feedloom.plans import ingest
from feedloom.sources.delimited import BLOCK, CORRUPT, FILE, PATH, ROW
from feedloom.specs import DATE_PATTERNS, FeedSpec, FieldSpec, Tolerance

TEN = Tolerance(0.1, True)


def as_rows(spark, data, columns):
    """Source rows as a scan would give them; ``data`` maps file names to lists of tuples."""
    flat = [
        (*values, None, name, name, 0, i) for name, lines in data.items() for i, values in enumerate(lines)
    ]
    schema = ", ".join(f"{c} string" for c in columns) + f", {CORRUPT} string, {FILE} string, {PATH} string, {BLOCK} long, {ROW} long"
    return spark.createDataFrame(flat, schema)


def judged(spark, data, fields, **spec):
    feed = FeedSpec("t", tuple(fields), **{"file_policy": "each", **spec})
    typed = ingest.stage(as_rows(spark, data, feed.columns), feed)
    files = spark.createDataFrame([(n,) for n in data], "file_name string")
    return ingest.judge(feed, typed, files)


def found(load, *kinds):
    rows = load.errors.select("filename", "column_name", "error_kind", "raw_value", "error_count").collect()
    return sorted((tuple(r) for r in rows if r[2] in kinds or not kinds), key=repr)


def test_reject_hides_the_row_from_later_columns(spark):
    fields = [FieldSpec("a", "INT", nullable=False, on_error="REJECT"), FieldSpec("b", "INT", nullable=False, tolerance=Tolerance(1, True))]
    load = judged(spark, {"f": [("x", "y"), ("1", "y"), ("2", "2")]}, fields)
    assert found(load, E.REJECT, E.ICT_DRIVEN) == [("f", "a", E.REJECT, "x", 1), ("f", "b", E.ICT_DRIVEN, "y", 1)]
    assert sorted(tuple(r) for r in load.accepted.select("a", "b").collect()) == [(1, None), (2, 2)]


def test_abort_empties_the_file_and_silences_later_columns(spark):
    fields = [FieldSpec("d", "DATE"), FieldSpec("a", "INT", nullable=False, tolerance=TEN), FieldSpec("b", "BOOLEAN", nullable=False, on_error="LOG_ONLY")]
    data = {"bad": [("x", "x", "q")] * 2 + [("20250101", "1", "true")] * 8, "good": [("20250101", "1", "q")] * 10}
    load = judged(spark, data, fields)
    assert found(load, E.ABORT, E.FILE_EMPTY, E.INVALID_DATE, E.LOG_ONLY) == sorted(
        [("bad", "a", E.ABORT, None, 2), ("bad", "ALL_COLUMNS", E.FILE_EMPTY, None, 1), ("bad", "d", E.INVALID_DATE, "x", 1),
         ("bad", "d", E.INVALID_DATE, "x", 1), ("good", "b", E.LOG_ONLY, None, 10)], key=repr)
    assert load.accepted.count() == 10
    runs = {r["filename"]: (r["row_count"], r["status"]) for r in load.runs.collect()}
    assert runs == {"bad": (0, "SUCCESS"), "good": (10, "SUCCESS")}


def test_line_reject_threshold(spark):
    fields = [FieldSpec(c, "INT", nullable=False, tolerance=Tolerance(1, True)) for c in "abc"]
    load = judged(spark, {"f": [("x", "1", "1"), ("x", "x", "1"), ("1", "1", "x"), ("1", "1", "1")]}, fields)
    assert found(load, E.LINE_REJECT) == [("f", "MULTIPLE_COLUMNS", E.LINE_REJECT, None, 1)]
    assert load.accepted.count() == 3


def test_threshold_grows_with_flagged_columns(spark):
    names = [f"c{i}" for i in range(20)]
    fields = [FieldSpec(c, "INT", nullable=False, tolerance=Tolerance(1, True)) for c in names]
    diagonal = [tuple("x" if i == j else "1" for j in range(20)) for i in range(20)]
    two = [("x", "x") + ("1",) * 18]
    three = [("x", "x", "x") + ("1",) * 17]
    load = judged(spark, {"wide": diagonal + two + three, "few": two + [("1",) * 20]}, fields)
    # Twenty flagged columns allow two invalid values per line, two flagged columns allow one.
    kept = {r[0]: r[1] for r in load.accepted.groupBy(FILE).count().collect()}
    assert kept == {"wide": 21, "few": 1}


def test_nullable_invalid_is_counted_but_not_logged(spark):
    load = judged(spark, {"f": [("x",), ("1",)]}, [FieldSpec("a", "INT")])
    assert found(load) == []
    typed = typing.type_rows(spark.createDataFrame([("x",), ("1",)], "a string"), [FieldSpec("a", "INT")])
    assert typed.select(F.inline("_issues")).groupBy("kind").count().collect()[0].asDict() == {"kind": E.NULLED, "count": 1}


def test_dates(spark):
    fields = [FieldSpec("d", "DATE", default="1900-01-01"), FieldSpec("t", "TIMESTAMP", pattern="yyyy/MM/dd HH:mm"), FieldSpec("n", "DATE", nullable=False)]
    data = {"f": [("02/09/2025", "2025/09/02 10:20", "2025-09-02"), (" ", "x", None), (None, None, "31/02/2025")]}
    load = judged(spark, data, fields)
    got = [tuple(r) for r in load.accepted.orderBy(ROW).select("d", "t", "n").collect()]
    assert got == [(date(2025, 9, 2), datetime(2025, 9, 2, 10, 20), date(2025, 9, 2)), (date(1900, 1, 1), None, None), (date(1900, 1, 1), None, None)]
    assert found(load) == sorted([("f", "d", E.EMPTY_DATE, "", 1), ("f", "t", E.INVALID_DATE, "x", 1), ("f", "n", E.INVALID_DATE, "31/02/2025", 1), ("f", "n", E.NULL_VALUE, None, 1), ("f", "n", E.NULL_VALUE, None, 1)], key=repr)


def test_guarded_patterns_parse_what_unguarded_ones_do(spark):
    rng = random.Random(7)
    texts = {"02/09/2025", "2/9/2025", "02/09/2025 10:20:30", "20250902", "20250902102030", "2025-09-02", "2025-09-02T10:20:30", " 20250902", "+12025-09-02", "2025-13-01", "", "29/02/2024", "29/02/2023"}
    texts |= {"".join(rng.choice("0129/-: T") for _ in range(rng.choice((8, 10, 14, 19)))) for _ in range(3000)}
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    plain = F.coalesce(*[F.try_to_timestamp("x", F.lit(p)) for p in DATE_PATTERNS])
    assert all(pattern_shape(p) for p in DATE_PATTERNS) and pattern_shape("d MMM yy") is None
    assert df.where(~parse_first(F.col("x"), DATE_PATTERNS).eqNullSafe(plain)).count() == 0
    assert df.where(plain.isNotNull()).count() >= 7


def test_casts(spark):
    fields = [FieldSpec("d", "DECIMAL", 10, 2), FieldSpec("s"), FieldSpec("l", "LONG"), FieldSpec("u", transform="uppercase"), FieldSpec("r", transform="regex", pattern="[0-9]+", replacement="#")]
    df = spark.createDataFrame([("1,5", "a,b", " 5 ", "é", "a12b3"), ("", " ", "1.5", None, None)], "d string, s string, l string, u string, r string")
    got = [tuple(r) for r in typing.type_rows(df, fields).select("d", "s", "l", "u", "r").collect()]
    assert str(got[0][0]) == "1.50" and got[0][1:] == ("a,b", 5, "É", "a#b#")
    assert got[1][0] is None and got[1][1] is None and got[1][3:] == (None, None)


def test_final_check_on_texts(spark, rows):
    fields = [FieldSpec("a", "INT", nullable=False), FieldSpec("b", "DATE")]
    df = spark.createDataFrame([("1", "2025-01-01", "k"), ("x", None, "k"), (None, "y", "k")], "a string, b string, key string")
    checked = typing.final_check(df, fields)
    assert checked.columns[0] == "key" and checked.count() == 3
    shown = typing.issue_rows(checked, fields, "t", F.col("key"))
    assert rows(shown, "column_name", "error_message", "raw_value") == sorted([
        ("a", "TYPE MISMATCH: Expected INT, found: 'x'", "x"), ("a", "NULL_VALUE: Column 'a' does not allow null", None),
        ("a", "NULL_VALUE: Column 'a' does not allow null", None), ("b", "TYPE MISMATCH: Expected DATE, found: 'y'", "y")], key=repr)


@pytest.mark.parametrize("bad,aborts", [(50, False), (15_000, True), (10_000, False)])
def test_corrupt_gate(spark, bad, aborts):
    df = spark.range(100_000).select(F.lit("f").alias("u"), F.when(F.col("id") < bad, "line").alias(CORRUPT))
    counts = gates.corrupt_counts(df, "u")
    assert counts.select(gates.too_corrupt(counts, TEN)).first()[0] is aborts


def test_too_corrupt_file_is_left_out(spark):
    feed = FeedSpec("t", (FieldSpec("a", "INT"),), file_policy="each")
    rows = as_rows(spark, {"ok": [("1",)] * 9, "no": [("1",)] * 5}, ["a"])
    rows = rows.withColumn(CORRUPT, F.when((F.col(FILE) == "no") & (F.col(ROW) < 2), F.lit("1,2")))
    files = spark.createDataFrame([("ok",), ("no",)], "file_name string")
    load = ingest.judge(feed, ingest.stage(rows, feed), files)
    assert {r[0] for r in load.accepted.select(FILE).collect()} == {"ok"}
    assert sorted(tuple(r) for r in load.runs.select("filename", "row_count", "status").collect()) == [("no", 5, "FAILED"), ("ok", 9, "SUCCESS")]


def test_merged_files_are_one_unit(spark):
    load = judged(spark, {"f1": [("1",)], "f2": [("1",), ("2",)]}, [FieldSpec("a", "INT", role="ismergekey")], file_policy="merge")
    assert found(load) == [("merged_2_files", "a", E.DUPLICATE_KEY, None, 2)]
    alone = judged(spark, {"f1": [("1",), ("1",)]}, [FieldSpec("a", "INT", role="ismergekey")], file_policy="merge")
    assert found(alone) == [("f1", "a", E.DUPLICATE_KEY, None, 2)]


def test_cap_is_exact(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 20_011).alias("o"))
    got = {tuple(r) for r in E.cap(df, 50, ["g"], ["o"]).collect()}
    want = set()
    for g in range(3):
        want |= set(sorted((i % 3, i * 7919 % 20_011) for i in range(20_000) if i % 3 == g)[:50])
    assert got == want
    assert E.cap(df, None, ["g"], ["o"]).count() == 20_000


def test_cap_applies_to_logged_rows_only(spark):
    load = judged(spark, {"f": [("x",)] * 30}, [FieldSpec("d", "DATE")], max_logged_errors=10)
    assert len(found(load, E.INVALID_DATE)) == 10 and load.accepted.count() == 30


def test_duplicate_keys_count_nulls_together(spark):
    df = spark.createDataFrame([("f", 1, None), ("f", 1, None), ("f", 2, 1), ("g", 2, 1)], "u string, a int, b int")
    got = quality.duplicate_keys(df, ["a", "b", "zz"], "t", "u").collect()
    assert [(r["filename"], r["column_name"], r["error_count"]) for r in got] == [("f", "a,b", 2)]


def test_rows_are_kept_or_refused(spark):
    """Every row of a sound file is either accepted or refused, checked against plain Python."""
    rng = random.Random(3)
    pick = lambda: rng.choice(["1", "2", "x", "", None])
    data = {f"f{k}": [(pick(), pick(), pick(), pick()) for _ in range(60)] for k in range(4)}
    fields = [
        FieldSpec("a", "INT", nullable=False, tolerance=Tolerance(0.25, True)), FieldSpec("b", "INT", nullable=False, on_error="REJECT"),
        FieldSpec("c", "INT", nullable=False, tolerance=Tolerance(0.2, True)), FieldSpec("d", "INT"),
    ]
    load = judged(spark, data, fields, max_logged_errors=None)
    kept, errors = {}, []
    for name, lines in data.items():
        alive, flags = list(range(len(lines))), [0] * len(lines)
        for i, f in enumerate(fields):
            bad = [r for r in alive if lines[r][i] == "x"]
            if f.nullable or not bad:
                continue
            if f.on_error == "REJECT":
                errors += [(name, f.name, E.REJECT)] * len(bad)
                alive = [r for r in alive if r not in bad]
            elif len(bad) / len(lines) > f.tolerance.value:
                errors.append((name, f.name, E.ABORT))
                alive = []
            else:
                errors += [(name, f.name, E.ICT_DRIVEN)] * len(bad)
                for r in bad:
                    flags[r] += 1
        over = [r for r in alive if flags[r] > 1]
        errors += [(name, "MULTIPLE_COLUMNS", E.LINE_REJECT)] * len(over)
        alive = [r for r in alive if r not in over]
        errors += [(name, f.name, E.NULL_VALUE) for r in alive for i, f in enumerate(fields) if not f.nullable and lines[r][i] not in ("1", "2")]
        if all(lines[r][i] not in ("1", "2") for r in alive for i in range(4)):
            errors.append((name, "ALL_COLUMNS", E.FILE_EMPTY))
        kept[name] = alive
    got = {n: [] for n in data}
    for r in load.accepted.select(FILE, ROW).collect():
        got[r[0]].append(r[1])
    assert {n: sorted(v) for n, v in got.items()} == kept
    assert sorted(e[:3] for e in found(load)) == sorted(errors)
    assert load.accepted.count() + load.refused.count() == 240
