"""Clustering by several columns: every one of them skips files."""

import datetime as dt
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from feedloom.observability import maintenance
from feedloom.operators.curve import interleaved, rank, with_curve_key


def share_read(folder, column, values):
    """Mean share of the row groups whose range holds a value, which a filter on it has to read."""
    groups = []
    for file in Path(folder).glob("**/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            part = meta.row_group(g)
            at = next(i for i in range(part.num_columns) if part.column(i).path_in_schema == column)
            stats = part.column(at).statistics
            groups.append((stats.min, stats.max))
    return np.mean([np.mean([low <= v <= high for low, high in groups]) for v in values]), len(groups)


@pytest.fixture
def many_files(spark):
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_filter_on_any_column_skips_most_row_groups(spark, tmp_path, many_files):
    rng = np.random.default_rng(4)
    n = 40_000
    rows = spark.createDataFrame(
        [(int(a), float(b), f"name{c:05d}") for a, b, c in zip(
            rng.integers(0, 10**6, n), rng.exponential(size=n), rng.integers(0, 90_000, n), strict=True)],
        "a long, b double, c string",
    ).withColumn("c", F.col("c").substr(5, 9))
    source, curve, plain = (str(tmp_path / x) for x in ("in", "curve", "plain"))
    rows.write.parquet(source)
    maintenance.cluster(spark, source, curve, ["a", "b"])
    rows.repartitionByRange("a", "b").sortWithinPartitions("a", "b").write.parquet(plain)
    asked = {"a": [int(v) for v in rng.integers(0, 10**6, 50)], "b": [float(v) for v in rng.exponential(size=50)]}
    for column, values in asked.items():
        share, groups = share_read(curve, column, values)
        assert groups >= 50 and share < 0.25, (column, share, groups)
    assert share_read(plain, "b", asked["b"])[0] > 0.8  # what a plain sort leaves of the second column
    assert spark.read.parquet(curve).exceptAll(rows).isEmpty() and spark.read.parquet(curve).count() == n


def test_bits_take_turns(spark):
    df = spark.createDataFrame([(0b101, 0b011)], "x long, y long")
    assert df.select(interleaved([F.col("x"), F.col("y")], 3)).first()[0] == 0b100111


def test_ranks_by_halving(spark):
    bounds = [1.0, 2.0, 2.0, 2.0, 5.0, 8.0, 9.0]
    df = spark.createDataFrame([(v,) for v in (None, 0.5, 1.0, 1.5, 2.0, 4.9, 5.0, 8.5, 9.0, 99.0)], "v double")
    got = [r[0] for r in df.select(rank(F.col("v"), bounds, 3)).collect()]
    assert got == [0, 0, 1, 1, 4, 4, 5, 6, 7, 7]


def test_all_kinds_of_columns(spark, tmp_path):
    day = dt.date(2025, 1, 1)
    rows = [(i, f"ü{i % 7}", day + dt.timedelta(i), dt.datetime(2025, 1, 1, i % 24), i % 2 == 0, [i], 2025, 1, 1 + i % 3) for i in range(60)]
    rows += [(None, None, None, None, None, None, 2025, 1, 1)] * 5 + rows[:3]
    df = spark.createDataFrame(rows, "n int, t string, d date, at timestamp, f boolean, l array<int>, yyyy int, mm int, dd int")
    df = df.withColumns({"z": F.col("at").cast("timestamp_ntz"), "m": F.col("n").cast("decimal(9,2)"), "e": F.lit(None).cast("int")})
    columns = ["n", "t", "d", "at", "f", "l", "z", "m", "e"]
    keyed = with_curve_key(df, columns, "_curve")
    assert keyed.columns == [*df.columns, "_curve"] and keyed.where("_curve IS NULL OR _curve < 0").isEmpty()
    assert keyed.where("n IS NULL").select("_curve").distinct().collect() == [(0,)]
    df.write.parquet(str(tmp_path / "in"))
    maintenance.cluster(spark, str(tmp_path / "in"), str(tmp_path / "out"), columns)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select(*df.columns).exceptAll(df).isEmpty() and back.count() == len(rows)


def test_an_empty_table_and_too_many_columns(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert with_curve_key(df, ["a", "b"], "k").count() == 0
    with pytest.raises(ValueError, match="at most"):
        with_curve_key(df, ["a"] * 63, "k")
