"""Table maintenance: compaction, clustering, statistics, description."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.columns import DATE_PARTS
from feedloom.operators.curve import with_curve_key
from feedloom.sinks.keys import signature
from feedloom.sinks.tables import TableStore, write_partitioned
from feedloom.sources.listing import list_files


CURVE = "_curve"


def compact(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite a table in files of even size; the rows stay the same."""
    rows = spark.read.option("mergeSchema", "true").parquet(source)
    write_partitioned(rows, target, "overwrite", scattered=True)


def cluster(spark: SparkSession, source: str, target: str, columns: Sequence[str]) -> None:
    """Rewrite a table ordered by date, then by ``columns``, so that filters on any of them skip files and
    row groups."""
    df = spark.read.option("mergeSchema", "true").parquet(source)
    by = [p for p in DATE_PARTS if p in df.columns and p not in columns]
    writer = clustered(df, columns).write.mode("overwrite").option("maxRecordsPerFile", 1_000_000)
    (writer.partitionBy(*by) if by else writer).parquet(target)


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in the order of the dates and of ``columns``: sorted by one column, along a curve through
    several, which keeps each of them in small ranges.

    Ranges run over the dates first, so a task writes to few dates, and files come out in the order of
    the sort, which the date folders lead. A frequent value only widens one range; the remaining
    columns, used as a tie, spread it.
    """
    by = [p for p in DATE_PARTS if p in df.columns and p not in columns]
    rest = [c for c in df.columns if c not in (*by, *columns) and not _complex(df, c)]
    if len(columns) == 1:
        return df.repartitionByRange(*by, *columns, *rest).sortWithinPartitions(*by, *columns)
    keyed = with_curve_key(df, columns, CURVE)
    tied = [c for c in columns if not _complex(df, c)]
    return keyed.repartitionByRange(*by, CURVE, *tied, *rest).sortWithinPartitions(*by, CURVE, *tied).drop(CURVE)


def compact_current(store: TableStore, name: str, load_id: str) -> None:
    """Current table rewritten in files of even size, in force with one commit."""
    _rewrite(store, name, load_id, lambda rows: rows, scattered=True)


def cluster_current(store: TableStore, name: str, load_id: str, columns: Sequence[str]) -> None:
    """Current table rewritten in the order of ``columns``, in force with one commit."""
    _rewrite(store, name, load_id, lambda rows: clustered(rows, columns), scattered=False)


def _rewrite(store: TableStore, name: str, load_id: str, order: Callable[[DataFrame], DataFrame], scattered: bool) -> None:
    """The filters of the last keyed load are made anew for the whole table."""
    commits = store.commits(name)
    rows = store.current(name, commits)
    store.write_current(name, order(rows), load_id, scattered)
    last = next((r["keys"] for r in reversed(commits) if r.get("keys")), [])
    keys = signature(rows.schema, [k for k, _ in last])
    if keys:
        store.write_keys(name, load_id, rows.schema, [k for k, _ in keys])
    store.commit(name, load_id, store.history(name, commits).schema, rows.schema, base=commits[-1]["seq"], keys=keys)


def _complex(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() in ("array", "map", "struct", "variant")


def column_stats(df: DataFrame) -> DataFrame:
    """Smallest and largest value, NULLs and approximate distinct values of every column, in one
    aggregate."""
    aggs = []
    for i, f in enumerate(df.schema):
        text = F.col(f"`{f.name}`")
        aggs += [
            F.min(text).cast("string").alias(f"_min{i}"),
            F.max(text).cast("string").alias(f"_max{i}"),
            F.count_if(text.isNull()).alias(f"_null{i}"),
            F.approx_count_distinct(text, 0.02).alias(f"_ndv{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col(f"_min{i}").alias("min_value"),
                F.col(f"_max{i}").alias("max_value"),
                F.col(f"_null{i}").alias("null_count"),
                F.col(f"_ndv{i}").alias("distinct_estimate"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows))


def analyze(spark: SparkSession, table: str, all_columns: bool = True) -> None:
    """Statistics of a catalog table for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS" + (" FOR ALL COLUMNS" if all_columns else ""))


def table_stats(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Rows, columns and bytes of a table."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    size = list_files(spark, path, "*.parquet").agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).scalar()
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"),
        size.alias("size_bytes"), F.round(size / (1024 * 1024), 2).alias("size_mb"),
    )


def describe(df: DataFrame) -> DataFrame:
    """Columns of a table as rows, with the number of values each holds."""
    counted = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"_n{i}").alias("value_count"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    return counted.select(F.inline(rows))


def maintain(
    spark: SparkSession, tables: dict[str, str], target_root: str, cluster_by: dict[str, Sequence[str]] | None = None
) -> DataFrame:
    """Statistics before and after compacting or clustering every table."""
    after = []
    for name, path in sorted(tables.items()):
        target = f"{target_root}/{name}"
        columns = (cluster_by or {}).get(name)
        if columns:
            cluster(spark, path, target, columns)
        else:
            compact(spark, path, target)
        for moment, where in (("before", path), ("after", target)):
            after.append(table_stats(spark, name, where).withColumn("moment", F.lit(moment)))
    return reduce(DataFrame.unionByName, after)
