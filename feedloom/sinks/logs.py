"""Execution log and quality log: layouts, projections, append sinks, catalog registration."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.columns import DATE_PARTS
from feedloom.operators.errors import ERROR_COLUMNS
from feedloom.session import path_exists

EXECUTION_LOG = (
    "table_name string, filename string, input_format string, ingestion_mode string, "
    "output_zone string, row_count bigint, column_count int, masking_applied boolean, "
    "error_count bigint, error_message string, status string, duration double, env string, "
    "log_ts timestamp, yyyy int, mm int, dd int"
)
QUALITY_LOG = (
    "table_name string, filename string, column_name string, error_kind string, "
    "error_message string, raw_value string, error_count bigint, Zone string, Env string, "
    "log_ts timestamp, yyyy int, mm int, dd int"
)
SUCCESS, FAILED = "SUCCESS", "FAILED"


def _day(at: Column) -> dict[str, Column]:
    return {"yyyy": F.year(at), "mm": F.month(at), "dd": F.dayofmonth(at)}


def execution_rows(runs: DataFrame, env: str, at: Column | None = None) -> DataFrame:
    """Execution-log rows for many files at once from a frame holding the known columns."""
    at = at if at is not None else F.current_timestamp()
    known = set(runs.columns)
    # What a column is when a run does not tell.
    defaults = {
        "row_count": F.lit(0), "column_count": F.lit(0), "masking_applied": F.lit(False),
        "error_count": F.lit(0), "error_message": F.lit(""), "status": F.lit(SUCCESS),
        "duration": F.lit(0.0), "env": F.lit(env), "log_ts": at,
        **_day(F.col("log_ts") if "log_ts" in known else at),
    }
    out = []
    for f in T._parse_datatype_string(EXECUTION_LOG):
        if f.name in defaults:
            value = F.coalesce(F.col(f.name), defaults[f.name]) if f.name in known else defaults[f.name]
        else:
            value = F.col(f.name) if f.name in known else F.lit(None)
        out.append(value.cast(f.dataType).alias(f.name))
    return runs.select(*out)


def quality_rows(
    errors: DataFrame, table: str, zone: str, env: str, at: Column | None = None
) -> DataFrame:
    """Quality-log rows: table name filled, zone, environment and time added."""
    at = at if at is not None else F.current_timestamp()
    names = set(errors.columns)
    values = {c: F.col(c) if c in names else F.lit(None) for c in ERROR_COLUMNS}
    values["table_name"] = F.coalesce(values["table_name"].cast("string"), F.lit(table))
    values |= {"Zone": F.lit(zone), "Env": F.lit(env), "log_ts": at, **_day(at)}
    return errors.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in T._parse_datatype_string(QUALITY_LOG)]
    )


LOAD = "load_id"


def append_log(rows: DataFrame, path: str, load_id: str | None = None) -> None:
    """Rows of one load, by date and load. Written again under the same id they replace themselves."""
    named = rows.withColumn(LOAD, F.lit(load_id or uuid.uuid4().hex))
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*DATE_PARTS, LOAD).parquet(path)


def is_logged(spark: SparkSession, path: str, load_id: str) -> bool:
    """True where the log below ``path`` holds rows of the load. Looks at folder names alone."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*/*/*/{LOAD}={load_id}")
    return bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where))


def read_log(spark: SparkSession, path: str, layout: str) -> DataFrame:
    schema = T._parse_datatype_string(layout)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(T.StructType([*schema, T.StructField(LOAD, T.StringType())])).parquet(path).drop(LOAD)


def register_log(spark: SparkSession, name: str, path: str, layout: str) -> None:
    """Catalog table over a log folder; an empty log still has its columns."""
    schema = T._parse_datatype_string(layout)
    if not path_exists(spark, path):
        # Without partition columns in the layout of the data there is nothing to discover yet.
        spark.createDataFrame([], schema).write.mode("append").parquet(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema, T.StructField(LOAD, T.StringType())])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join((*DATE_PARTS, LOAD))}) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")


REJECTS = "filename string, path string, block_start bigint, line bigint, line_text string, texts map<string, string>, issues array<struct<column: string, kind: string>>"


def write_rejects(rows: DataFrame, root: str, table: str, load_id: str) -> None:
    """Rejected lines of a load, in one layout for all tables (``REJECTS``)."""
    rows.write.mode("overwrite").parquet(f"{root}/table_name={table}/{LOAD}={load_id}")


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Rejected lines of all tables and loads below a reject folder."""
    layout = f"{REJECTS}, table_name string, {LOAD} string"
    if not path_exists(spark, root):
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(root)
