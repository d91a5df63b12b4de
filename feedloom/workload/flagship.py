"""The whole load of one feed: files, names, typing, gates, merge, logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.plans.ingest import ingest
from feedloom.session import fresh_dir
from feedloom.sinks.tables import TableStore
from feedloom.specs import DELTA_FROM_NON_HISTORIZED, EACH, FULL_SNAPSHOT, NAMES, FeedSpec, FieldSpec
from feedloom.workload import feeds
from feedloom.workload.registry import duck, query, sql
from feedloom.workload.rows import _REJECTED, TYPED
from feedloom.workload.scans import order_spec


@query(
    "ingest_orders",
    duck(
        f"SELECT status, CAST(count(*) AS BIGINT) AS orders, CAST(sum(amount) AS DOUBLE) AS amount, CAST(count(qty) AS BIGINT) AS quantities FROM ({TYPED}) t WHERE NOT {_REJECTED} GROUP BY status"
    ),
)
def load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = TableStore(spark, fresh_dir(spark, "tables"))
    spec = order_spec(mode=DELTA_FROM_NON_HISTORIZED, file_policy=EACH)
    ingest(spark, feeds.orders_csv(spark, sf_dir), spec, store, fresh_dir(spark, "logs"))
    return store.current("orders").groupBy("status").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("amount").cast("double").alias("amount"), F.count("qty").alias("quantities")
    )


# A feed of 31 columns, written with a header: ten of them typed, the others texts.
_D = feeds.ymd("l_shipdate")
WIDE = (
    f"SELECT 'site_' || {_D[0]} || '0902_120001.csv' AS received, CAST(l_orderkey AS STRING) AS orderkey, "
    "CAST(l_partkey AS STRING) AS partkey, CAST(l_suppkey AS STRING) AS suppkey, CAST(l_linenumber AS STRING) AS linenumber, "
    "CASE WHEN l_orderkey % 211 = 0 THEN 'n/a' ELSE CAST(l_quantity AS STRING) END AS quantity, "
    "replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING), '.', ',') AS price, "
    "CAST(l_discount AS STRING) AS discount, CAST(l_tax AS STRING) AS tax, l_returnflag AS returnflag, "
    f"l_linestatus AS linestatus, {_D[2]} || '/' || {_D[1]} || '/' || {_D[0]} AS created, {_D[0]} || {_D[1]} || {_D[2]} AS shipped, "
    + ", ".join(f"'value ' || CAST(l_partkey % {7 + i} AS STRING) AS note{i}" for i in range(19))
    + " FROM {lineitem}"
)
WIDE_FIELDS = (
    FieldSpec("orderkey", "LONG", nullable=False), FieldSpec("partkey", "LONG"), FieldSpec("suppkey", "LONG"),
    FieldSpec("linenumber", "INTEGER", nullable=False), FieldSpec("quantity", "DOUBLE", nullable=False, on_error="REJECT"),
    FieldSpec("price", "DECIMAL", 18, 2), FieldSpec("discount", "DOUBLE"), FieldSpec("tax", "DOUBLE"),
    FieldSpec("returnflag"), FieldSpec("linestatus"), FieldSpec("created", "DATE"), FieldSpec("shipped", "DATE"),
    *[FieldSpec(f"note{i}") for i in range(19)],
)
WIDE_SPEC = FeedSpec(
    "site", WIDE_FIELDS, filename_pattern="site_<yyyy><mm><dd>_<hhmmss>.csv", header=NAMES, mode=FULL_SNAPSHOT, file_policy="merge",
)


def wide_csv(spark: SparkSession, sf_dir: str) -> str:
    return feeds.landed(
        spark, sf_dir, "wide", lambda p: feeds.write_csv(sql(spark, sf_dir, WIDE), p, ",", header=True)
    )


@query(
    "ingest_wide",
    duck(
        "SELECT l_linestatus AS linestatus, CAST(count(*) AS BIGINT) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price, "
        "CAST(min(CAST(l_shipdate AS DATE)) AS STRING) AS first_created, CAST(max(CAST(l_shipdate AS DATE)) AS STRING) AS last_shipped "
        "FROM {lineitem} WHERE l_orderkey % 211 <> 0 GROUP BY 1"
    ),
)
def load_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = TableStore(spark, fresh_dir(spark, "tables"))
    ingest(spark, wide_csv(spark, sf_dir), WIDE_SPEC, store, fresh_dir(spark, "logs"))
    return store.current("site").groupBy("linestatus").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("price").cast("double").alias("price"),
        F.min("created").cast("string").alias("first_created"), F.max("shipped").cast("string").alias("last_shipped"),
    )
