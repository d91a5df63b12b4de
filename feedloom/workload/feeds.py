"""Dirty text feeds and logs derived from the given tables.

Each recipe is one SQL text that Spark and the checking engine both understand, so both sides start
from the same rows. Feeds that operators read from files are written once per session to the shared
folder, one delivery (a folder of part files) per value of ``received``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.session import fresh_dir, open_files
from feedloom.specs import FieldSpec, Tolerance
from feedloom.workload.registry import sql

_written: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    """Path of a derived feed, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        path = fresh_dir(spark, label)
        write(path)
        _written[key] = path
    return _written[key]


def ymd(ts: str) -> tuple[str, str, str]:
    """Zero-padded year, month and day of a timestamp as SQL."""
    pad = "lpad(CAST({f}({ts}) AS STRING), {n}, '0')"
    return tuple(pad.format(f=f, ts=ts, n=n) for f, n in (("year", 4), ("month", 2), ("day", 2)))


_Y, _M, _D = ymd("o_orderdate")

# --- orders as an all-text feed, one delivery per year ------------------------------------------
ORDERS = f"""
SELECT
  'orders_' || {_Y} || '0105_120001.csv' AS received,
  CAST(o_orderkey AS STRING) AS order_id,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN '  '
       ELSE CAST(o_custkey AS STRING) END AS cust_id,
  CASE WHEN o_orderkey % 97 = 0 THEN 'abc'
       ELSE replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING), '.', ',') END AS amount,
  CASE WHEN o_orderkey % 107 = 0 THEN ' '
       WHEN o_orderkey % 109 = 0 THEN NULL
       WHEN o_orderkey % 8 = 0 THEN {_D} || '/' || {_M} || '/' || {_Y} || ' 10:20:30'
       WHEN o_orderkey % 8 = 1 THEN {_D} || '/' || {_M} || '/' || {_Y}
       WHEN o_orderkey % 8 = 2 THEN {_Y} || '-' || {_M} || '-' || {_D} || ' 10:20:30'
       WHEN o_orderkey % 8 = 3 THEN {_Y} || '-' || {_M} || '-' || {_D} || 'T10:20:30'
       WHEN o_orderkey % 8 = 4 THEN {_Y} || {_M} || {_D} || '102030'
       WHEN o_orderkey % 8 = 5 THEN {_Y} || {_M} || {_D}
       WHEN o_orderkey % 8 = 6 THEN {_Y} || '-' || {_M} || '-' || {_D}
       ELSE '31/02/2025' END AS odate,
  '  ' || o_orderpriority || ' ' AS priority,
  CASE WHEN o_orderkey % 89 = 0 OR o_orderkey % 194 = 0 THEN '12x'
       ELSE CAST(o_orderkey % 50 AS STRING) END AS qty,
  CASE WHEN o_orderkey % 83 = 0 THEN 'maybe' WHEN o_orderkey % 3 = 0 THEN 'yes'
       WHEN o_orderkey % 3 = 1 THEN 'no' ELSE 'true' END AS urgent,
  o_orderstatus AS status
FROM {{orders}}
"""
ORDER_COLUMNS = ("order_id", "cust_id", "amount", "odate", "priority", "qty", "urgent", "status")

ORDER_FIELDS = (
    FieldSpec("order_id", "LONG", nullable=False, role="ismergekey"),
    FieldSpec("cust_id", "LONG"),
    FieldSpec("amount", "DECIMAL", 18, 2, nullable=False),
    FieldSpec("odate", "DATE"),
    FieldSpec("priority", "STRING", transform="lowercase"),
    FieldSpec("qty", "INTEGER", nullable=False),
    FieldSpec("urgent", "BOOLEAN", nullable=False, on_error="LOG_ONLY"),
    FieldSpec("status", "STRING"),
)


def fields(**changes: dict) -> tuple[FieldSpec, ...]:
    """Fields of the order feed with some properties changed by column name."""
    from dataclasses import replace

    return tuple(replace(f, **changes.get(f.name, {})) for f in ORDER_FIELDS)


def share(text: str) -> Tolerance:
    return Tolerance.parse(text)


def write_csv(rows: DataFrame, path: str, sep: str = ";", header: bool = False, **options: str) -> None:
    writer = rows.write.partitionBy("received").option("sep", sep).option("header", str(header).lower())
    writer = writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    with open_files(rows.sparkSession):
        writer.options(**options).csv(path)


def orders_csv(spark: SparkSession, sf_dir: str, header: bool = False) -> str:
    label = "orders-header" if header else "orders-plain"
    return landed(
        spark, sf_dir, label, lambda path: write_csv(sql(spark, sf_dir, ORDERS), path, header=header)
    )


# --- the same feed as raw lines, some too long or too short -------------------------------------
LINES = """
SELECT received, order_id,
  CASE WHEN CAST(order_id AS BIGINT) % 113 = 0 THEN order_id || ';' || status
       WHEN CAST(order_id AS BIGINT) % 31 = 0 AND received LIKE 'orders_1997%' THEN order_id || ';a;b;c;d;e'
       WHEN CAST(order_id AS BIGINT) % 127 = 0 THEN order_id || ';' || qty || ';' || status || ';x;y'
       ELSE order_id || ';' || qty || ';' || status END AS line
FROM (""" + ORDERS + """) f
"""


def order_lines(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        rows = sql(spark, sf_dir, LINES).select("received", "line")
        rows.write.partitionBy("received").text(path)

    return landed(spark, sf_dir, "orders-lines", write)


# --- file names ---------------------------------------------------------------------------------
NAMES = f"""
SELECT DISTINCT
  CASE WHEN o_orderkey % 6 = 0 THEN 'orders_' || {_Y} || {_M} || {_D} || '_120001.csv'
       WHEN o_orderkey % 6 = 1 THEN 'orders_' || {_Y} || '-' || {_M} || '-' || {_D} || '.csv'
       WHEN o_orderkey % 6 = 2 THEN 'orders_' || {_Y} || CAST(month(o_orderdate) + 12 AS STRING) || {_D} || '_120001.csv'
       WHEN o_orderkey % 6 = 3 THEN '20_orders' || CAST(o_orderkey % 60 AS STRING) || '.CSV'
       WHEN o_orderkey % 6 = 4 THEN 'SITE_' || {_Y} || {_M} || {_D} || '_120001.csv'
       ELSE 'orders_' || CASE WHEN o_orderkey % 4 = 1 THEN '0' ELSE '' END || {_Y} || '0231_120001.csv' END
  AS file_name
FROM {{orders}}
"""

# --- logs ---------------------------------------------------------------------------------------
AS_OF_RUNS = "1998-07-15"
EXECUTION = """
SELECT o_orderpriority AS table_name,
  'orders_' || CAST(o_orderkey AS STRING) || '.csv' AS filename,
  CASE WHEN o_orderkey % 4 = 0 THEN 'fixed' ELSE 'csv' END AS input_format,
  'FULL_SNAPSHOT' AS ingestion_mode, 'internal' AS output_zone,
  CAST(o_orderkey % 5000 AS BIGINT) AS row_count, CAST(o_custkey % 40 AS INT) AS column_count,
  FALSE AS masking_applied, CAST(o_orderkey % 7 AS BIGINT) AS error_count,
  CASE WHEN o_orderstatus = 'F' THEN 'Read error' ELSE '' END AS error_message,
  CASE WHEN o_orderstatus = 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  o_totalprice / 5000 AS duration, 'dev' AS env, o_orderdate AS log_ts,
  CAST(year(o_orderdate) AS INT) AS yyyy, CAST(month(o_orderdate) AS INT) AS mm,
  CAST(day(o_orderdate) AS INT) AS dd
FROM {orders}
"""
AS_OF_ERRORS = "2024-01-15"
QUALITY = """
SELECT 't' || CAST(user_id % 10 AS STRING) AS table_name,
  'orders_' || CAST(user_id AS STRING) || '.csv' AS filename,
  CASE WHEN event_id % 11 = 0 THEN 'filename' ELSE event_type END AS column_name,
  CASE WHEN event_type = 'view' THEN 'TYPE MISMATCH' WHEN event_type = 'signup' THEN 'INVALID_DATE'
       WHEN event_type = 'click' THEN 'REJECT' WHEN event_type = 'error' THEN 'ICT_DRIVEN_ABORT'
       ELSE 'NULL_VALUE' END AS error_kind,
  CASE WHEN event_type = 'view' THEN 'TYPE MISMATCH: Expected INT, found: ''x'''
       WHEN event_type = 'signup' THEN 'Invalid date: Month 13 invalid'
       WHEN event_type = 'click' THEN 'REJECT' WHEN event_type = 'error' THEN 'ICT_DRIVEN_ABORT'
       ELSE 'NULL_VALUE: Column ''a'' does not allow null' END AS error_message,
  props AS raw_value, CAST(floor(value) AS BIGINT) AS error_count,
  'internal' AS Zone, 'dev' AS Env, ts AS log_ts,
  CAST(year(ts) AS INT) AS yyyy, CAST(month(ts) AS INT) AS mm, CAST(day(ts) AS INT) AS dd
FROM {events}
"""

# --- keyed updates of customers -----------------------------------------------------------------
TARGET = """
SELECT c_custkey AS k, c_nationkey AS nation, c_name AS name, c_acctbal AS balance,
  c_mktsegment AS segment, TIMESTAMP '2024-01-02 00:00:00' AS valid_from
FROM {customer} WHERE c_custkey % 10 <> 9
"""
UPDATES = """
SELECT c_custkey AS k, c_nationkey AS nation, c_name || '*' AS name, c_acctbal + 1000 AS balance,
  CASE WHEN c_custkey % 2 = 0 THEN '2024-01-03 00:00:00' ELSE '2024-01-01 00:00:00' END AS valid_from,
  'batch' AS extra
FROM {customer} WHERE c_custkey % 3 = 0
UNION ALL
SELECT c_custkey AS k, c_nationkey AS nation, c_name || '**' AS name, c_acctbal + 2000 AS balance,
  '2024-01-04 00:00:00' AS valid_from, 'again' AS extra
FROM {customer} WHERE c_custkey % 12 = 0
UNION ALL
SELECT c_custkey + 100000000 AS k, c_nationkey AS nation, c_name || '+' AS name, c_acctbal AS balance,
  '2024-01-01 00:00:00' AS valid_from, 'new' AS extra
FROM {customer} WHERE c_custkey % 3 = 1
UNION ALL
SELECT NULL AS k, c_nationkey AS nation, c_name || '?' AS name, c_acctbal AS balance,
  '2024-01-05 00:00:00' AS valid_from, 'nokey' AS extra
FROM {customer} WHERE c_custkey % 50 = 7
"""

# --- events as daily files ----------------------------------------------------------------------
_EY, _EM, _ED = ymd("ts")
EVENTS = f"""
SELECT CASE WHEN event_id % 10 = 9 THEN 'eventsx_' ELSE 'events_' END || {_EY} || {_EM} || {_ED} || '_120000.csv' AS received,
  CAST(event_id AS STRING) AS event_id, CAST(user_id AS STRING) AS user_id, event_type,
  CAST(CAST(value AS DECIMAL(18,2)) AS STRING) AS value
FROM {{events}}
"""
EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value")


def events_csv(spark: SparkSession, sf_dir: str) -> str:
    return landed(
        spark, sf_dir, "events", lambda path: write_csv(sql(spark, sf_dir, EVENTS), path, ",", header=True)
    )
