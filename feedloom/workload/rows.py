"""Queries over columns, typing, policies, gates and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import casting, dates
from feedloom.operators import columns as cols
from feedloom.operators import errors as E
from feedloom.operators import gates, quality, typing
from feedloom.plans import ingest
from feedloom.session import fresh_dir, staged
from feedloom.sinks import logs
from feedloom.sources import delimited
from feedloom.sources.delimited import CORRUPT, FILE
from feedloom.specs import FieldSpec, tolerance_share
from feedloom.workload import feeds
from feedloom.workload.registry import duck, query, sql, table
from feedloom.workload.scans import _IS_CORRUPT, LINE_SPEC, order_spec

UNIT = ingest.UNIT

# --- the typed feed as SQL ----------------------------------------------------------------------
_NUMBER = r"regexp_full_match({x}, '[+-]?\d+(\.\d+)?')"
_WHOLE = r"regexp_full_match({x}, '[+-]?\d+')"


def _stamp(column: str) -> str:
    # The datetime patterns in order of trial.
    formats = ("%d/%m/%Y %H:%M:%S", "%d/%m/%Y", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y%m%d%H%M%S", "%Y%m%d", "%Y-%m-%d")
    return "COALESCE(" + ", ".join(f"TRY_STRPTIME({column}, '{f}')" for f in formats) + ")"


TYPED = f"""
SELECT received, CAST(order_id AS BIGINT) AS order_id,
  CASE WHEN trim(cust_id) = '' THEN NULL ELSE CAST(cust_id AS BIGINT) END AS cust_id,
  replace(amount, ',', '.') AS amount_text,
  CASE WHEN {_NUMBER.format(x="replace(amount, ',', '.')")} THEN TRY_CAST(replace(amount, ',', '.') AS DECIMAL(18,2)) END AS amount,
  odate AS odate_text, {_stamp("odate")} AS odate_ts,
  lower(trim(priority)) AS priority, qty AS qty_text,
  CASE WHEN {_WHOLE.format(x="qty")} THEN TRY_CAST(qty AS INT) END AS qty,
  urgent AS urgent_text, TRY_CAST(urgent AS BOOLEAN) AS urgent, status
FROM ({feeds.ORDERS}) f
"""


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delimited.scan(spark, feeds.orders_csv(spark, sf_dir), order_spec())


def typed(spark: SparkSession, sf_dir: str, **changes: dict) -> DataFrame:
    """Typed order rows, written once as in a load; every file is its own load unit."""
    spec = order_spec(fields=feeds.fields(**changes))
    return ingest.stage(orders(spark, sf_dir), spec).withColumn(UNIT, F.col(FILE))


def verdicts_of(rows: DataFrame, fields) -> tuple[DataFrame, DataFrame]:
    sizes = rows.groupBy(UNIT).agg(F.count(F.lit(1)).alias("rows"))
    counts = staged(gates.issue_counts(rows, UNIT), "issues")
    return counts, staged(gates.unit_verdicts(gates.ict_columns(counts, sizes, fields, UNIT), UNIT), "verdicts")


# --- columns ------------------------------------------------------------------------------------
_LINES_AGG = f"SELECT received, count(*) AS row_count, count(CASE WHEN {_IS_CORRUPT} THEN 1 END) AS corrupt_rows FROM ({feeds.LINES}) l GROUP BY 1"


@query(
    "missing_columns",
    duck(
        f"SELECT f.file_name AS filename, c.column_name, 'MISSING_COLUMN' AS error_message, 'orders' AS table_name FROM "
        f"(SELECT DISTINCT received AS file_name FROM ({feeds.ORDERS}) o) f CROSS JOIN (SELECT 'cust_name' AS column_name UNION ALL SELECT 'zip') c"
    ),
)
def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir)
    missing = cols.missing_columns(rows, [*feeds.ORDER_COLUMNS, "cust_name", "zip"])
    files = rows.select(F.col(FILE).alias("file_name")).distinct()
    return cols.missing_column_errors(files, missing, "orders").select(
        "filename", "column_name", "error_message", "table_name"
    )


@query(
    "add_missing_columns",
    duck(
        f"SELECT received AS file_name, order_id, amount, CAST(NULL AS STRING) AS cust_name, CAST(NULL AS STRING) AS zip FROM ({feeds.ORDERS}) f"
    ),
)
def add_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select(F.col(FILE).alias("file_name"), "order_id", "amount")
    return cols.align_to_string(rows, ["order_id", "amount", "cust_name", "zip"])


@query(
    "align_to_string",
    duck(
        "SELECT CAST(o_orderkey AS STRING) AS o_orderkey, CAST(o_custkey AS STRING) AS o_custkey, o_orderstatus, "
        "CAST(o_totalprice AS STRING) AS o_totalprice, CAST(o_orderdate AS STRING) AS o_orderdate, o_orderpriority, "
        "CAST(NULL AS STRING) AS o_comment FROM {orders}"
    ),
)
def align_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    return cols.align_to_string(rows, [*rows.columns, "o_comment"])


@query("trim_all", duck(f"SELECT order_id, trim(cust_id) AS cust_id, trim(priority) AS priority FROM ({feeds.ORDERS}) f"))
def trim_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cols.trim_all(orders(spark, sf_dir).select("order_id", "cust_id", "priority"))


@query("dedup_columns", duck("SELECT o_orderkey AS id, o_orderstatus AS Status FROM {orders}"))
def dedup_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority")
    return cols.dedup_columns(rows.toDF("id", "Status", "ID", "STATUS"))


@query(
    "metadata_stamp",
    duck(
        "SELECT replace(received, '.csv', '') AS FILE_NAME_RECEIVED, '2025-09-06 10:00:00' AS FILE_PROCESS_DATE, order_id, "
        "CAST(substr(received, 8, 4) AS INT) AS yyyy, CAST(substr(received, 12, 2) AS INT) AS mm, CAST(substr(received, 14, 2) AS INT) AS dd "
        f"FROM ({feeds.ORDERS}) f"
    ),
)
def metadata_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedloom.functions.filenames import name_parts, stem

    rows = orders(spark, sf_dir).select("order_id", FILE)
    at = F.lit("2025-09-06 10:00:00")
    return cols.stamp(rows, stem(F.col(FILE)), at, name_parts(F.col(FILE))).drop(FILE)


# --- texts and casts ----------------------------------------------------------------------------
@query("text_upper_lower", duck("SELECT c_custkey, upper(c_name) AS name, lower(c_mktsegment) AS segment FROM {customer}"))
def text_upper_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper, lower = FieldSpec("c_name", transform="uppercase"), FieldSpec("c_mktsegment", transform="lowercase")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        casting.text_transform(F.col("c_name"), upper).alias("name"),
        casting.text_transform(F.col("c_mktsegment"), lower).alias("segment"),
    )


@query(
    "text_regex_replace",
    duck(
        "SELECT c_custkey, regexp_replace(c_name, '[^0-9]+', '', 'g') AS digits, regexp_replace(c_name, '0+', '-', 'g') AS dashed FROM {customer}"
    ),
)
def text_regex_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = FieldSpec("d", transform="regex", pattern="[^0-9]+")
    dashed = FieldSpec("d", transform="regex", pattern="0+", replacement="-")
    name = F.col("c_name")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", casting.text_transform(name, digits).alias("digits"), casting.text_transform(name, dashed).alias("dashed")
    )


@query("decimal_comma", duck(f"SELECT order_id, replace(amount, ',', '.') AS amount FROM ({feeds.ORDERS}) f"))
def decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir)
    return rows.select("order_id", casting.source_text(F.col("amount"), FieldSpec("amount", "DECIMAL", 18, 2)).alias("amount"))


@query("blank_to_null", duck(f"SELECT order_id, CASE WHEN trim(cust_id) <> '' THEN cust_id END AS cust_id, CASE WHEN trim(odate) <> '' THEN odate END AS odate FROM ({feeds.ORDERS}) f"))
def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).select(
        "order_id", casting.blank_to_null(F.col("cust_id")).alias("cust_id"), casting.blank_to_null(F.col("odate")).alias("odate")
    )


@query(
    "safe_cast",
    duck(f"SELECT order_id, cust_id, CAST(amount AS DOUBLE) AS amount, qty, urgent, CAST(CASE WHEN qty IS NOT NULL THEN qty END AS DOUBLE) AS qty_double FROM ({TYPED}) t"),
)
def safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_name = {f.name: f for f in feeds.ORDER_FIELDS}

    def value(name: str, field: FieldSpec | None = None):
        field = field or by_name[name]
        return casting.safe_cast(casting.source_text(F.col(name), field), field)

    return orders(spark, sf_dir).select(
        value("order_id").alias("order_id"), value("cust_id").alias("cust_id"),
        value("amount").cast("double").alias("amount"), value("qty").alias("qty"), value("urgent").alias("urgent"),
        value("qty", FieldSpec("qty", "DOUBLE")).alias("qty_double"),
    )


_BAD = {
    "order_id": "0", "cust_id": "0",
    "amount": "count(CASE WHEN amount IS NULL THEN 1 END)",
    "priority": "0",
    "qty": "count(CASE WHEN qty IS NULL THEN 1 END)",
    "urgent": "count(CASE WHEN urgent IS NULL THEN 1 END)",
    "status": "0",
}


@query(
    "invalid_counts",
    duck(
        " UNION ALL ".join(
            f"SELECT received AS file_name, CAST(count(*) AS BIGINT) AS rows, '{c}' AS column_name, CAST({n} AS BIGINT) AS invalid FROM ({TYPED}) t GROUP BY received"
            for c, n in _BAD.items()
        )
    ),
)
def invalid_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).withColumn("file_name", F.col(FILE))
    return typing.invalid_counts(rows, feeds.ORDER_FIELDS, ["file_name"])


@query("date_multi_pattern", duck(f"SELECT order_id, CAST(odate_ts AS STRING) AS odate_ts, CAST(CAST(odate_ts AS DATE) AS STRING) AS odate FROM ({TYPED}) t"))
def date_multi_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = dates.parse_first(F.col("odate"), FieldSpec("odate", "DATE").date_patterns)
    return orders(spark, sf_dir).select(
        F.col("order_id").cast("long").alias("order_id"), parsed.cast("string").alias("odate_ts"),
        dates.as_temporal(parsed, "DATE").cast("string").alias("odate"),
    )


@query("date_default", duck(f"SELECT order_id, CAST(COALESCE(CAST(odate_ts AS DATE), DATE '1900-01-01') AS STRING) AS odate FROM ({TYPED}) t"))
def date_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(spark, sf_dir, odate={"default": "1900-01-01"})
    return rows.select("order_id", F.col("odate").cast("string").alias("odate"))


_DATE_ERRORS = f"""
SELECT received AS filename, 'odate' AS column_name,
  CASE WHEN trim(odate_text) = '' THEN 'EMPTY_DATE' ELSE 'INVALID_DATE' END AS error_message,
  trim(odate_text) AS raw_value, CAST(1 AS BIGINT) AS error_count, 'orders' AS table_name
FROM ({TYPED}) t WHERE odate_text IS NOT NULL AND odate_ts IS NULL
"""
_SHOWN = ("filename", "column_name", "error_message", "raw_value", "error_count", "table_name")


@query("date_errors", duck(_DATE_ERRORS))
def date_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = typing.issue_rows(typed(spark, sf_dir), feeds.ORDER_FIELDS, "orders", F.col(FILE))
    return found.where(F.col("error_kind").isin(E.EMPTY_DATE, E.INVALID_DATE)).select(*_SHOWN)


# --- policies -----------------------------------------------------------------------------------
@query("policy_reject", duck(f"SELECT received AS file_name, order_id, qty FROM ({TYPED}) t WHERE qty IS NOT NULL"))
def policy_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(spark, sf_dir, qty={"on_error": "REJECT"})
    return rows.where(~F.col(typing.DROPPED)).select(F.col(FILE).alias("file_name"), "order_id", "qty")


@query("reject_rows", duck(f"SELECT 'orders' AS table_name, received AS file_name, order_id, qty_text AS raw_value FROM ({TYPED}) t WHERE qty IS NULL"))
def reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged, written to the reject folder of a load and read back from its layout."""
    fields = feeds.fields(qty={"on_error": "REJECT"})
    spec = order_spec(fields=fields)
    rows = ingest.stage(orders(spark, sf_dir), spec)
    load = ingest.judge(spec, rows, rows.select(F.col(FILE).alias("file_name")).distinct())
    root = fresh_dir(spark, "badrecords")
    logs.write_rejects(ingest.rejected_lines(load, rows), root, "orders", "first")
    back = logs.read_rejects(spark, root)
    return back.where(F.exists("issues", lambda i: i["kind"] == E.REJECT)).select(
        "table_name", F.col("filename").alias("file_name"),
        F.col("texts")["order_id"].cast("long").alias("order_id"), F.col("texts")["qty"].alias("raw_value"),
    )


@query(
    "policy_ict_flag",
    duck(
        f"SELECT received AS filename, 'amount' AS column_name, 'ICT_DRIVEN' AS error_message, amount_text AS raw_value, CAST(1 AS BIGINT) AS error_count, 'orders' AS table_name FROM ({TYPED}) t WHERE amount IS NULL "
        f"UNION ALL SELECT received, 'qty', 'ICT_DRIVEN', qty_text, CAST(1 AS BIGINT), 'orders' FROM ({TYPED}) t WHERE qty IS NULL"
    ),
)
def policy_ict_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = typing.issue_rows(typed(spark, sf_dir), feeds.ORDER_FIELDS, "orders", F.col(FILE))
    return found.where(F.col("error_kind") == E.ICT_DRIVEN).select(*_SHOWN)


@query(
    "policy_ict_abort",
    duck(
        f"SELECT received AS filename, 'amount' AS column_name, 'ICT_DRIVEN_ABORT' AS error_message, CAST(NULL AS STRING) AS raw_value, "
        f"CAST(count(*) - count(amount) AS BIGINT) AS error_count, 'orders' AS table_name FROM ({TYPED}) t GROUP BY received HAVING (count(*) - count(amount)) * 1.0 / count(*) > 0.01"
    ),
)
def policy_ict_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = feeds.fields(amount={"tolerance": feeds.share("1%")})
    rows = typed(spark, sf_dir, amount={"tolerance": feeds.share("1%")})
    _, verdicts = verdicts_of(rows, fields)
    return gates.abort_errors(verdicts, fields, "orders", UNIT).select(*_SHOWN)


@query(
    "policy_log_only",
    duck(
        f"SELECT received AS filename, 'urgent' AS column_name, 'LOG_ONLY' AS error_message, CAST(NULL AS STRING) AS raw_value, "
        f"CAST(count(*) - count(urgent) AS BIGINT) AS error_count, 'orders' AS table_name FROM ({TYPED}) t GROUP BY received HAVING count(*) > count(urgent)"
    ),
)
def policy_log_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(spark, sf_dir)
    counts, verdicts = verdicts_of(rows, feeds.ORDER_FIELDS)
    return gates.summary_errors(counts, verdicts, feeds.ORDER_FIELDS, "orders", UNIT).select(*_SHOWN)


_REJECTED = "(amount IS NULL AND qty IS NULL)"


@query(
    "reject_lines",
    duck(f"SELECT received AS file_name, order_id, CAST(amount AS DOUBLE) AS amount, qty FROM ({TYPED}) t WHERE NOT {_REJECTED}"),
)
def reject_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(spark, sf_dir)
    _, verdicts = verdicts_of(rows, feeds.ORDER_FIELDS)
    kept = gates.judge_rows(rows, verdicts, UNIT).where("_kept")
    return kept.select(F.col(FILE).alias("file_name"), "order_id", F.col("amount").cast("double").alias("amount"), "qty")


@query(
    "corrupt_gate",
    duck(f"SELECT received AS file_name, row_count AS rows, corrupt_rows, corrupt_rows > 0.03 * row_count AS aborted FROM ({_LINES_AGG}) a"),
)
def corrupt_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = delimited.scan(spark, feeds.order_lines(spark, sf_dir), LINE_SPEC)
    counts = gates.corrupt_counts(rows.withColumnRenamed(FILE, "file_name"), "file_name", CORRUPT)
    return counts.withColumn("aborted", gates.too_corrupt(counts, feeds.share("3%")))


TOLERANCES = """
SELECT c_custkey AS id, CAST(c_custkey % 40 AS BIGINT) AS rows,
  CASE WHEN c_custkey % 7 = 0 THEN '10%' WHEN c_custkey % 7 = 1 THEN CAST(c_custkey % 30 AS STRING)
       WHEN c_custkey % 7 = 2 THEN '2,5 %' WHEN c_custkey % 7 = 3 THEN '' WHEN c_custkey % 7 = 4 THEN 'n/a'
       WHEN c_custkey % 7 = 5 THEN 'ten' ELSE NULL END AS raw
FROM {customer}
"""


@query(
    "tolerance_eval",
    duck(
        "SELECT id, CASE WHEN raw = '10%' THEN 0.1 WHEN raw = '2,5 %' THEN 0.025 WHEN raw IS NULL OR raw IN ('', 'n/a', 'ten') THEN 0.0 "
        f"WHEN rows > 0 THEN round(CAST(raw AS DOUBLE) / rows, 6) ELSE 0.0 END AS share FROM ({TOLERANCES}) t"
    ),
)
def tolerance_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = tolerance_share(F.col("raw"), F.col("rows"))
    return sql(spark, sf_dir, TOLERANCES).select("id", F.round(share, 6).alias("share"))


_CHECKED = (FieldSpec("qty", "INTEGER", nullable=False), FieldSpec("cust_id", "LONG", nullable=False))


@query(
    "final_type_check",
    duck(
        f"SELECT received AS filename, 'qty' AS column_name, 'TYPE MISMATCH: Expected INTEGER, found: ''' || qty_text || '''' AS error_message, qty_text AS raw_value, CAST(1 AS BIGINT) AS error_count, 'orders' AS table_name FROM ({TYPED}) t WHERE qty IS NULL "
        f"UNION ALL SELECT received, 'cust_id', 'TYPE MISMATCH: Expected LONG, found: ''  ''', '  ', CAST(1 AS BIGINT), 'orders' FROM ({feeds.ORDERS}) f WHERE cust_id = '  '"
    ),
)
def final_type_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = typing.final_check(orders(spark, sf_dir).select("qty", "cust_id", FILE), _CHECKED)
    found = typing.issue_rows(checked, _CHECKED, "orders", F.col(FILE))
    return found.where(F.col("error_kind") == E.TYPE_MISMATCH).select(*_SHOWN)


@query(
    "not_null_check",
    duck(
        f"SELECT received AS filename, 'qty' AS column_name, 'NULL_VALUE: Column ''qty'' does not allow null' AS error_message FROM ({TYPED}) t WHERE qty IS NULL "
        f"UNION ALL SELECT received, 'cust_id', 'NULL_VALUE: Column ''cust_id'' does not allow null' FROM ({TYPED}) t WHERE cust_id IS NULL"
    ),
)
def not_null_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = typing.final_check(orders(spark, sf_dir).select("qty", "cust_id", FILE), _CHECKED)
    found = typing.issue_rows(checked, _CHECKED, "orders", F.col(FILE))
    return found.where(F.col("error_kind") == E.NULL_VALUE).select("filename", "column_name", "error_message")


@query(
    "error_cap",
    duck(
        f"SELECT filename, error_message, order_id FROM (SELECT received AS filename, CASE WHEN trim(odate_text) = '' THEN 'EMPTY_DATE' ELSE 'INVALID_DATE' END AS error_message, order_id, "
        f"row_number() OVER (PARTITION BY received, CASE WHEN trim(odate_text) = '' THEN 'EMPTY_DATE' ELSE 'INVALID_DATE' END ORDER BY order_id) AS rn "
        f"FROM ({TYPED}) t WHERE odate_text IS NOT NULL AND odate_ts IS NULL) r WHERE rn <= 10"
    ),
)
def error_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = typing.issue_rows(typed(spark, sf_dir), feeds.ORDER_FIELDS, "orders", F.col(FILE), keep=["order_id"])
    dated = found.where(F.col("column_name") == "odate")
    return E.cap(dated, 10, ["filename", "column_name", "error_kind"], ["order_id"]).select(
        "filename", "error_message", "order_id"
    )


# --- quality ------------------------------------------------------------------------------------
_DUPLICATES = (
    "SELECT l_returnflag AS filename, 'orderkey,linenumber' AS column_name, 'DUPLICATE_KEY' AS error_message, "
    "CAST(count(*) AS BIGINT) AS error_count FROM {lineitem} GROUP BY l_returnflag, l_orderkey, l_linenumber HAVING count(*) > 1"
)


@query("duplicate_keys", duck(_DUPLICATES))
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"), F.col("l_returnflag").alias("unit")
    )
    found = quality.duplicate_keys(rows, ["orderkey", "linenumber", "unknown"], "lines", "unit")
    return found.select("filename", "column_name", "error_message", "error_count")


HOLLOW = """
SELECT 'part_' || CAST(p_size AS STRING) AS unit,
  CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_name END AS name,
  CASE WHEN p_size % 5 = 0 OR p_partkey % 2 = 0 THEN NULL ELSE p_brand END AS brand FROM {part}
"""


@query("file_empty", duck(f"SELECT unit AS filename, 'ALL_COLUMNS' AS column_name, 'FILE_EMPTY' AS error_message FROM ({HOLLOW}) h GROUP BY unit HAVING count(name) = 0 AND count(brand) = 0"))
def file_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sql(spark, sf_dir, HOLLOW)
    units = rows.select("unit").distinct()
    return quality.empty_units(units, rows, "unit", ["name", "brand"], "parts").select(
        "filename", "column_name", "error_message"
    )


# --- error rows together ------------------------------------------------------------------------
_ALL_ERRORS = f"""
SELECT filename, column_name, error_message, raw_value, error_count FROM ({_DATE_ERRORS}) d
UNION ALL SELECT received, 'amount', 'ICT_DRIVEN', amount_text, 1 FROM ({TYPED}) t WHERE amount IS NULL
UNION ALL SELECT received, 'qty', 'ICT_DRIVEN', qty_text, 1 FROM ({TYPED}) t WHERE qty IS NULL
UNION ALL SELECT received, 'MULTIPLE_COLUMNS', 'ICT_DRIVEN_LINE_REJECT', NULL, 1 FROM ({TYPED}) t WHERE {_REJECTED}
UNION ALL SELECT received, 'urgent', 'LOG_ONLY', NULL, count(*) - count(urgent) FROM ({TYPED}) t GROUP BY received HAVING count(*) > count(urgent)
UNION ALL SELECT received, 'amount', 'NULL_VALUE: Column ''amount'' does not allow null', NULL, 1 FROM ({TYPED}) t WHERE amount IS NULL AND NOT {_REJECTED}
UNION ALL SELECT received, 'qty', 'NULL_VALUE: Column ''qty'' does not allow null', NULL, 1 FROM ({TYPED}) t WHERE qty IS NULL AND NOT {_REJECTED}
UNION ALL SELECT received, 'urgent', 'NULL_VALUE: Column ''urgent'' does not allow null', NULL, 1 FROM ({TYPED}) t WHERE urgent IS NULL AND NOT {_REJECTED}
"""
_ERROR_ROWS = f"SELECT filename, column_name, error_message, raw_value, CAST(error_count AS BIGINT) AS error_count FROM ({_ALL_ERRORS}) e"


def load_of(spark: SparkSession, sf_dir: str) -> ingest.Load:
    """The whole order feed judged, every file on its own, with all error rows kept."""
    spec = order_spec(max_logged_errors=None, file_policy="each")
    rows = ingest.stage(orders(spark, sf_dir), spec)
    files = rows.select(F.col(FILE).alias("file_name")).distinct()
    return ingest.judge(spec, rows, files)


@query("error_union", duck(_ERROR_ROWS))
def error_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_of(spark, sf_dir).errors.select("filename", "column_name", "error_message", "raw_value", "error_count")


@query(
    "quality_log",
    duck(
        f"SELECT 'orders' AS table_name, filename, column_name, error_message, raw_value, error_count, 'internal' AS Zone, 'dev' AS Env, "
        f"'2025-09-06 10:00:00' AS log_ts, 2025 AS yyyy, 9 AS mm, 6 AS dd FROM ({_ERROR_ROWS}) e"
    ),
)
def quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended to the log and read back."""
    at = F.lit("2025-09-06 10:00:00").cast("timestamp")
    path = fresh_dir(spark, "quality")
    logs.append_log(logs.quality_rows(load_of(spark, sf_dir).errors, "orders", "internal", "dev", at), path)
    back = logs.read_log(spark, path, logs.QUALITY_LOG)
    return back.drop("error_kind").withColumn("log_ts", F.col("log_ts").cast("string"))


@query(
    "execution_log",
    duck(
        f"""WITH t AS ({TYPED}), e AS (SELECT filename, count(*) AS n FROM ({_ALL_ERRORS}) x GROUP BY 1)
        SELECT 'orders' AS table_name, received AS filename, 'csv' AS input_format, '' AS ingestion_mode, 'internal' AS output_zone,
          CAST(count(*) AS BIGINT) AS row_count, 8 AS column_count, FALSE AS masking_applied, CAST(max(e.n) AS BIGINT) AS error_count,
          max(e.n) || ' errors detected' AS error_message, 'SUCCESS' AS status, 'dev' AS env, 2025 AS yyyy, 9 AS mm, 6 AS dd
        FROM t JOIN e ON e.filename = t.received WHERE NOT {_REJECTED} GROUP BY received"""
    ),
)
def execution_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended to the log and read back."""
    load = load_of(spark, sf_dir)
    at = F.lit("2025-09-06 10:00:00").cast("timestamp")
    path = fresh_dir(spark, "execution")
    runs = ingest.with_error_counts(load.runs, load.errors)
    logs.append_log(logs.execution_rows(runs, "dev", at), path)
    return logs.read_log(spark, path, logs.EXECUTION_LOG).drop("log_ts", "duration")


@query(
    "final_metrics",
    duck(
        f"""WITH e AS ({_ERROR_ROWS}), c AS (SELECT coalesce(sum(error_count) FILTER (error_message LIKE '%Invalid%' OR error_message LIKE '%TYPE MISMATCH%' OR error_message LIKE '%REJECT%'), 0) AS corrupt_rows,
          coalesce(sum(error_count) FILTER (error_message IN ('INVALID_DATE', 'ICT_DRIVEN_LINE_REJECT')), 0) AS by_kind, count(*) AS anomalies FROM e),
          r AS (SELECT count(*) AS n FROM ({TYPED}) t WHERE NOT {_REJECTED})
        SELECT CAST(r.n AS BIGINT) AS total_rows_after, CAST(corrupt_rows AS BIGINT) AS corrupt_rows, CAST(by_kind AS BIGINT) AS corrupt_rows_by_kind,
          CAST(r.n - corrupt_rows AS BIGINT) AS cleaned_rows, CAST(anomalies AS BIGINT) AS anomalies_total FROM r, c"""
    ),
)
def final_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedloom.observability import reports

    load = load_of(spark, sf_dir)
    return reports.final_metrics(load.accepted, load.errors)


@query(
    "error_summary",
    duck(
        f"SELECT error_message, CAST(sum(error_count) AS BIGINT) AS total_count, CASE WHEN contains(lower(error_message), 'null') THEN 'null' ELSE 'type' END AS family "
        f"FROM ({_ERROR_ROWS}) e GROUP BY error_message ORDER BY total_count DESC, error_message LIMIT 50"
    ),
)
def error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedloom.observability import reports

    return reports.error_summary(load_of(spark, sf_dir).errors)


@query(
    "scalar_functions",
    duck(
        "SELECT o_orderkey, upper(o_orderpriority) AS up, lower(o_orderpriority) AS low, length(o_orderpriority) AS len, substr(o_orderpriority, 3, 4) AS sub, "
        "split_part(o_orderpriority, '-', 2) AS word, regexp_extract(o_orderpriority, '([A-Z]+)', 1) AS caps, starts_with(o_orderpriority, '1') AS urgent, "
        "contains(o_orderpriority, 'LOW') AS low_one, lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS mm, strftime(o_orderdate, '%H:%M:%S') AS clock, "
        "CAST(CAST(o_orderdate AS DATE) - 7 AS STRING) AS week_before, round(o_totalprice / 7, 2) AS seventh, "
        "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS open_status, coalesce(nullif(o_orderstatus, 'F'), '-') AS shown, "
        "TRY_CAST(CASE WHEN regexp_full_match(substr(o_orderpriority, 1, 1), '\\d') THEN substr(o_orderpriority, 1, 1) END AS INT) AS level FROM {orders}"
    ),
)
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, at, status = F.col("o_orderpriority"), F.col("o_orderdate"), F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.upper(p).alias("up"), F.lower(p).alias("low"), F.length(p).cast("long").alias("len"),
        F.substring(p, 3, 4).alias("sub"), F.element_at(F.split(p, "-"), 2).alias("word"),
        F.regexp_extract(p, "([A-Z]+)", 1).alias("caps"), p.startswith("1").alias("urgent"), p.contains("LOW").alias("low_one"),
        F.lpad(F.month(at).cast("string"), 2, "0").alias("mm"), F.date_format(at, "HH:mm:ss").alias("clock"),
        F.date_sub(F.to_date(at), 7).cast("string").alias("week_before"), F.round(F.col("o_totalprice") / 7, 2).alias("seventh"),
        F.when(status != "F", status).alias("open_status"), F.coalesce(F.when(status != "F", status), F.lit("-")).alias("shown"),
        F.substring(p, 1, 1).try_cast("int").alias("level"),
    )
