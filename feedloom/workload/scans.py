"""Queries over scans, file names, listings and archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions import filenames as names
from feedloom.operators.quality import number_lines
from feedloom.sources import archive, delimited, fixed_width, listing
from feedloom.sources.delimited import CORRUPT, FILE
from feedloom.specs import EACH, FIRST, MERGE, NAMES, POSITIONAL, SKIP_POSITIONAL, FeedSpec, FieldSpec
from feedloom.workload import feeds
from feedloom.workload.registry import duck, query, sql, table

_ORDER_ROWS = ", ".join(feeds.ORDER_COLUMNS)
ORDERS_ORACLE = duck(f"SELECT received AS file_name, {_ORDER_ROWS} FROM ({feeds.ORDERS}) f")


def order_spec(**changes) -> FeedSpec:
    base = FeedSpec("orders", feeds.ORDER_FIELDS, delimiter=";", filename_pattern="orders_<yyyy><mm><dd>_<hhmmss>.csv")
    return base.with_(**changes)


def _named(rows: DataFrame) -> DataFrame:
    source = [c for c in rows.columns if not c.startswith("_") or c.startswith("_c") and c != CORRUPT]
    return rows.select(F.col(FILE).alias("file_name"), *source)


@query("csv_scan", ORDERS_ORACLE)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(delimited.scan(spark, feeds.orders_csv(spark, sf_dir), order_spec()))


@query("imposed_schema_scan", ORDERS_ORACLE)
def imposed_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The control table lists the columns in another order than the file has them.
    rows = [
        {"Column Name": c, "Field Order": i, "Field type": "STRING"}
        for i, c in reversed(list(enumerate(feeds.ORDER_COLUMNS)))
    ]
    spec = FeedSpec.from_rows({"Delta Table Name": "orders", "Input delimiter": ";"}, rows)
    return _named(delimited.scan(spark, feeds.orders_csv(spark, sf_dir), spec))


@query("header_names_scan", ORDERS_ORACLE)
def header_names_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = order_spec(header=NAMES, imposed=False)
    return _named(delimited.scan(spark, feeds.orders_csv(spark, sf_dir, header=True), spec))


@query(
    "header_skip_scan",
    duck(
        "SELECT received AS file_name, order_id AS c1, cust_id AS c2, amount AS c3, odate AS c4, "
        f"priority AS c5, qty AS c6, urgent AS c7, status AS c8 FROM ({feeds.ORDERS}) f"
    ),
)
def header_skip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = tuple(FieldSpec(f"c{i}") for i in range(1, 9))
    spec = order_spec(header=SKIP_POSITIONAL, imposed=False, fields=fields)
    return _named(delimited.scan(spark, feeds.orders_csv(spark, sf_dir, header=True), spec))


@query(
    "no_header_scan",
    duck(
        "SELECT received AS file_name, order_id AS _c0, cust_id AS _c1, amount AS _c2, odate AS _c3, "
        f"priority AS _c4, qty AS _c5, urgent AS _c6, status AS _c7 FROM ({feeds.ORDERS}) f"
    ),
)
def no_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Seven configured names do not fit eight columns, so the columns keep positional names.
    spec = order_spec(header=POSITIONAL, imposed=False, fields=feeds.ORDER_FIELDS[:7])
    return _named(delimited.scan(spark, feeds.orders_csv(spark, sf_dir), spec))


@query("header_lowercase", ORDERS_ORACLE)
def header_lowercase(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> None:
        rows = sql(spark, sf_dir, feeds.ORDERS)
        upper = rows.toDF("received", *[c.upper() for c in feeds.ORDER_COLUMNS])
        feeds.write_csv(upper, path, header=True)

    path = feeds.landed(spark, sf_dir, "orders-upper", write)
    spec = order_spec(header=NAMES, imposed=False, fields=())
    return _named(delimited.lower_names(delimited.scan(spark, path, spec)))


TALK = """
SELECT 'talk_' || role || '.csv' AS received, CAST(conv_id AS STRING) AS conv_id,
  CAST(turn AS STRING) AS turn, role, {text} AS text FROM {{conversations}}
"""
_ONE_LINE = TALK.format(text="replace(text, chr(10), ' \"|\", ')")
_WHOLE = TALK.format(text="text")
_TALK_FIELDS = tuple(FieldSpec(c) for c in ("conv_id", "turn", "role", "text"))


@query("csv_quote_scan", duck(f"SELECT conv_id, turn, role, text FROM ({_ONE_LINE}) t"))
def csv_quote_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = feeds.landed(
        spark, sf_dir, "talk-quoted", lambda p: feeds.write_csv(sql(spark, sf_dir, _ONE_LINE), p, ",")
    )
    spec = FeedSpec("talk", _TALK_FIELDS, input_format="csv_quote")
    return delimited.scan(spark, path, spec).select("conv_id", "turn", "role", "text")


@query("csv_multiline_scan", duck(f"SELECT conv_id, turn, role, text FROM ({_WHOLE}) t"))
def csv_multiline_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = feeds.landed(
        spark, sf_dir, "talk-lines", lambda p: feeds.write_csv(sql(spark, sf_dir, _WHOLE), p, ",")
    )
    spec = FeedSpec("talk", _TALK_FIELDS, input_format="csv_quote_ml")
    return delimited.scan(spark, path, spec).select("conv_id", "turn", "role", "text")


LINE_SPEC = FeedSpec(
    "orders", (FieldSpec("order_id"), FieldSpec("qty"), FieldSpec("status")), delimiter=";"
)
_IS_CORRUPT = "length(line) - length(replace(line, ';', '')) <> 2"


@query(
    "corrupt_records",
    duck(
        f"SELECT received AS file_name, order_id, CASE WHEN {_IS_CORRUPT} THEN line END AS corrupt_line "
        f"FROM ({feeds.LINES}) l"
    ),
)
def corrupt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = delimited.scan(spark, feeds.order_lines(spark, sf_dir), LINE_SPEC)
    return rows.select(F.col(FILE).alias("file_name"), "order_id", F.col(CORRUPT).alias("corrupt_line"))


FIXED = """
SELECT CASE WHEN l_linestatus = 'F' THEN 'lines_f.txt' ELSE 'lines_o.txt' END AS received,
  lpad(CAST(l_orderkey AS STRING), 12, ' ') || lpad(CAST(l_linenumber AS STRING), 3, ' ')
  || lpad(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING), 14, ' ')
  || l_returnflag || l_linestatus AS line
FROM {lineitem}
"""
FIXED_SPEC = FeedSpec(
    "lines",
    (
        FieldSpec("orderkey", size=12), FieldSpec("linenumber", size=3), FieldSpec("price", size=14),
        FieldSpec("returnflag"), FieldSpec("linestatus"),
    ),
    input_format="fixed",
)


@query(
    "fixed_width_scan",
    duck(
        "SELECT received AS file_name, substr(line, 1, 12) AS orderkey, substr(line, 13, 3) AS linenumber, "
        "substr(line, 16, 14) AS price, substr(line, 30, 1) AS returnflag, substr(line, 31, 1) AS linestatus "
        f"FROM ({FIXED}) f"
    ),
)
def fixed_width_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = feeds.landed(
        spark, sf_dir, "fixed", lambda p: sql(spark, sf_dir, FIXED).write.partitionBy("received").text(p)
    )
    return _named(fixed_width.scan(spark, path, FIXED_SPEC))


def _with_empty_files(spark: SparkSession, sf_dir: str) -> str:
    """The order feed plus a delivery without a byte for every order status."""

    def write(path: str) -> None:
        feeds.write_csv(sql(spark, sf_dir, feeds.ORDERS), path)
        nothing = spark.createDataFrame([], "line string")
        for status in ("F", "O", "P"):
            nothing.write.text(f"{path}/received=empty_{status}_20200105.csv")

    return feeds.landed(spark, sf_dir, "orders-and-empty", write)


@query(
    "skip_empty_files",
    duck(
        f"SELECT received AS file_name, 'OK' AS state, CAST(count(*) AS BIGINT) AS row_count FROM ({feeds.ORDERS}) f GROUP BY 1, 2 "
        "UNION ALL SELECT DISTINCT 'empty_' || o_orderstatus || '_20200105.csv', 'FILE_EMPTY', CAST(0 AS BIGINT) FROM {orders}"
    ),
)
def skip_empty_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _with_empty_files(spark, sf_dir)
    rows = delimited.scan(spark, path, order_spec())
    filled = rows.groupBy(F.col(FILE).alias("file_name")).agg(F.count(F.lit(1)).alias("row_count"))
    empty = listing.empty_files(spark, path).select(
        "file_name", F.lit("FILE_EMPTY").alias("state"), F.lit(0).cast("long").alias("row_count")
    )
    return filled.select("file_name", F.lit("OK").alias("state"), "row_count").unionByName(empty)


# --- names --------------------------------------------------------------------------------------


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, feeds.NAMES)


@query(
    "filename_match",
    duck(
        f"SELECT file_name FROM ({feeds.NAMES}) n WHERE regexp_full_match(file_name, "
        r"'orders_\d\d\d\d\d\d\d\d(_\d\d\d\d\d\d)?\.csv')"
    ),
)
def filename_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.match_pattern(_names(spark, sf_dir), "orders_<yyyy><mm><dd>_<hhmmss>.csv")


_DATE = r"'(\d\d\d\d)[-_]?(\d\d)[-_]?(\d\d)'"
_PARTS = (
    f"SELECT file_name, TRY_CAST(regexp_extract(file_name, {_DATE}, 1) AS INT) AS yyyy, "
    f"TRY_CAST(regexp_extract(file_name, {_DATE}, 2) AS INT) AS mm, "
    f"TRY_CAST(regexp_extract(file_name, {_DATE}, 3) AS INT) AS dd FROM ({feeds.NAMES}) n"
)


@query("filename_parts", duck(_PARTS))
def filename_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = names.name_parts(F.col("file_name"))
    return _names(spark, sf_dir).select("file_name", *[v.alias(k) for k, v in parts.items()])


_VALIDATE = f"""
WITH p AS ({_PARTS})
SELECT file_name,
  CASE WHEN yyyy IS NULL THEN 'Missing date pattern'
       WHEN yyyy = 0 OR mm = 0 THEN 'Invalid date: Missing year or month'
       WHEN yyyy < 1900 OR yyyy > 2100 THEN 'Invalid date: Year ' || yyyy || ' out of range'
       WHEN mm > 12 THEN 'Invalid date: Month ' || mm || ' invalid'
       WHEN dd < 1 OR dd > 31 THEN 'Invalid date: Day ' || dd || ' invalid'
       WHEN TRY_CAST(lpad(CAST(yyyy AS STRING), 4, '0') || '-' || lpad(CAST(mm AS STRING), 2, '0') || '-'
            || lpad(CAST(dd AS STRING), 2, '0') AS DATE) IS NULL
         THEN 'Invalid date: day is out of range for month' END AS reason,
  CASE WHEN yyyy IS NULL THEN NULL WHEN yyyy = 0 OR mm = 0 THEN 'N/A'
       ELSE yyyy || '-' || lpad(CAST(mm AS STRING), 2, '0') || '-' || lpad(CAST(dd AS STRING), 2, '0') END AS shown
FROM p
"""


@query(
    "filename_validate",
    duck(f"SELECT file_name, reason, CASE WHEN reason IS NOT NULL THEN shown END AS invalid_value FROM ({_VALIDATE}) v"),
)
def filename_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = listing.check_names(_names(spark, sf_dir))
    bad = F.col("reason").isNotNull()
    return checked.select("file_name", "reason", F.when(bad, F.col("invalid_value")).alias("invalid_value"))


_ACCEPTED = f"SELECT file_name FROM ({_VALIDATE}) v WHERE reason IS NULL AND file_name LIKE 'orders%'"


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = listing.check_names(_names(spark, sf_dir))
    return checked.where(F.col("reason").isNull() & F.col("file_name").startswith("orders")).select("file_name")


@query("file_policy_first", duck(f"SELECT min(file_name) AS file_name FROM ({_ACCEPTED}) a"))
def file_policy_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.choose(_accepted(spark, sf_dir), FIRST)


@query(
    "file_policy_each",
    duck(
        f"SELECT 'each' AS policy, file_name, file_name AS unit FROM ({_ACCEPTED}) a UNION ALL "
        f"SELECT 'merge', file_name, 'merged_' || (SELECT count(*) FROM ({_ACCEPTED}) b) || '_files' FROM ({_ACCEPTED}) c"
    ),
)
def file_policy_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _accepted(spark, sf_dir)
    sides = [
        listing.load_units(files, p).select(F.lit(p).alias("policy"), "file_name", "unit")
        for p in (EACH, MERGE)
    ]
    return sides[0].unionByName(sides[1])


@query(
    "table_from_filename",
    duck(
        "SELECT file_name, lower(CASE WHEN regexp_full_match(split_part(stem, '_', 1), '\\d+') "
        "THEN split_part(stem, '_', 2) ELSE split_part(stem, '_', 1) END) AS feed FROM (SELECT file_name, "
        f"regexp_replace(file_name, '\\.[^.]*$', '') AS stem FROM ({feeds.NAMES}) n) s"
    ),
)
def table_from_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select("file_name", names.feed_of(F.col("file_name")).alias("feed"))


SEEN = """
SELECT DISTINCT CASE WHEN c_custkey % 4 = 0 THEN lower(c_mktsegment)
  WHEN c_custkey % 4 = 1 THEN lower(c_mktsegment) || '_' || CAST(c_nationkey AS STRING)
  WHEN c_custkey % 4 = 2 THEN lower(substr(c_mktsegment, 1, 4))
  ELSE 'zone' || lower(c_mktsegment) || CAST(c_nationkey AS STRING) END AS name FROM {customer}
"""
CONFIGURED = """
SELECT table_name, length(table_name) * 1000 + ascii(table_name) AS position FROM (
  SELECT DISTINCT c_mktsegment AS table_name FROM {customer}
  UNION SELECT DISTINCT c_mktsegment || '_1' AS table_name FROM {customer}) t
"""
_MATCH = f"""
SELECT how, name, table_name, CASE WHEN table_name IS NULL THEN 'default' WHEN exact THEN 'exact' ELSE 'partial' END AS match
FROM (
  SELECT h.how, s.name, c.table_name, lower(c.table_name) = s.name AS exact,
    row_number() OVER (PARTITION BY h.how, s.name ORDER BY CASE WHEN lower(c.table_name) = s.name THEN 0 ELSE 1 END, c.position, c.table_name) AS rn
  FROM (SELECT 'prefix' AS how UNION ALL SELECT 'substring') h CROSS JOIN ({SEEN}) s LEFT JOIN ({CONFIGURED}) c
    ON CASE WHEN h.how = 'prefix' THEN starts_with(s.name, lower(c.table_name)) OR starts_with(lower(c.table_name), s.name)
       ELSE contains(s.name, lower(c.table_name)) OR contains(lower(c.table_name), s.name) END
) r WHERE rn = 1
"""


@query("config_match", duck(_MATCH))
def config_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, configured = sql(spark, sf_dir, SEEN), sql(spark, sf_dir, CONFIGURED)
    sides = [
        listing.match_config(seen, configured, how).select(F.lit(how).alias("how"), "name", "table_name", "match")
        for how in ("prefix", "substring")
    ]
    return sides[0].unionByName(sides[1])


# --- landing trees ------------------------------------------------------------------------------
_TREE_Y = feeds.ymd("o_orderdate")[0]
TREE = f"""
SELECT 'zone_' || lower(o_orderstatus) AS folder,
  CASE WHEN o_orderkey % 3 = 0 THEN 'site_' WHEN o_orderkey % 3 = 1 THEN 'Product_' ELSE 'notes_' END
  || {_TREE_Y} || CASE WHEN o_orderkey % 3 = 2 THEN '.txt' ELSE '0105.csv' END AS received,
  CAST(o_orderkey AS STRING) AS line FROM {{orders}}
"""


def _tree(spark: SparkSession, sf_dir: str) -> str:
    return feeds.landed(
        spark, sf_dir, "tree", lambda p: sql(spark, sf_dir, TREE).write.partitionBy("folder", "received").text(p)
    )


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.list_files(spark, _tree(spark, sf_dir))


@query(
    "discover_files",
    duck(
        "SELECT lower(split_part(received, '_', 1)) AS feed, count(DISTINCT received) AS files, "
        f"count(DISTINCT folder) AS folders FROM ({TREE}) t WHERE received LIKE '%.csv' GROUP BY 1"
    ),
)
def discover_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.by_feed(_deliveries(spark, sf_dir))


@query(
    "discover_folders",
    duck(
        "SELECT e.folder, coalesce(f.files, 0) AS files, CASE WHEN f.files > 0 THEN 'SUCCESS' ELSE 'NO_DATA' END AS status "
        "FROM (SELECT DISTINCT 'zone_' || lower(o_orderstatus) AS folder FROM {orders} UNION SELECT 'zone_' || lower(r_name) FROM {region}) e "
        f"LEFT JOIN (SELECT folder, count(DISTINCT received) AS files FROM ({TREE}) t GROUP BY 1) f ON e.folder = f.folder"
    ),
)
def discover_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = sql(
        spark, sf_dir,
        "SELECT DISTINCT 'zone_' || lower(o_orderstatus) AS folder FROM {orders} UNION SELECT 'zone_' || lower(r_name) FROM {region}",
    )
    return listing.by_folder(_deliveries(spark, sf_dir), expected)


@query(
    "files_by_table",
    duck(f"SELECT DISTINCT folder, received AS file_name FROM ({TREE}) t"),
)
def files_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deliveries(spark, sf_dir).select("folder", "file_name").distinct()


# --- archives -----------------------------------------------------------------------------------
_ARCHIVE_SCHEMA = T.StructType(
    [T.StructField("custkey", T.StringType()), T.StructField("name", T.StringType()), T.StructField("nation", T.StringType()),
     T.StructField("balance", T.StringType()), T.StructField("segment", T.StringType())]
)


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers packed by Spark tasks into ZIP archives, one per batch of rows, and per task one
    archive cut off in the middle."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for number, frame in enumerate(batches):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
                for flag, part in frame.groupby(frame["c_custkey"] % 2):
                    z.writestr(f"customer_{flag}.csv", part.to_csv(index=False, lineterminator="\n"))
                z.writestr("__MACOSX/customer_0.csv", "junk\n")
                z.writestr(".hidden", "junk\n")
            whole = buffer.getvalue()
            yield pd.DataFrame(
                {"path": [f"in/customer_{number}.zip", f"in/broken_{number}.zip"], "content": [whole, whole[:40]]}
            )

    return rows.mapInPandas(pack, "path string, content binary")


@query(
    "zip_scan",
    duck(
        "SELECT 'customer' AS feed, 'customer_' || (c_custkey % 2) || '.csv' AS entry, CAST(c_custkey AS STRING) AS custkey, "
        "c_name AS name, CAST(c_nationkey AS STRING) AS nation, CAST(c_acctbal AS STRING) AS balance, c_mktsegment AS segment FROM {customer}"
    ),
)
def zip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = archive.expand(_packed(spark, sf_dir))
    parsed = archive.parse_lines(lines, _ARCHIVE_SCHEMA)
    return parsed.select("feed", "entry", "custkey", "name", "nation", "balance", "segment")


@query(
    "line_numbers",
    duck(f"SELECT received AS file_name, CAST(row_number() OVER (PARTITION BY received) AS BIGINT) AS line_id FROM ({feeds.ORDERS}) f"),
)
def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = delimited.scan(spark, feeds.orders_csv(spark, sf_dir), order_spec())
    return number_lines(rows).select(F.col(FILE).alias("file_name"), "line_id")
