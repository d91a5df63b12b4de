"""Queries over merges and ingestion modes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import merge
from feedloom.operators.columns import stamp
from feedloom.plans import modes
from feedloom.plans.ingest import ingest
from feedloom.session import fresh_dir
from feedloom.sinks.tables import TableStore
from feedloom import specs
from feedloom.workload import feeds
from feedloom.workload.registry import duck, query, sql, table

_COLUMNS = ("k", "nation", "name", "balance", "segment", "valid_from")


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return sql(spark, sf_dir, feeds.TARGET), sql(spark, sf_dir, feeds.UPDATES)


def _typed_updates(updates: DataFrame) -> DataFrame:
    return merge.comparable(updates, "valid_from").drop("extra")


def _shown(df: DataFrame, *columns: str) -> DataFrame:
    """Compared columns only, times as text."""
    wanted = columns or _COLUMNS
    return df.select(
        *[F.col(c).cast("string").alias(c) if c == "valid_from" else F.col(c) for c in wanted]
    )


_T, _U = feeds.TARGET, feeds.UPDATES
_NEWEST = (
    f"SELECT * FROM (SELECT u.*, row_number() OVER (PARTITION BY k ORDER BY valid_from DESC) AS rn FROM ({_U}) u WHERE k IS NOT NULL) d WHERE rn = 1"
)


@query(
    "merge_latest",
    duck(
        f"""WITH t AS ({_T}), n AS ({_NEWEST})
        SELECT t.k, CASE WHEN newer THEN j.nation ELSE t.nation END AS nation, CASE WHEN newer THEN j.name ELSE t.name END AS name,
          CASE WHEN newer THEN j.balance ELSE t.balance END AS balance, t.segment,
          CASE WHEN newer THEN j.valid_from ELSE CAST(t.valid_from AS STRING) END AS valid_from
        FROM t LEFT JOIN (SELECT n.*, CAST(valid_from AS TIMESTAMP) > TIMESTAMP '2024-01-02 00:00:00' AS newer FROM n) j ON j.k = t.k
        UNION ALL SELECT k, nation, name, balance, NULL, valid_from FROM n WHERE k NOT IN (SELECT k FROM t)
        UNION ALL SELECT k, nation, name, balance, NULL, valid_from FROM ({_U}) u WHERE k IS NULL"""
    ),
)
def merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = _sides(spark, sf_dir)
    return _shown(merge.merge_latest(target, updates, ["k"], "valid_from"))


def _replaced(condition: str) -> str:
    return duck(
        f"""WITH t AS ({_T}), u AS ({_U})
        SELECT k, nation, name, balance, segment, CAST(valid_from AS STRING) AS valid_from FROM t WHERE NOT ({condition})
        UNION ALL SELECT k, nation, name, balance, NULL, valid_from FROM u"""
    )


@query("key_replace_all", _replaced("EXISTS (SELECT 1 FROM u WHERE u.k = t.k AND u.nation = t.nation)"))
def key_replace_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = _sides(spark, sf_dir)
    return _shown(merge.key_replace(target, _typed_updates(updates), ["k", "nation"], "all"))


@query(
    "key_replace_any",
    duck(
        f"""WITH t AS ({_T}), u AS ({_U})
        SELECT k, nation, name, balance, segment, CAST(valid_from AS STRING) AS valid_from FROM t
        WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.k = t.k) AND NOT EXISTS (SELECT 1 FROM u WHERE u.nation = t.nation)
        UNION ALL SELECT k, nation, name, balance, NULL, valid_from FROM u"""
    ),
)
def key_replace_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = _sides(spark, sf_dir)
    return _shown(merge.key_replace(target, _typed_updates(updates), ["k", "nation"], "any"))


# --- modes --------------------------------------------------------------------------------------
_BATCH = f"SELECT k, nation, name, balance, valid_from FROM ({_U}) u"
_LAST = f"SELECT k, nation, name, balance, CAST(valid_from AS STRING) AS valid_from FROM ({_T}) t"
_BOTH = duck(f"{_LAST} UNION ALL {_BATCH}")
_MODE_COLUMNS = ("k", "nation", "name", "balance", "valid_from")


def _mode(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    target, updates = _sides(spark, sf_dir)
    at = F.lit("2025-09-06 10:00:00").cast("timestamp")
    batch = stamp(_typed_updates(updates), F.lit("customer_20250906"), at)
    return _shown(modes.next_state(target.drop("segment"), batch, mode, ["k"], "valid_from"), *_MODE_COLUMNS)


@query("mode_full_snapshot", duck(_BATCH))
def mode_full_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mode(spark, sf_dir, specs.FULL_SNAPSHOT)


@query("mode_delta_flow", _BOTH)
def mode_delta_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mode(spark, sf_dir, specs.DELTA_FROM_FLOW)


@query("mode_delta_historized", _BOTH)
def mode_delta_historized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mode(spark, sf_dir, specs.DELTA_FROM_HISTORIZED)


@query("mode_default", _BOTH)
def mode_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mode(spark, sf_dir, "something else")


DATED = """
SELECT o_orderkey AS k, o_totalprice AS price, CAST(year(o_orderdate) AS INT) AS yyyy,
  CAST(month(o_orderdate) AS INT) AS mm, CAST(day(o_orderdate) AS INT) AS dd FROM {orders}
"""
_FRESH = "SELECT k + 500000000 AS k, price, yyyy, mm, dd FROM ({d}) x WHERE k % 1000 = 1".format(d=DATED)


@query(
    "mode_partition_replace",
    duck(
        f"WITH b AS ({_FRESH}), d AS ({DATED}) SELECT * FROM d WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.yyyy = d.yyyy AND b.mm = d.mm AND b.dd = d.dd) UNION ALL SELECT * FROM b"
    ),
)
def mode_partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    last, batch = sql(spark, sf_dir, DATED), sql(spark, sf_dir, _FRESH)
    return modes.next_state(last, batch, specs.PARTITION_REPLACE)


@query(
    "ingest_all_history",
    duck(
        "SELECT 'all' AS side, c.*, 'customer_' || b AS FILE_NAME_RECEIVED FROM {customer} c, (SELECT 1 AS b UNION ALL SELECT 2) x WHERE c_custkey % 2 = 0 OR b = 2 "
        "UNION ALL SELECT 'last', c.*, 'customer_2' FROM {customer} c"
    ),
)
def ingest_all_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots through the tables: the history keeps both, the current table the second. The
    second load is sent twice, as after a retry."""
    store = TableStore(spark, fresh_dir(spark, "tables"))
    customers = table(spark, sf_dir, "customer")
    for load, rows in ((1, customers.where("c_custkey % 2 = 0")), (2, customers), (2, customers)):
        load_id = f"load-{load}"
        if store.is_loaded("customer", load_id):
            continue
        batch = stamp(rows, F.lit(f"customer_{load}"), F.current_timestamp(), {
            "yyyy": F.lit(2025), "mm": F.lit(9), "dd": F.lit(load),
        })
        store.add_history("customer", batch, load_id)
        state = modes.next_state(store.current("customer"), batch, specs.FULL_SNAPSHOT)
        store.replace_current("customer", state, load_id)
    sides = [
        df.select(F.lit(side).alias("side"), *customers.columns, "FILE_NAME_RECEIVED")
        for side, df in (("all", store.history("customer")), ("last", store.current("customer")))
    ]
    return sides[0].unionByName(sides[1])


_EVEN, _ODD = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), ("c_mktsegment", "c_acctbal", "c_custkey")
_CUSTOMER = (
    specs.FieldSpec("c_custkey", "LONG", nullable=False), specs.FieldSpec("c_name"), specs.FieldSpec("c_nationkey", "INT"),
    specs.FieldSpec("c_acctbal", "DOUBLE"), specs.FieldSpec("c_mktsegment"),
)


@query(
    "merge_files",
    duck(
        "SELECT c_custkey, c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment FROM {customer} WHERE c_custkey % 2 = 0 "
        "UNION ALL SELECT c_custkey, NULL, NULL, c_acctbal, c_mktsegment FROM {customer} WHERE c_custkey % 2 = 1"
    ),
)
def merge_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries with other columns in another order, loaded as one."""
    root, rows = fresh_dir(spark, "merge-files"), table(spark, sf_dir, "customer")
    for part, (day, columns) in enumerate((("20250901", _EVEN), ("20250902", _ODD))):
        own = rows.where(F.col("c_custkey") % 2 == part).select(*columns)
        own.write.option("header", True).csv(f"{root}/in/customer_{day}.csv")
    spec = specs.FeedSpec(
        "customer", _CUSTOMER, "customer_<yyyy><mm><dd>.csv", mode=specs.FULL_SNAPSHOT, file_policy=specs.MERGE,
        header=specs.NAMES, imposed=False, delete_columns_allowed=True,
    )
    store = TableStore(spark, f"{root}/tables")
    ingest(spark, f"{root}/in", spec, store, f"{root}/logs", load_id="first")
    return store.current("customer").select(*spec.columns)
