import re

import pytest
from pyspark.sql import functions as F

from feedloom.functions import filenames as names
from feedloom.sources import listing
from feedloom.sources.listing import rejected_date, rejection, run_log_reason


def test_name_regex():
    rx = re.compile(names.name_regex("site_<yyyy><mm><dd>_<hhmmss>.csv"))
    assert rx.match("site_20250902_120001.csv") and rx.match("site_20250902.csv")
    assert not rx.match("site_20250902_120001xcsv") and not rx.match("xsite_20250902.csv")
    wild = re.compile(names.name_regex("site_<yyyy><mm><dd>_*.csv"))
    assert wild.match("site_20250902_120001.csv")


@pytest.mark.parametrize(
    "name,feed",
    [("site_20250902_120001.csv", "site"), ("customer_20250902.csv", "customer"), ("product.csv", "product"),
     ("SITE_20250902.CSV", "site"), ("2025_08.csv", "2025"), ("20_orders7.CSV", "orders7"), ("a.b.csv", "a.b")],
)
def test_feed_of(spark, name, feed):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(names.feed_of(F.col("n"))).first()[0] == feed


def test_received_name(spark):
    paths = {
        "file:/in/site_1.csv": ("site_1.csv", "in"),
        "file:/in/zone/received=site_1.csv/part-00000-x.csv": ("site_1.csv", "zone"),
        "file:/in/folder=z/site%201+.csv": ("site 1+.csv", "z"),
        "s3://b/site_1.csv/part-7.csv": ("site_1.csv", "b"),
    }
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = {r[0]: (r[1], r[2]) for r in df.select("p", names.received_name(F.col("p")), names.folder_name(F.col("p"))).collect()}
    assert got == paths


@pytest.mark.parametrize(
    "name,reason,shown,short",
    [
        ("site_20250902_120001.csv", None, "2025-09-02", None),
        ("site_20251302_120001.csv", "Invalid date: Month 13 invalid", "2025-13-02", "Invalid date: Month 13 invalid"),
        ("site_20250931.csv", "Invalid date: day is out of range for month", "2025-09-31", "Validation failed: Invalid filename"),
        ("site_20250940.csv", "Invalid date: Day 40 invalid", "2025-09-40", "Invalid date: Day 40 invalid"),
        ("site_18990101.csv", "Invalid date: Year 1899 out of range", "1899-01-01", "Validation failed: Invalid filename"),
        ("site_20250001.csv", "Invalid date: Missing year or month", "N/A", "Invalid date: Month 0 invalid"),
        ("product.csv", "Missing date pattern", None, "Invalid filename format"),
        ("site_2024-02-29.csv", None, "2024-02-29", None),
    ],
)
def test_rejection(spark, name, reason, shown, short):
    df = spark.createDataFrame([(name,)], "n string")
    n = F.col("n")
    got = df.select(rejection(n), rejected_date(n), run_log_reason(n)).first()
    assert got[0] == reason and got[1] == shown
    if reason is not None:
        assert got[2] == short


def test_stream_parts_and_filter(spark):
    df = spark.createDataFrame([("site_20250902_120001.csv",), ("site.csv",), ("sitex_20250902.csv",)], "n string")
    parts = names.stream_name_parts(F.col("n"))
    got = df.select(*parts.values(), names.belongs_to(F.col("n"), "site")).collect()
    assert [tuple(r) for r in got] == [(2025, 9, 2, True), (None, None, None, True), (2025, 9, 2, False)]


def test_config_match_exact_beats_earlier_partial(spark, rows):
    seen = spark.createDataFrame([("site",), ("site_b",), ("cust",), ("zz",)], "name string")
    config = spark.createDataFrame([("site_old", 0), ("SITE", 1), ("customer", 2)], "table_name string, position int")
    got = rows(listing.match_config(seen, config, "prefix"))
    assert got == sorted([("site", "SITE", "exact"), ("site_b", "SITE", "partial"), ("cust", "customer", "partial"), ("zz", None, "default")], key=repr)
    inner = spark.createDataFrame([("my_site_x",)], "name string")
    assert rows(listing.match_config(inner, config, "substring")) == [("my_site_x", "SITE", "partial")]
    assert rows(listing.match_config(inner, config, "prefix")) == [("my_site_x", None, "default")]
