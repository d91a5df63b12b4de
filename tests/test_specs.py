import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import specs
from feedloom.specs import FeedSpec, FieldSpec, Tolerance, load_specs


@pytest.mark.parametrize("word,expected", [("oui", True), ("Y", True), ("1", True), ("non", False), ("0", False), ("?", None), (None, None)])
def test_flag(word, expected):
    for default in (True, False):
        assert specs.flag(word, default) is (default if expected is None else expected)


def test_delimiter():
    assert [specs.delimiter(x) for x in (None, "", " ", ";", "\\t", "\t", "||")] == [",", ",", ",", ";", "\t", "\t", "||"]


def test_header_mode_spelling_depends_on_reader():
    assert specs.header_mode("HEADER USE") == specs.SKIP_POSITIONAL
    assert specs.header_mode("FIRST LINE") == specs.NAMES
    assert specs.header_mode(None) == specs.POSITIONAL
    assert specs.header_mode("HEADER_USE", "stream") == specs.NAMES
    assert specs.header_mode("FIRST_LINE", "stream") == specs.POSITIONAL


@pytest.mark.parametrize(
    "raw,rows,share",
    [("10%", 7, 0.1), ("2,5 %", 7, 0.025), ("5", 50, 0.1), ("5", 0, 0.0), ("", 5, 0.0), (None, 5, 0.0), ("n/a", 5, 0.0), ("ten", 5, 0.0), ("-1", 5, 0.0)],
)
def test_tolerance(spark, raw, rows, share):
    assert Tolerance.parse(raw).share(rows) == pytest.approx(share)
    df = spark.createDataFrame([(raw, rows)], "raw string, rows long")
    assert df.select(specs.tolerance_share(F.col("raw"), F.col("rows"))).first()[0] == pytest.approx(share)
    assert df.select(Tolerance.parse(raw).share_column(F.col("rows"))).first()[0] == pytest.approx(share)


def test_field_types_and_fallback():
    assert FieldSpec("a", "DECIMAL", 12, 3).spark_type == T.DecimalType(12, 3)
    assert FieldSpec("a", "GEOMETRY").spark_type == T.StringType()
    assert FieldSpec("a", "DATE", pattern="yy.MM").date_patterns[0] == "yy.MM"


def test_unsupported_format():
    with pytest.raises(ValueError):
        FeedSpec("t", input_format="xlsx")


def test_load_specs_orders_fields(spark):
    feeds = spark.createDataFrame(
        [("site", "site_<yyyy><mm><dd>.csv", "full_snapshot", "yes", "FIRST LINE", "secret")],
        "`Delta Table Name` string, `Filename Pattern` string, `Ingestion mode` string, `Merge concomitant file` string, `Input header` string, `Output Zone` string",
    )
    fields = spark.createDataFrame(
        [("site", "b", 2, "INT", "isMergeKey", "false", None), ("site", "a", 1, "DATE", "isStartValidity", None, "nan")],
        "`Delta Table Name` string, `Column Name` string, `Field Order` int, `Field type` string, `Is Special` string, `Is Nullable` string, `Error action` string",
    )
    spec = load_specs(feeds, fields)["site"]
    assert spec.columns == ["a", "b"] and spec.merge_keys == ["b"] and spec.validity_column == "a"
    assert spec.mode == specs.FULL_SNAPSHOT and spec.file_policy == specs.MERGE and spec.header == specs.NAMES
    assert spec.masked and spec.imposed and spec.fields[1].on_error == specs.ICT_DRIVEN
    # A missing tolerance column means ten percent, an empty cell none at all.
    assert spec.tolerance.share(10) == pytest.approx(0.1)
    assert FeedSpec.from_rows({"Delta Table Name": "t", "Rejected line per file tolerance": ""}, []).tolerance.share(10) == 0
    assert [f.nullable for f in spec.typed_schema()] == [True, False]
