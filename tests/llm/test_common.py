"""Batches of whole texts are bounded by rows and by bytes."""

import pyarrow as pa
from pyspark.sql import functions as F

from feedloom.llm.common import small_batches

KEYS = (
    "spark.sql.execution.arrow.maxRecordsPerBatch",
    "spark.sql.execution.arrow.maxBytesPerBatch",
    "spark.sql.parquet.columnarReaderBatchSize",
    "parquet.block.size",
)


def batches(df):
    def sizes(found):
        for b in found:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]}, schema=pa.schema([("n", pa.int64()), ("size", pa.int64())]))

    return [(r["n"], r["size"]) for r in df.mapInArrow(sizes, "n long, size long").collect()]


def of_length(spark, rows, length):
    return spark.range(0, rows, 1, 1).select("id", F.expr(f"repeat('x', {length})").alias("text"))


def test_batches_of_whole_texts_are_small(spark):
    before = {k: spark.conf.get(k, None) for k in KEYS}
    try:
        for k in KEYS:
            spark.conf.unset(k)
        small_batches(spark)
        assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "512"
        short, long, huge = (batches(of_length(spark, *x)) for x in ((5000, 10), (500, 100_000), (3, 20 << 20)))
        assert sum(n for n, _ in short) == 5000 and max(n for n, _ in short) == 1000
        assert sum(n for n, _ in long) == 500 and max(size for _, size in long) < 9 << 20
        assert [n for n, _ in huge] == [1, 1, 1]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_settings_of_the_session_stay(spark):
    before = {k: spark.conf.get(k, None) for k in KEYS}
    try:
        for k in KEYS:
            spark.conf.set(k, "777")
        small_batches(spark)
        assert {spark.conf.get(k).removesuffix("b") for k in KEYS} == {"777"}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
