"""Small helpers of the operators: ordered blocks, running sums over them, packed vectors."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.session import staged

#: A word of the size and shingle rules: what stands between ASCII white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
FILTER_BITS = 1 << 25  # of the filter of keys that is broadcast: 4 MB


def small_batches(spark: SparkSession) -> None:
    """Settings for rows of whole texts, where the session has none of its own: fewer rows and bytes per Arrow
    and rows per Parquet batch, which are held several times over, and smaller row groups, which a writer holds.

    A text longer than a batch is a batch alone.
    """
    for key, better in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", "1000"),
        ("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20)),
        ("spark.sql.parquet.columnarReaderBatchSize", "512"),
        ("parquet.block.size", str(32 << 20)),
    ):
        if spark.conf.get(key, None) is None:  # not set; Spark's own default is not returned here
            spark.conf.set(key, better)


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidy(run: Run) -> Run:
    """A task's function that gives its memory back to the system when it ends: the worker stays, idle
    beside the next stage, and would keep it."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidied


def give_back() -> None:
    """Memory that Arrow and the C library hold without need goes to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def whole_row(df: DataFrame, name: str = "row") -> Column:
    """All columns as one struct, whatever their names."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias(name)


def ordered_blocks(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """Rows sorted into range partitions and written once, each with the number of its block.

    The written table fixes the borders, so that block totals and rows agree whatever is recomputed.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in order])
    return staged(ranged.withColumn("_block", F.spark_partition_id()), label)


def block_starts(blocks: DataFrame, group: Sequence[str], amount: str) -> DataFrame:
    """One row per group and block: what the earlier blocks of the group amount to (``_start``) and
    what this one holds (``_held``). A block is a whole partition, so the window sees few rows."""
    held = blocks.groupBy(*group, "_block").agg(F.sum(amount).alias("_held"))
    earlier = W.partitionBy(*group).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    return held.withColumn("_start", F.coalesce(F.sum("_held").over(earlier), F.lit(0)))


def within_block(group: Sequence[str], order: Sequence[str]):
    """Window over the earlier rows of a block."""
    return W.partitionBy(*group, "_block").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)


def split_by(df: DataFrame, keys: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose ``columns`` may be among those of ``keys``, and rows where they surely are not.

    A bit stands for every hash of a key. The bits are at most ``FILTER_BITS`` whatever the number of keys, so
    they are broadcast; only rows of the first part need a join with the keys themselves, which may take
    a shuffle. Both parts read ``df``.
    """

    def hashed() -> Column:
        return F.pmod(F.xxhash64(*[F.col(c).cast(keys.schema[c].dataType) for c in columns]), F.lit(FILTER_BITS))

    placed = keys.select(F.bitmap_bucket_number(hashed()).alias("_part"), F.bitmap_bit_position(hashed()).alias("_at"))
    bits = placed.repartition("_part").groupBy("_part").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    at = F.bitmap_bit_position(hashed())
    byte = F.conv(F.hex(bits["_bits"].substr((at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    met = df.join(F.broadcast(bits), F.bitmap_bucket_number(hashed()) == bits["_part"], "left")
    return met.where(found).select(df["*"]), met.where(~found).select(df["*"])


def finite_vector(column: str) -> Column:
    """True where an array holds neither null nor a non-finite component."""
    c = F.col(column)
    good = F.forall(
        c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return F.coalesce(c.isNotNull() & good, F.lit(False))


def unpack(column, width: int, kind=np.float64) -> np.ndarray:
    """Rows of an Arrow or pandas column of lists as a matrix; shorter rows are filled with zeros."""
    rows = [np.asarray(v, dtype=kind) for v in column]
    out = np.zeros((len(rows), width), dtype=kind)
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out
