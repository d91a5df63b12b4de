"""What the two vector searches share: clean rows, repeated vectors, local results, final ranks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import finite_vector
from feedloom.session import staged

DATA, QUERY = 0, 1


def clean(table: DataFrame, vec_id: str, vector: str, number: T.DataType, make, label: str) -> DataFrame:
    """``vec_id, vec``: rows with an id and a finite vector, its components made into numbers by
    ``make``, filled with zeros to the longest vector, and written once.

    Rows that repeat id and vector count once.
    """
    good = table.where(F.col(vec_id).isNotNull() & finite_vector(vector)).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.transform(F.col(vector), make).cast(T.ArrayType(number)).alias("vec")
    )
    plain = staged(good.withColumn("d", F.size("vec")), f"{label}-vectors")
    width = plain.agg(F.max("d"), F.min("d")).first()
    if width[0] != width[1]:
        fill = F.array_repeat(F.lit(0).cast(number), F.lit(width[0]) - F.col("d"))
        plain = plain.withColumn("vec", F.concat("vec", fill))
    return plain.drop("d").withColumns({"h": F.xxhash64("vec"), "g": F.xxhash64(F.lit(1), "vec")})


def width_of(rows: DataFrame) -> int | None:
    """Components of the vectors, None where there are no rows."""
    first = rows.select(F.size("vec").alias("d")).first()
    return first["d"] if first else None


def candidates(rows: DataFrame, k: int) -> DataFrame:
    """The ``k + 1`` smallest ids of every distinct vector. As ties go to the smaller id and only the
    query's own row is left out, no other row of an equal vector can be among ``k`` results. Spark
    limits such ranks before the shuffle, so a very frequent vector is no heavy group."""
    same = W.partitionBy("h", "g").orderBy("vec_id")
    few = rows.withColumn("_r", F.dense_rank().over(same)).where(F.col("_r") <= k + 1)
    once = few.withColumn("_n", F.row_number().over(W.partitionBy("h", "g", "vec_id").orderBy("_r"))).where("_n = 1")
    return once.select("vec_id", "vec")


def asked(rows: DataFrame, every: int) -> DataFrame:
    return rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "h", "g"]).select("vec_id", "vec")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best local results of every query, with their rank. Spark limits ranks before the shuffle."""
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def matrix(values: pd.Series, width: int, kind) -> np.ndarray:
    """Packed rows (``bytes``) of a group as a matrix."""
    return np.frombuffer(b"".join(values), dtype=kind).reshape(len(values), width)
