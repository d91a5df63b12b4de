"""Keyed merges as pure functions of (current state, batch)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comparable(df: DataFrame, column: str) -> DataFrame:
    """The compare column as a timestamp when it arrives as text."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn(column, F.try_to_timestamp(F.col(column)))
    return df


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Filtering rank 1 lets Spark limit every key on the map side, so a key repeated in a third of the
    batch reaches the shuffle once per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def first_load(
    batch: DataFrame, keys: Sequence[str], compare: str, tie: Sequence[Column] = ()
) -> DataFrame:
    """State of an empty table after a merge: newest row per key, and all rows with a NULL in it."""
    typed = comparable(batch, compare)
    order = [F.col(compare).desc_nulls_last(), *tie]
    newest = newest_per_key(typed.where(all_set(keys)), keys, order)
    return newest.unionByName(typed.where(~all_set(keys)))


def merge_latest(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    compare: str,
    tie: Sequence[Column] = (),
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Newest-wins upsert.

    A matched target row is replaced when the update's compare value is greater; a key unknown to
    the target is inserted; everything else stays. Columns only the target has keep their value on
    update and are NULL on insert; columns only the batch has are ignored. NULL keys never match.

    The target is decided row by row against at most one update, so it may repeat keys. It is
    scanned in full once and a second time for its key columns only; with a batch Spark can
    broadcast, the target is not shuffled at all. The batch reduced to one row per key is used three
    times: ``keep`` may write it once.
    """
    shared = [c for c in target.columns if c in updates.columns]
    if compare not in shared:
        raise ValueError(f"compare column {compare!r} is missing on one side of the merge")
    typed = comparable(updates, compare)
    order = [F.col(compare).desc_nulls_last(), *tie]
    newest = keep(newest_per_key(typed.where(all_set(keys)), keys, order).select(*shared))
    keyless = typed.where(~all_set(keys)).select(*shared)
    known = comparable(target, compare)

    new = newest.select(*[F.col(c).alias(_u(c)) for c in shared])
    newer = F.coalesce(F.col(_u(compare)) > F.col(compare), F.lit(False))
    state = known.join(new, _equal(keys), "left").select(
        *[
            F.when(newer, F.col(_u(c))).otherwise(F.col(c)).alias(c) if c in shared else F.col(c)
            for c in target.columns
        ]
    )
    known_keys = target.select(*keys).join(newest.select(*keys), list(keys), "left_semi").distinct()
    inserts = newest.join(known_keys, list(keys), "left_anti").unionByName(keyless)
    return state.unionByName(inserts, allowMissingColumns=True).select(*target.columns)


def key_replace(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], match: str = "all"
) -> DataFrame:
    """Delete target rows whose key occurs in the batch, then append the batch.

    ``match="all"`` compares the composite key; ``"any"`` deletes a row when any single key column
    occurs in the batch. NULL keys match nothing.
    """
    if match == "all":
        rest = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    else:
        rest = target
        for k in keys:
            rest = rest.join(batch.select(k).distinct(), k, "left_anti")
    return rest.select(*target.columns).unionByName(batch, allowMissingColumns=True)


def _u(column: str) -> str:
    return f"_new_{column}"


def all_set(keys: Sequence[str]) -> Column:
    condition = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        condition = condition & F.col(k).isNotNull()
    return condition


def _equal(keys: Sequence[str]) -> Column:
    condition = F.col(keys[0]) == F.col(_u(keys[0]))
    for k in keys[1:]:
        condition = condition & (F.col(k) == F.col(_u(k)))
    return condition
