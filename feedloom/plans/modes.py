"""Ingestion modes: the next current state as a function of (current state, batch)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame

from feedloom.operators.columns import DATE_PARTS
from feedloom.operators.merge import first_load, key_replace, merge_latest
from feedloom.specs import (
    DELTA_FROM_NON_HISTORIZED,
    FULL_KEY_REPLACE,
    FULL_SNAPSHOT,
    PARTITION_REPLACE,
)

PROCESSED = "FILE_PROCESS_DATE"
REWRITING = (FULL_SNAPSHOT, DELTA_FROM_NON_HISTORIZED, FULL_KEY_REPLACE, PARTITION_REPLACE)


def rewrites(mode: str) -> bool:
    """True when a mode replaces the current table; every other mode, known or not, appends."""
    return (mode or "").strip().upper() in REWRITING


def merges_keys(mode: str) -> bool:
    """True when a mode looks for the keys of a batch in the current table."""
    return (mode or "").strip().upper() in (DELTA_FROM_NON_HISTORIZED, FULL_KEY_REPLACE)


def next_state(
    last: DataFrame | None,
    batch: DataFrame,
    mode: str,
    keys: Sequence[str] = (),
    validity: str | None = None,
    tie: Sequence[Column] = (),
    match: str = "all",
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Current table after a batch. ``batch`` carries the metadata columns."""
    mode = (mode or "").strip().upper()
    if mode in (DELTA_FROM_NON_HISTORIZED, FULL_KEY_REPLACE) and not keys:
        raise ValueError(f"{mode} needs merge keys")
    if mode == FULL_SNAPSHOT:
        return batch.drop(PROCESSED)
    if last is None:
        if mode != DELTA_FROM_NON_HISTORIZED:
            return batch
        # Nothing to merge with, but the batch must not repeat keys.
        return first_load(batch, keys, validity or PROCESSED, tie)
    if mode == DELTA_FROM_NON_HISTORIZED:
        return merge_latest(last, batch, keys, validity or PROCESSED, tie, keep)
    if mode == FULL_KEY_REPLACE:
        return key_replace(last, batch, keys, match)
    if mode == PARTITION_REPLACE:
        return partition_replace(last, batch)
    return last.unionByName(batch, allowMissingColumns=True)


def partition_replace(last: DataFrame, batch: DataFrame) -> DataFrame:
    """Dates present in the batch are replaced, other dates stay."""
    dates = batch.select(*DATE_PARTS).distinct()
    rest = last.join(dates, list(DATE_PARTS), "left_anti").select(*last.columns)
    return rest.unionByName(batch, allowMissingColumns=True)
