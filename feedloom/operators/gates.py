"""Gates and row policies, decided per load unit from two small aggregates.

``typed`` is the output of ``typing.type_rows`` with a column naming the unit. The aggregates
combine on the map side, so a unit holding most of the rows is no bottleneck, and only the short
lists of refused units are joined back. No join here carries a broadcast hint: Spark broadcasts a
list when its measured size allows and otherwise joins by shuffle, splitting skewed units.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators import errors as E
from feedloom.operators.typing import DROPPED, FLAGS, ISSUES, field_at, policy_kind
from feedloom.specs import FieldSpec, Tolerance

LINE_SHARE = 0.1  # Fixed value: share of flagged columns a line may have invalid.


def corrupt_counts(rows: DataFrame, by: str, corrupt: str = "_corrupt_record") -> DataFrame:
    """Lines and corrupt lines per unit."""
    return rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"), F.count(corrupt).alias("corrupt_rows")
    )


def too_corrupt(counts: DataFrame, tolerance: Tolerance) -> Column:
    rows = F.col("rows")
    return F.col("corrupt_rows") > tolerance.share_column(rows) * rows


def issue_counts(typed: DataFrame, unit: str) -> DataFrame:
    """Issues per unit, field and kind."""
    return (
        typed.select(unit, F.inline(ISSUES))
        .groupBy(unit, "pos", "kind")
        .agg(F.count(F.lit(1)).alias("issues"))
    )


def ict_columns(counts: DataFrame, rows: DataFrame, fields: Sequence[FieldSpec], unit: str) -> DataFrame:
    """ICT columns with invalid values per unit, and whether each is beyond its tolerance."""
    limit = field_at(fields, F.col("pos"), lambda f: f.tolerance.value)
    relative = field_at(fields, F.col("pos"), lambda f: f.tolerance.relative)
    share = F.when(relative, limit).otherwise(limit / F.col("rows"))
    return (
        counts.where(F.col("kind") == E.ICT_DRIVEN)
        .join(rows.select(unit, "rows"), unit)
        .withColumn("beyond", F.col("issues") / F.col("rows") > share)
    )


def unit_verdicts(ict: DataFrame, unit: str) -> DataFrame:
    """First aborting column of a unit and how many invalid columns one of its lines may have.

    Columns are judged in field order: an abort empties the unit, so later columns see nothing.
    """
    allowed = F.greatest(F.lit(1), F.floor(F.count_distinct("pos") * F.lit(LINE_SHARE)).cast("int"))
    return ict.groupBy(unit).agg(
        F.min(F.when(F.col("beyond"), F.col("pos"))).alias("abort_pos"),
        F.max(F.when(F.col("beyond"), F.struct(-F.col("pos"), F.col("issues"))))
        .getField("issues")
        .alias("abort_issues"),
        allowed.alias("allowed"),
    )


def judge_rows(typed: DataFrame, verdicts: DataFrame, unit: str) -> DataFrame:
    """Adds ``_abort_pos``, ``_line_reject`` and ``_kept`` to every row."""
    joined = typed.join(
        verdicts.select(unit, F.col("abort_pos").alias("_abort_pos"), F.col("allowed").alias("_allowed")),
        unit,
        "left",
    )
    alive = ~F.col(DROPPED) & F.col("_abort_pos").isNull()
    over = F.col(FLAGS) > F.coalesce("_allowed", F.lit(1))
    return joined.withColumns({"_line_reject": alive & over, "_kept": alive & ~over}).drop("_allowed")


def policy_errors(
    judged: DataFrame, counts: DataFrame, verdicts: DataFrame, fields: Sequence[FieldSpec],
    table: str, unit: str, order: Sequence[str], limit: int | None,
) -> DataFrame:
    """Error rows of the typing stage: per-value rows (capped), line rejects, summaries."""
    per_value = (E.EMPTY_DATE, E.INVALID_DATE, E.REJECT, E.ICT_DRIVEN, E.NULL_VALUE)
    troubled = judged.where((F.size(ISSUES) > 0) | F.col("_line_reject"))
    whole_line = F.struct(
        F.lit(-1).alias("pos"), F.lit(E.LINE_REJECT).alias("kind"), F.lit(None).cast("string").alias("raw")
    )
    listed = F.when(F.col("_line_reject"), F.array_append(F.col(ISSUES), whole_line)).otherwise(
        F.col(ISSUES)
    )
    flat = troubled.select(unit, *order, "_abort_pos", "_kept", F.inline(listed))
    logged = flat.where(
        (F.col("kind").isin(*per_value[:-1])
         & (F.col("_abort_pos").isNull() | (F.col("pos") < F.col("_abort_pos"))))
        | ((F.col("kind") == E.NULL_VALUE) & F.col("_kept"))
        | (F.col("kind") == E.LINE_REJECT)
    )
    logged = E.cap(logged, limit, [unit, "pos", "kind"], list(order))
    name = F.when(F.col("pos") < 0, F.lit("MULTIPLE_COLUMNS")).otherwise(
        field_at(fields, F.greatest(F.col("pos"), F.lit(0)), lambda f: f.name)
    )
    kind = F.col("kind")
    message = F.when(kind == E.NULL_VALUE, E.null_message(name)).otherwise(kind)
    values = logged.select(*E.error_row(table, F.col(unit), name, kind, message, F.col("raw")))
    return E.union_errors(
        [values, abort_errors(verdicts, fields, table, unit), summary_errors(counts, verdicts, fields, table, unit)]
    )


def abort_errors(verdicts: DataFrame, fields: Sequence[FieldSpec], table: str, unit: str) -> DataFrame:
    """One row per unit whose share of invalid values is beyond a column's tolerance."""
    aborted = verdicts.where(F.col("abort_pos").isNotNull())
    name = field_at(fields, F.col("abort_pos"), lambda f: f.name)
    return aborted.select(
        *E.error_row(table, F.col(unit), name, E.ABORT, count=F.col("abort_issues"))
    )


def summary_errors(
    counts: DataFrame, verdicts: DataFrame, fields: Sequence[FieldSpec], table: str, unit: str
) -> DataFrame:
    """LOG_ONLY: one row per unit and column with the number of invalid values."""
    if not any(policy_kind(f) == E.LOG_ONLY for f in fields):
        return counts.where(F.lit(False)).select(*E.error_row(table, F.col(unit), "", E.LOG_ONLY))
    name = field_at(fields, F.col("pos"), lambda f: f.name)
    seen = counts.where(F.col("kind") == E.LOG_ONLY).join(
        verdicts.select(unit, "abort_pos"), unit, "left"
    )
    shown = seen.where(F.col("abort_pos").isNull() | (F.col("pos") < F.col("abort_pos")))
    return shown.select(*E.error_row(table, F.col(unit), name, E.LOG_ONLY, count=F.col("issues")))
