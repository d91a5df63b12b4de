"""Typing of all columns in one pass over the rows.

Every row comes out with its typed values and ``_issues``: an array with one entry per problem
(position of the field, kind, text). Gates, row policies and logs are aggregates and filters over
that array, so the number of jobs does not depend on the number of columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.casting import blank_to_null, is_blank, is_invalid, source_text
from feedloom.functions.dates import as_temporal, parse_first
from feedloom.operators import errors as E
from feedloom.specs import ICT_DRIVEN, LOG_ONLY, REJECT, FieldSpec

ISSUES, DROPPED, FLAGS = "_issues", "_dropped", "_flags"
ISSUE_TYPE = "array<struct<pos:int,kind:string,raw:string>>"


def policy_kind(field: FieldSpec) -> str:
    """Kind of issue an untypable value of this field is."""
    if field.nullable:
        return E.NULLED
    return {REJECT: E.REJECT, ICT_DRIVEN: E.ICT_DRIVEN, LOG_ONLY: E.LOG_ONLY}.get(
        field.on_error, E.NULLED
    )


def type_rows(df: DataFrame, fields: Sequence[FieldSpec]) -> DataFrame:
    """Typed columns plus ``_issues``, ``_dropped`` (REJECT) and ``_flags`` (bad ICT columns)."""
    present = [f for f in fields if f.name in df.columns]
    names = {f.name for f in present}
    others = [c for c in df.columns if c not in names]
    every = list(enumerate(present))

    # Source texts, filled texts, values, judgements: one projection each, so that every step is
    # written once per column and referenced by name afterwards.
    texts = df.select(*others, *[source_text(F.col(f"`{f.name}`"), f).alias(_t(i)) for i, f in every])
    filled = texts.select(
        *others,
        *[(F.col(_t(i)) if f.is_temporal else blank_to_null(F.col(_t(i)))).alias(_t(i)) for i, f in every],
    )
    typed = filled.select(
        *others,
        *[F.col(_t(i)) for i, f in every if f.type_name != "STRING"],
        *[_value(F.col(_t(i)), f).alias(_v(i)) for i, f in every],
    )

    # A text is there and gave no value. An empty date is a text too.
    bad = {
        i: F.col(_t(i)).isNotNull() & F.col(_v(i)).isNull() for i, f in every if f.type_name != "STRING"
    }
    alive, before = None, {}
    for i, f in every:
        before[i] = alive
        if i in bad and policy_kind(f) == E.REJECT and not f.is_temporal:
            alive = ~bad[i] if alive is None else alive & ~bad[i]

    entries: list[tuple[Column, Column]] = []
    flagged: list[Column] = []
    for i, f in every:
        if i in bad:
            text = F.col(_t(i))
            if f.is_temporal:
                kind = F.when(is_blank(text), F.lit(E.EMPTY_DATE)).otherwise(F.lit(E.INVALID_DATE))
            else:
                kind = F.lit(policy_kind(f))
            seen = bad[i] if before[i] is None else before[i] & bad[i]
            entries.append((seen, _issue(i, kind, text)))
            if not f.is_temporal and policy_kind(f) == E.ICT_DRIVEN:
                flagged.append(seen)
        if not f.nullable:
            entries.append((_final(i, f).isNull(), _issue(i, F.lit(E.NULL_VALUE), F.lit(None).cast("string"))))

    return typed.select(
        *others,
        *[_final(i, f).alias(f.name) for i, f in every],
        _collect(entries).alias(ISSUES),
        (F.lit(False) if alive is None else ~alive).alias(DROPPED),
        _sum(flagged).alias(FLAGS),
    )


def _t(i: int) -> str:
    return f"_t{i}"


def _v(i: int) -> str:
    return f"_v{i}"


def _value(text: Column, f: FieldSpec) -> Column:
    if f.is_temporal:
        return as_temporal(parse_first(text, f.date_patterns), f.type_name)
    return text if f.type_name == "STRING" else text.try_cast(f.spark_type)


def _final(i: int, f: FieldSpec) -> Column:
    value = F.col(_v(i))
    if f.is_temporal and f.default is not None:
        return F.coalesce(value, F.lit(f.default).try_cast(f.spark_type))
    return value


def _issue(i: int, kind: Column, raw: Column) -> Column:
    return F.struct(F.lit(i).alias("pos"), kind.alias("kind"), raw.alias("raw"))


def _collect(entries: list[tuple[Column, Column]]) -> Column:
    """Array of the entries whose condition holds; clean rows skip building it."""
    empty = F.array().cast(ISSUE_TYPE)
    if not entries:
        return empty
    anything = entries[0][0]
    for condition, _ in entries[1:]:
        anything = anything | condition
    parts = [F.when(c, F.array(e)).otherwise(empty) for c, e in entries]
    return F.when(anything, F.concat(*parts)).otherwise(empty)


def _sum(conditions: list[Column]) -> Column:
    total = F.lit(0)
    for c in conditions:
        total = total + c.cast("int")
    return total


def parse_dates(
    df: DataFrame, column: str, patterns: Sequence[str], type_name: str = "DATE", default: str | None = None
) -> DataFrame:
    """One column parsed over ordered patterns; ``date_issue`` tells EMPTY_DATE or INVALID_DATE."""
    text = F.col(column)
    parsed = parse_first(text, patterns)
    issue = F.when(
        text.isNotNull() & parsed.isNull(),
        F.when(is_blank(text), F.lit(E.EMPTY_DATE)).otherwise(F.lit(E.INVALID_DATE)),
    )
    return df.withColumns(
        {"date_issue": issue, f"{column}_parsed": as_temporal(parsed, type_name, default)}
    )


def invalid_counts(df: DataFrame, fields: Sequence[FieldSpec], by: list[str]) -> DataFrame:
    """Untypable values per group and column, all columns in one aggregate."""
    counted = [f for f in fields if not f.is_temporal]
    wide = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count_if(is_invalid(source_text(F.col(f.name), f), f)).alias(f"_n{i}")
            for i, f in enumerate(counted)
        ],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(f.name).alias("column_name"), F.col(f"_n{i}").alias("invalid"))
            for i, f in enumerate(counted)
        ]
    )
    return wide.select(*by, "rows", F.inline(pairs))


def final_check(df: DataFrame, fields: Sequence[FieldSpec]) -> DataFrame:
    """Cast to the final types in one projection; rows stay, problems go to ``_issues``.

    Works on untyped frames as well: a text the type cannot hold is a mismatch, and a value missing
    after the cast in a NOT NULL column is a null value. Other columns lead.
    """
    business = [f for f in fields if f.name in df.columns]
    names = {f.name for f in business}
    others = [c for c in df.columns if c not in names]
    cast = df.select(
        *others,
        *[F.col(f.name).alias(_t(i)) for i, f in enumerate(business)],
        *[F.col(f.name).try_cast(f.spark_type).alias(_v(i)) for i, f in enumerate(business)],
    )
    entries = []
    for i, f in enumerate(business):
        text, value = F.col(_t(i)), F.col(_v(i))
        raw = text.cast("string")
        entries.append((text.isNotNull() & value.isNull(), _issue(i, F.lit(E.TYPE_MISMATCH), raw)))
        if not f.nullable:
            entries.append(
                (value.isNull(), _issue(i, F.lit(E.NULL_VALUE), F.lit(None).cast("string")))
            )
    return cast.select(
        *others,
        *[F.col(_v(i)).alias(f.name) for i, f in enumerate(business)],
        _collect(entries).alias(ISSUES),
    )


def field_at(fields: Sequence[FieldSpec], pos: Column, what) -> Column:
    """A property of the field at a position, looked up in a literal array (positions from 0)."""
    return F.element_at(F.array(*[F.lit(what(f)) for f in fields]), pos + 1)


def issue_rows(
    df: DataFrame, fields: Sequence[FieldSpec], table: str, filename: Column, keep: Sequence[str] = ()
) -> DataFrame:
    """Exploded issues in the error layout (plus ``pos`` and the ``keep`` columns)."""
    flat = df.select(*keep, filename.alias("_filename"), F.inline(ISSUES))
    name = field_at(fields, F.col("pos"), lambda f: f.name)
    expected = field_at(fields, F.col("pos"), lambda f: f.type_name)
    message = (
        F.when(F.col("kind") == E.NULL_VALUE, E.null_message(name))
        .when(
            F.col("kind") == E.TYPE_MISMATCH,
            F.concat(F.lit("TYPE MISMATCH: Expected "), expected, F.lit(", found: '"),
                     F.col("raw"), F.lit("'")),
        )
        .otherwise(F.col("kind"))
    )
    return flat.select(
        *keep,
        "pos",
        *E.error_row(table, F.col("_filename"), name, F.col("kind"), message, F.col("raw")),
    )
