"""Text clean-up and safe casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.specs import FieldSpec


def is_blank(text: Column) -> Column:
    return F.trim(text) == ""


def blank_to_null(text: Column) -> Column:
    return F.when(~is_blank(text), text)


def decimal_point(text: Column) -> Column:
    return F.translate(text, ",", ".")


def text_transform(text: Column, field: FieldSpec) -> Column:
    """The field's text transform."""
    if field.transform == "uppercase":
        return F.upper(text)
    if field.transform == "lowercase":
        return F.lower(text)
    if field.transform == "regex" and field.pattern:
        return F.regexp_replace(text, field.pattern, field.replacement)
    return text


def source_text(text: Column, field: FieldSpec) -> Column:
    """What is judged and logged: the transformed text, with a decimal point in numbers."""
    changed = text_transform(text, field)
    return decimal_point(changed) if field.is_numeric else changed


def safe_cast(text: Column, field: FieldSpec) -> Column:
    return blank_to_null(text).try_cast(field.spark_type)


def is_invalid(text: Column, field: FieldSpec) -> Column:
    """There is a text, and the configured type cannot hold it. Never NULL."""
    filled = F.coalesce(~is_blank(text), F.lit(False))
    return filled & text.try_cast(field.spark_type).isNull()
