"""Feed and field specifications.

A feed is described by one row of a feed table and one row per column of a field table. Both are
control metadata (a row per feed, a row per column), so they become small driver-side objects; all
data work downstream is expressed with Spark columns built from them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words read as booleans in the control tables.
TRUE_WORDS = ("true", "1", "yes", "y", "oui")
FALSE_WORDS = ("false", "0", "no", "n", "non")
# Cell texts that mean "not set".
BLANK_WORDS = ("", "nan", "none", "null", "n/a")

# Type names of the field table and the Spark types they stand for.
SIMPLE_TYPES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "INTEGER": T.IntegerType(),
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}
NUMERIC_TYPES = ("INTEGER", "INT", "LONG", "FLOAT", "DOUBLE", "DECIMAL")

# Datetime patterns tried after the column's own one, in order. ISO dates come last.
DATE_PATTERNS = (
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyyMMddHHmmss",
    "yyyyMMdd",
    "yyyy-MM-dd",
)

# Ingestion modes.
FULL_SNAPSHOT = "FULL_SNAPSHOT"
DELTA_FROM_FLOW = "DELTA_FROM_FLOW"
DELTA_FROM_NON_HISTORIZED = "DELTA_FROM_NON_HISTORIZED"
DELTA_FROM_HISTORIZED = "DELTA_FROM_HISTORIZED"
FULL_KEY_REPLACE = "FULL_KEY_REPLACE"
PARTITION_REPLACE = "PARTITION_REPLACE"

# Error actions of a column.
ICT_DRIVEN, REJECT, LOG_ONLY = "ICT_DRIVEN", "REJECT", "LOG_ONLY"

# Input formats.
CSV_FORMATS = ("csv", "csv_quote", "csv_quote_ml", "csv_deprecated")
FORMATS = CSV_FORMATS + ("fixed",)

# How the first line of a delimited file is used.
NAMES, SKIP_POSITIONAL, POSITIONAL = "NAMES", "SKIP_POSITIONAL", "POSITIONAL"

# Which of the matching files of a feed are loaded.
FIRST, MERGE, EACH = "first", "merge", "each"

DEFAULT_TOLERANCE = "10%"
_MISSING = object()


def is_blank(value: Any) -> bool:
    return value is None or str(value).strip().lower() in BLANK_WORDS


def text_or(value: Any, default: str = "") -> str:
    return default if is_blank(value) else str(value).strip()


def flag(value: Any, default: bool) -> bool:
    word = "" if value is None else str(value).strip().lower()
    if word in TRUE_WORDS:
        return True
    return False if word in FALSE_WORDS else default


def delimiter(value: Any) -> str:
    """Column separator; a tab may be given as itself or as the two characters ``\\t``."""
    if value is None or str(value) == "":
        return ","
    raw = str(value)
    if raw in ("\t", "\\t"):
        return "\t"
    return raw.strip() or ","


def header_mode(value: Any, reader: str = "batch") -> str:
    """The two readers spell the modes differently, so the reader is part of the question."""
    word = text_or(value).upper()
    if reader == "batch":
        return {"HEADER USE": SKIP_POSITIONAL, "FIRST LINE": NAMES}.get(word, POSITIONAL)
    return {"FIRST_LINE": POSITIONAL}.get(word, NAMES)


@dataclass(frozen=True)
class Tolerance:
    """Share of bad lines a file may carry: a percentage, or a number of lines."""

    value: float
    relative: bool

    _NUMBER = re.compile(r"\d+(\.\d+)?")

    @classmethod
    def parse(cls, raw: Any, default: float = 0.0) -> "Tolerance":
        if is_blank(raw):
            return cls(default, True)
        text = str(raw)
        number = re.sub(r"[%\s]", "", text).replace(",", ".")
        if not cls._NUMBER.fullmatch(number):
            return cls(default, True)
        return cls(float(number) / 100.0, True) if "%" in text else cls(float(number), False)

    def share(self, rows: int) -> float:
        if self.relative:
            return self.value
        return self.value / rows if rows > 0 else 0.0

    def share_column(self, rows: Column) -> Column:
        if self.relative:
            return F.lit(self.value)
        return F.when(rows > 0, F.lit(self.value) / rows).otherwise(F.lit(0.0))


def tolerance_share(raw: Column, rows: Column, default: float = 0.0) -> Column:
    """Column form of :class:`Tolerance`, for tolerances that arrive as data."""
    number = F.regexp_replace(F.regexp_replace(raw, r"[%\s]", ""), ",", ".")
    usable = ~F.lower(F.trim(raw)).isin(*BLANK_WORDS) & number.rlike(r"^\d+(\.\d+)?$")
    value = number.try_cast("double")
    return (
        F.when(raw.isNull() | ~usable, F.lit(default))
        .when(raw.contains("%"), value / 100.0)
        .when(rows > 0, value / rows)
        .otherwise(F.lit(0.0))
    )


@dataclass(frozen=True)
class FieldSpec:
    name: str
    type_name: str = "STRING"
    precision: int = 38
    scale: int = 18
    size: int = 1
    transform: str = ""
    pattern: str = ""
    replacement: str = ""
    nullable: bool = True
    on_error: str = ICT_DRIVEN
    default: str | None = None
    tolerance: Tolerance = Tolerance(0.1, True)
    role: str = ""

    @property
    def spark_type(self) -> T.DataType:
        if self.type_name == "DECIMAL":
            return T.DecimalType(self.precision, self.scale)
        return SIMPLE_TYPES.get(self.type_name, T.StringType())

    @property
    def is_temporal(self) -> bool:
        return self.type_name in ("DATE", "TIMESTAMP")

    @property
    def is_numeric(self) -> bool:
        return self.type_name in NUMERIC_TYPES

    @property
    def date_patterns(self) -> tuple[str, ...]:
        own = (self.pattern,) if self.pattern and self.transform != "regex" else ()
        return own + tuple(p for p in DATE_PATTERNS if p not in own)

    @classmethod
    def from_row(cls, row: dict[str, Any]) -> "FieldSpec":
        raw_tolerance = row.get("Rejected line per file tolerance", DEFAULT_TOLERANCE)
        return cls(
            name=str(row["Column Name"]).strip(),
            type_name=text_or(row.get("Field type"), "STRING").upper(),
            precision=_whole(row.get("Decimal precision"), 38),
            scale=_whole(row.get("Decimal scale"), 18),
            size=_whole(row.get("Column Size"), 1),
            transform=text_or(row.get("Transformation Type")).lower(),
            pattern=text_or(row.get("Transformation pattern")),
            replacement=text_or(row.get("Regex replacement")),
            nullable=flag(row.get("Is Nullable"), True),
            on_error=text_or(row.get("Error action"), ICT_DRIVEN).upper(),
            default=text_or(row.get("Default when invalid")) or None,
            tolerance=Tolerance.parse(raw_tolerance),
            role=text_or(row.get("Is Special")).lower(),
        )


@dataclass(frozen=True)
class FeedSpec:
    table: str
    fields: tuple[FieldSpec, ...] = ()
    filename_pattern: str = ""
    input_format: str = "csv"
    zone: str = "internal"
    mode: str = ""
    trim: bool = True
    delimiter: str = ","
    delete_columns_allowed: bool = False
    ignore_empty: bool = True
    file_policy: str = EACH
    charset: str = "UTF-8"
    keep_rejects: bool = False
    header: str = POSITIONAL
    imposed: bool = True
    tolerance: Tolerance = Tolerance(0.1, True)
    max_logged_errors: int | None = None

    def __post_init__(self) -> None:
        if self.input_format not in FORMATS:
            raise ValueError(f"unsupported input format {self.input_format!r}")

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def merge_keys(self) -> list[str]:
        return [f.name for f in self.fields if f.role == "ismergekey"]

    @property
    def validity_column(self) -> str | None:
        return next((f.name for f in self.fields if f.role == "isstartvalidity"), None)

    @property
    def masked(self) -> bool:
        return self.zone == "secret"

    def with_(self, **changes: Any) -> "FeedSpec":
        return replace(self, **changes)

    def string_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type, f.nullable) for f in self.fields])

    @classmethod
    def from_rows(
        cls, row: dict[str, Any], field_rows: list[dict[str, Any]], reader: str = "batch"
    ) -> "FeedSpec":
        ordered = field_rows
        has_order = bool(field_rows) and "Field Order" in field_rows[0]
        if has_order:
            ordered = sorted(field_rows, key=lambda r: _whole(r.get("Field Order"), 1 << 30))
        merged = flag(row.get("Merge concomitant file"), False)
        raw_tolerance = row.get("Rejected line per file tolerance", _MISSING)
        return cls(
            table=str(row["Delta Table Name"]).strip(),
            fields=tuple(FieldSpec.from_row(r) for r in ordered),
            filename_pattern=text_or(row.get("Filename Pattern")),
            input_format=text_or(row.get("Input Format"), "csv").lower(),
            zone=text_or(row.get("Output Zone"), "internal").lower(),
            mode=text_or(row.get("Ingestion mode")).upper(),
            trim=flag(row.get("Trim"), True),
            delimiter=delimiter(row.get("Input delimiter")),
            delete_columns_allowed=flag(row.get("Delete Columns Allowed"), False),
            ignore_empty=flag(row.get("Ignore empty Files"), True),
            file_policy=MERGE if merged else EACH,
            charset=text_or(row.get("Input charset"), "UTF-8"),
            keep_rejects=flag(row.get("Invalid Lines Generate"), False),
            header=header_mode(row.get("Input header"), reader),
            imposed=has_order,
            tolerance=Tolerance.parse(
                DEFAULT_TOLERANCE if raw_tolerance is _MISSING else raw_tolerance
            ),
        )


def load_specs(feeds: DataFrame, fields: DataFrame, reader: str = "batch") -> dict[str, FeedSpec]:
    """Specs by table name from the two control tables (one row per feed, one per column)."""
    by_table: dict[str, list[dict[str, Any]]] = {}
    for r in fields.collect():
        by_table.setdefault(r["Delta Table Name"], []).append(r.asDict())
    return {
        r["Delta Table Name"]: FeedSpec.from_rows(
            r.asDict(), by_table.get(r["Delta Table Name"], []), reader
        )
        for r in feeds.collect()
    }


def _whole(value: Any, default: int) -> int:
    return default if is_blank(value) or float(value) != float(value) else int(float(value))
