"""Parsing dates over an ordered list of patterns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_RUN = re.compile(r"'([^']*)'|([A-Za-z])\2*|.", re.DOTALL)


def pattern_shape(pattern: str) -> str | None:
    """Regex every text accepted by a datetime pattern must match, or None when not derivable.

    A failed parse costs an exception inside the JVM. Testing the shape first keeps the patterns
    that cannot match from being tried at all.
    """
    out = []
    for piece in _RUN.finditer(pattern):
        text, letter = piece.group(0), piece.group(2)
        if text.startswith("'"):
            out.append(re.escape(piece.group(1)) if piece.group(1) else "'")
        elif letter is None:
            out.append(re.escape(text))
        elif letter == "y" and len(text) == 4:
            out.append(r"\+?\d{4,}")
        elif letter in "MdHms" and len(text) == 2:
            out.append(r"\d{2}")
        else:
            return None
    return "^" + "".join(out) + "$"


def try_pattern(text: Column, pattern: str) -> Column:
    parsed = F.try_to_timestamp(text, F.lit(pattern))
    shape = pattern_shape(pattern)
    return parsed if shape is None else F.when(text.rlike(shape), parsed)


def parse_first(text: Column, patterns: Sequence[str]) -> Column:
    """Timestamp by the first pattern that fits, else NULL."""
    return F.coalesce(*[try_pattern(text, p) for p in patterns])


def as_temporal(parsed: Column, type_name: str, default: str | None = None) -> Column:
    """Parsed timestamp as DATE or TIMESTAMP, with a default where nothing was parsed."""
    target = "date" if type_name == "DATE" else "timestamp"
    value = parsed.cast(target)
    return value if default is None else F.coalesce(value, F.lit(default).try_cast(target))
