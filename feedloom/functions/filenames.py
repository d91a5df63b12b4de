"""Columns over file names and paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholders of a file-name pattern and the digits they stand for.
NAME_TOKENS = {"<yyyy>": r"\d{4}", "<mm>": r"\d{2}", "<dd>": r"\d{2}", "<hhmmss>": r"\d{6}"}
# Fixed value: where a file name carries its date.
NAME_DATE = r"(\d{4})[-_]?(\d{2})[-_]?(\d{2})"

_TOKEN = re.compile("(<yyyy>|<mm>|<dd>|<hhmmss>)")


def name_regex(pattern: str) -> str:
    """One anchored regex for a file-name pattern.

    The time of day is optional. ``*`` matches any text, everything else is literal.
    """

    def translate(text: str) -> str:
        out = []
        for piece in _TOKEN.split(text):
            if piece in NAME_TOKENS:
                out.append(NAME_TOKENS[piece])
            else:
                out.append(".*".join(re.escape(p) for p in piece.split("*")))
        return "".join(out)

    untimed = pattern.replace("_<hhmmss>", "").replace("<hhmmss>", "")
    forms = dict.fromkeys([translate(pattern), translate(untimed)])
    return "^(?:" + "|".join(forms) + ")$"


def received_name(path: Column) -> Column:
    """Name under which data was delivered.

    A delivery is one file, or a folder of part files as Spark writes it (``x.csv/part-0000…``); in
    the second case the folder name counts, without a leading ``received=``. Only a folder named like
    a file, with an extension, is a delivery: a file may itself start with ``part-``. Plain string
    functions: this runs once per row.
    """
    last = F.substring_index(path, "/", -1)
    above = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    name = F.when(last.startswith("part-") & above.contains("."), above).otherwise(last)
    return decoded(without_key(name, "received"))


def without_key(name: Column, key: str) -> Column:
    lead = f"{key}="
    return F.when(name.startswith(lead), F.substring(name, len(lead) + 1, 1 << 20)).otherwise(name)


def decoded(name: Column) -> Column:
    """File names in ``_metadata`` are URL-encoded."""
    plain = F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(name.contains("%"), F.coalesce(plain, name)).otherwise(name)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder_name(path: Column) -> Column:
    """Name of the folder a delivery lies in."""
    parts = F.split(path, "/")
    inside = F.element_at(parts, -1).startswith("part-") & F.try_element_at(parts, F.lit(-2)).contains(".")
    depth = F.when(inside, F.lit(-3)).otherwise(F.lit(-2))
    return decoded(without_key(F.try_element_at(parts, depth), "folder"))


def stem(name: Column) -> Column:
    """File name without folders and without its last extension."""
    return F.regexp_replace(base_name(name), r"(?<=.)\.[^.]*$", "")


def name_parts(name: Column) -> dict[str, Column]:
    """Year, month and day carried by a file name, NULL where there are none."""
    return {
        part: F.regexp_extract(name, NAME_DATE, i).try_cast("int")
        for i, part in enumerate(("yyyy", "mm", "dd"), start=1)
    }


def stream_name_parts(name: Column) -> dict[str, Column]:
    """Date parts as the file stream reads them: eight digits right after an underscore."""
    # The three patterns.
    rules = {"yyyy": r"_(\d{4})\d{4}", "mm": r"_\d{4}(\d{2})\d{2}", "dd": r"_\d{6}(\d{2})"}
    return {k: F.regexp_extract(name, rx, 1).try_cast("int") for k, rx in rules.items()}


def feed_of(name: Column) -> Column:
    """Feed a file belongs to: the first part of its name that is not a number, lower-cased."""
    parts = F.split(stem(name), "_")
    words = F.filter(parts, lambda p: ~p.rlike(r"^\d+$"))
    return F.lower(F.coalesce(F.try_element_at(words, F.lit(1)), F.element_at(parts, 1)))


def archive_feed(name: Column) -> Column:
    """Feed an archive belongs to: the text before the first underscore."""
    return F.element_at(F.split(F.regexp_replace(base_name(name), r"\.zip", ""), "_"), 1)


def belongs_to(name: Column, feed: str) -> Column:
    """Stream filter: ``<feed>_…`` or exactly ``<feed>.csv``."""
    return name.startswith(f"{feed}_") | (name == F.lit(f"{feed}.csv"))
