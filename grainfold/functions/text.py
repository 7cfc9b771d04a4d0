"""Text expressions: splitting, trimming, name and tag clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the characters a trim removes, U+0000 up to the blank
BLANKS = "".join(map(chr, range(0x21)))

_REGEX_SPECIAL = set(".$|()[{^?*+\\")


def split_fields(text: Column, sep: str) -> Column:
    """Split at a one-character separator and drop empty fields at the end.

    A text without separators is one field, also when it is empty; a text of separators
    only has no field.
    """
    pattern = f"\\{sep}" if sep in _REGEX_SPECIAL else sep
    kept = F.rtrim(text, F.lit(sep))
    no_field = (kept == "") & (text != "")
    return F.when(no_field, F.array().cast("array<string>")).otherwise(F.split(kept, pattern))


def field_count(text: Column, sep: str) -> Column:
    """How many fields ``split_fields`` gives, without splitting."""
    kept = F.rtrim(text, F.lit(sep))
    separators = F.length(kept) - F.length(F.replace(kept, F.lit(sep), F.lit("")))
    return F.when((kept == "") & (text != ""), 0).otherwise(separators + 1)


def trim_blanks(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def after_first_comma(text: Column) -> Column:
    """The trimmed text after the first comma, null when there is no comma."""
    comma = F.instr(text, ",")
    return F.when(comma > 0, trim_blanks(F.substr(text, comma + 1)))


def year_of(date: Column) -> Column:
    """What stands before the first ``-`` of a date, all of it when there is none."""
    return F.substring_index(date, "-", 1)


def without_year(tags: Column, date: Column) -> Column:
    """``tags`` without any occurrence of the year that starts ``date`` (``yyyy-...``)."""
    return F.replace(tags, year_of(date), F.lit(""))


def occurs_in(part: Column, whole: Column) -> Column:
    """Case-blind substring test; the empty text occurs everywhere."""
    return F.contains(F.lower(whole), F.lower(part))
