"""Text clean-up columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_level(text: Column) -> Column:
    """Trim, blanks to underscores, slashes removed."""
    return F.translate(F.trim(text), " /", "_")


def empty_to(text: Column, default: str) -> Column:
    return F.when(text == "", F.lit(default)).otherwise(text)


def wordless_to(text: Column, default: str = "None") -> Column:
    """Texts without a single word character, in any script, become ``default``; NULL too."""
    return F.when(F.coalesce(text, F.lit("")).rlike(r"(?U)\w"), text).otherwise(F.lit(default))


def contains_ignoring_case(text: Column, phrase: str) -> Column:
    """Substring test that answers False for NULL."""
    return F.coalesce(F.lower(text).contains(phrase.lower()), F.lit(False))


def level_text(value: Column) -> Column:
    """A category level as text, for encoders."""
    return value.cast("string")
