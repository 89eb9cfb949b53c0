"""Word columns: words are runs of anything but the six ASCII white-space characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """All words of a text in order; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")
