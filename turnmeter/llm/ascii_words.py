"""Words between ASCII white space, A-Z lower-cased: the same in column expressions and in Python."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def words_column(text: Column) -> Column:
    """Array of the words of ``text``; empty for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, r"[\x20\x09-\x0D]+", -1), "")


def words_of(text: str | None) -> list[bytes]:
    """The same words, as UTF-8."""
    return (text or "").encode().lower().split()  # bytes know ASCII letters and white space only
