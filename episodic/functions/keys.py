"""Key normalisation expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_key(c: Column) -> Column:
    """Lower, trim, remove whitespace and '-', strip leading zeros."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"\s|-", ""), "^0+", "")


def text_key(c: Column) -> Column:
    """A key compared as trimmed text (worklists hold numbers as text)."""
    return F.trim(c.cast("string"))


def int_key(c: Column) -> Column:
    """Text or number -> bigint once, on both sides; bad values -> null."""
    return F.trim(c.cast("string")).try_cast("bigint")
