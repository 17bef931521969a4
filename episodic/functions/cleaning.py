"""Cleaning expressions for hand-kept lists and exported text.

All are Column expressions: they run inside whole-stage codegen on every
row, no Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Tokens a spreadsheet export shows for "no value" (rendered as '').
NULL_TOKENS = ("NaT", "nan", "NaN", "None", "<NA>", "inf", "-inf")


def clean_date_text(c: Column) -> Column:
    """Drop whitespace, turn '.' and '/' into '-' ('2025. 08. 28' -> '2025-08-28')."""
    return F.translate(F.regexp_replace(c, r"\s", ""), "./", "--")


def parse_date_text(c: Column, formats: Sequence[str] = ("yyyy-MM-dd", "yyyyMMdd")) -> Column:
    """I16: first format that parses wins; garbage -> null (never an error)."""
    cleaned = clean_date_text(c)
    return F.coalesce(*[F.try_to_timestamp(cleaned, F.lit(f)).cast("date") for f in formats])


def strip_nul(c: Column) -> Column:
    """Remove NUL characters."""
    return F.replace(c, F.lit("\u0000"), F.lit(""))


def stringify(c: Column) -> Column:
    """Text for a sheet: null and null-like tokens -> ''."""
    s = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(s.isin(*NULL_TOKENS), F.lit("")).otherwise(s)


def map_strings(df: DataFrame, fn) -> DataFrame:
    """Apply ``fn`` to every string column (I29/I30 over a whole table)."""
    return df.select(*[fn(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType)
                       else F.col(f.name) for f in df.schema.fields])


def trim_all(df: DataFrame) -> DataFrame:
    """Strip every string column."""
    return map_strings(df, F.trim)
