"""Serialised feedback forms.

A form is stored as one string ``{"key":"value","key2":"value2"}``. Spark
has no multimap type and ``str_to_map`` rejects repeated keys, so the form is
exploded to (position, key, value) rows; a value may itself contain the
key/value delimiter (only the first one splits). Pivoting maps keys to a
fixed list of slots, so the output schema never depends on the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_pairs(df: DataFrame, body: str, entry_sep: str = '","', kv_sep: str = ":",
                  keep: Sequence[str] = (), strip: str = '{}"') -> DataFrame:
    """One row per form entry: ``keep`` columns + pair_no (1-based), key, value."""
    inner = F.regexp_replace(F.col(body), r"^\s*\{|\}\s*$", "")
    parts = F.split(inner, _regex_quote(entry_sep))
    exploded = df.select(*keep, F.posexplode(parts).alias("_pos", "_entry"))
    cut = F.instr(F.col("_entry"), kv_sep)
    key = F.when(cut > 0, F.substring_index(F.col("_entry"), kv_sep, 1)).otherwise(F.col("_entry"))
    value = F.when(cut > 0, F.expr(f"substr(_entry, instr(_entry, '{kv_sep}') + {len(kv_sep)})"))
    return exploded.select(*keep, (F.col("_pos") + 1).cast("bigint").alias("pair_no"),
                           F.trim(F.translate(key, strip, "")).alias("key"),
                           F.trim(F.translate(value, strip, "")).alias("value"))


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in s)


def pivot_slots(pairs: DataFrame, keys: Sequence[str], key_col: str, value_col: str,
                slots: Mapping[str, Sequence[str]], cast: str | None = None,
                strict: bool = False, casts: Mapping[str, str | None] | None = None) -> DataFrame:
    """One row per ``keys``; slot = max(value) over the form keys mapped to it.

    ``cast`` converts values (``try_cast`` unless ``strict``, which fails on
    a bad value as the reference's plain CAST does)."""
    aggs: list[Column] = []
    default_cast = cast
    for slot, members in slots.items():
        v = F.col(value_col)
        cast = (casts or {}).get(slot, default_cast)
        if cast:
            v = v.cast(cast) if strict else F.expr(f"try_cast({value_col} AS {cast})")
        aggs.append(F.max(F.when(F.col(key_col).isin(list(members)), v)).alias(slot))
    return pairs.groupBy(*keys).agg(*aggs)
