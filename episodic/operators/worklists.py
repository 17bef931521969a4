"""Work-list sinks (B20, B21, D17) re-aimed from spreadsheet ranges to bucketed tables.

A list is a ``BucketTable`` keyed by its row key. ``replace_list`` is the clear-and-write form, ``append_list`` adds the
rows whose key is not on the list yet (the reference's "write at the first blank row" after its own anti-join), tagged
with the run that added them; it reads only the buckets its rows fall into and rewrites none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodic.functions.keys import text_key
from episodic.operators.buckets import BucketTable, Version


def replace_list(table: BucketTable, df: DataFrame) -> Version:
    """B20 (a, b, d): the list becomes exactly ``df`` (no stale tail rows survive)."""
    return table.replace(_keyed(table, df), table.next_version())


def append_list(table: BucketTable, new_rows: DataFrame, run_id: str) -> Version:
    """B20 (c) + D17: append rows whose trimmed text key is absent; one new version per run."""
    key = table.keys[0]

    def fresh(stored: DataFrame, batch: DataFrame) -> DataFrame:
        return batch.join(stored.select(key), key, "left_anti")

    return table.append(_keyed(table, new_rows).withColumn("added_by", F.lit(run_id)), table.next_version(), fresh)


def _keyed(table: BucketTable, df: DataFrame) -> DataFrame:
    """The rows with their key trimmed, as it is stored: equal keys fall into one bucket."""
    return df.withColumn(table.keys[0], text_key(F.col(table.keys[0])))


def blank_cells(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with an empty cell in any of ``cols`` (the candidates of a backfill)."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.coalesce(F.trim(F.col(c).cast("string")) == "", F.lit(True))
    return df.filter(cond)
