"""Incremental mirror operators.

All of them are set operations on DataFrames: Parquet tables have no
UPDATE/MERGE, so an upsert is "old rows whose key is not in the update"
union "the update", written to a new path and swapped in by the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodic.operators.windows import running_total


def high_water_mark(target: DataFrame, col: str, default=None):
    """max(col) of the stored target, or ``default`` when it is empty.

    Returns one scalar to the driver on purpose: as a literal it reaches the
    Parquet scan of the source as a pushed filter (row-group skipping),
    which a correlated subquery would not.
    """
    v = target.agg(F.max(col).alias("hwm")).first()["hwm"]
    return default if v is None else v


def scan_since(source: DataFrame, col: str, hwm, inclusive: bool = False) -> DataFrame:
    """A4/A5: rows strictly after (or at, when inclusive) the high-water mark."""
    lit = F.lit(hwm)
    if source.schema[col].dataType.typeName() == "timestamp_ntz":
        lit = lit.cast("timestamp_ntz")
    return source.filter(F.col(col) >= lit if inclusive else F.col(col) > lit)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   null_keys: str = "drop") -> DataFrame:
    """The newest row per key.

    ``order`` lists the ranking, newest first, including the tie-break
    (e.g. ``[ts.desc_nulls_last(), batch.desc(), id.desc()]``). Rows whose key
    is null are dropped (``null_keys='drop'``, the mirror behaviour) or kept
    as they are (``'keep'``). ``row_number() == 1`` is planned with a partial
    per-partition limit ahead of the shuffle, so a hot key shrinks map-side.
    """
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    keyed = df.filter(not_null)
    w = Window.partitionBy(*keys).orderBy(*order)
    res = keyed.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    if null_keys == "keep":
        res = res.unionByName(df.filter(~not_null))
    return res


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace rows of ``target`` whose key appears in ``updates``."""
    kept = target.join(updates.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  order: Sequence[Column] | None = None) -> DataFrame:
    """Append source rows whose key is absent from target (ON CONFLICT DO NOTHING).

    Duplicates inside ``source`` keep the first row in ``order``."""
    src = source
    if order is not None:
        src = latest_per_key(source, keys, order)
    fresh = src.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def state_changes(stored_latest: DataFrame, current: DataFrame, key: str, state: str) -> DataFrame:
    """Rows of ``current`` whose key is unseen or whose state differs (null-safe)."""
    old = stored_latest.select(F.col(key).alias("_old_key"), F.col(state).alias("_old_state"))
    j = current.join(old, current[key] == old["_old_key"], "left")
    changed = F.col("_old_key").isNull() | ~F.col(state).eqNullSafe(F.col("_old_state"))
    return j.filter(changed).drop("_old_key", "_old_state")


def carried_cumsum(stored: DataFrame, delta: DataFrame, key: str, order: Sequence, value: str,
                   out: str, chunk: Column | None = None) -> DataFrame:
    """Running total of the delta continued from the stored maximum per key."""
    base = stored.groupBy(key).agg(F.max(out).alias("_base"))
    run = running_total(delta, [key], order, F.col(value), "_run", chunk=chunk)
    j = run.join(base, key, "left")
    zero = F.lit(0).cast(j.schema["_run"].dataType)
    return j.withColumn(out, F.coalesce(F.col("_base"), zero) + F.col("_run")).drop("_base", "_run")


def refresh_mirror(source: DataFrame, target: DataFrame, spec, default: str = "1900-01-01 00:00:00") -> DataFrame:
    """One refresh of a mirrored table, driven by its ``TableSpec``.

    Rows of ``source`` after (``inclusive``: at or after) the target's high-water mark are added to ``target``; of each
    key the row of the latest watermark stays, the new one among equals. Only the listed columns are copied, and
    never those of the deny-list. A table without a watermark is copied whole.
    """
    columns = [c for c in (spec.columns or source.columns) if c not in spec.deny]
    delta = source.select(*columns)
    if spec.watermark:
        delta = scan_since(delta, spec.watermark, high_water_mark(target, spec.watermark, default=default), spec.inclusive)
    both = target.select(*columns).withColumn("_batch", F.lit(0)).unionByName(delta.withColumn("_batch", F.lit(1)))
    order = ([F.col(spec.watermark).desc_nulls_last()] if spec.watermark else []) + [F.col("_batch").desc()]
    return latest_per_key(both, list(spec.key), order).drop("_batch")
