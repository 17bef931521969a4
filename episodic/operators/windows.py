"""Window building blocks that stay correct and parallel when one key is hot.

A plain ``sum().over(partitionBy(key).orderBy(ts))`` sends every row of a
key to one task. Given a ``chunk`` (a function of the first order column,
for instance its day), the windows here run per (key, chunk) instead:

1. the rows are shuffled once on (key, chunk) and the per-row window runs
   inside the chunk;
2. one row per (key, chunk) (the chunk sum, or the chunk's edge value) is
   aggregated with a map-side combine and windowed per key on that small
   table;
3. the small result joins back on (key, chunk). Keys and chunk are encoded as
   non-null (is-null flag, value) column pairs, so the join uses plain
   equality and the large side keeps the partitioning of step 1: only the
   small side is shuffled.

So the split costs one large shuffle, the same as the plain window. The
result equals the default RANGE frame (peers share a value) because equal
order values always land in one chunk.

Which window runs is decided where it is called, never by counting rows: a key
that may be hot (a lecture, a user, a customer) is always given a ``chunk``,
a key bounded by nature (the lines of one order) never is. Where many rows of a
key may share a chunk (all unparsable dates are one null chunk), a total order
may be cut further: ``chunk`` is then a list of columns that sort like the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


_EPOCH = {"date": "1970-01-01", "timestamp": "1970-01-01 00:00:00", "timestamp_ntz": "1970-01-01 00:00:00"}


def _encode(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add a non-null (is-null flag, value-or-default) pair per column; return the pair names.

    Grouping, windowing and equi-joining on the pairs equals doing so on the
    columns with nulls as one group, and keeps the join on the window's
    partitioning (a null-safe join key would force a re-shuffle)."""
    names = []
    for i, c in enumerate(cols):
        dt = df.schema[c].dataType.simpleString()
        if dt in _EPOCH:
            default = F.lit(_EPOCH[dt]).cast(dt)
        elif dt == "string":
            default = F.lit("")
        elif dt == "boolean":
            default = F.lit(False)
        else:
            default = F.lit(0).cast(dt)
        df = df.withColumn(f"_en{i}", F.col(c).isNull()).withColumn(f"_ev{i}", F.coalesce(F.col(c), default))
        names += [f"_en{i}", f"_ev{i}"]
    return df, names


def _chunked(df: DataFrame, keys: Sequence[str], chunk) -> tuple[DataFrame, list[str], int]:
    """``df`` with encoded keys and chunk columns, their names, and how many of them belong to the chunk."""
    parts = list(chunk) if isinstance(chunk, (list, tuple)) else [chunk]
    names = [f"_chunk{i}" for i in range(len(parts))]
    for n, c in zip(names, parts):
        df = df.withColumn(n, c)
    df, enc = _encode(df, list(keys) + names)
    return df.drop(*names), enc, 2 * len(parts)


def _chunk_order(enc: Sequence[str], n: int, nulls_last: bool) -> list[Column]:
    out = []
    for i in range(len(enc) - n, len(enc), 2):
        flag, value = F.col(enc[i]), F.col(enc[i + 1])
        out += [flag.asc() if nulls_last and i == len(enc) - n else flag.desc(), value.asc()]
    return out


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence, value: Column, out: str,
                  chunk=None, chunk_nulls_last: bool = False) -> DataFrame:
    """``out`` = sum of ``value`` over rows of the same key ordered at or before this row.

    Frame: RANGE UNBOUNDED PRECEDING .. CURRENT ROW on ``order`` (peers
    included). With ``chunk`` given the work is split per (key, chunk).
    ``value`` should be integral or decimal so that the split sum is exact.
    ``chunk_nulls_last`` must match the null placement of the first order
    column (a null order value gives a null chunk).
    """
    order_cols = _cols(order)
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*order_cols)
        return df.withColumn(out, F.sum(value).over(w))
    tmp, enc, n = _chunked(df.withColumn("_v", value), keys, chunk)
    inner = tmp.withColumn("_in", F.sum("_v").over(Window.partitionBy(*enc).orderBy(*order_cols)))
    per_chunk = inner.groupBy(*enc).agg(F.sum("_v").alias("_chunk_sum"))
    before = Window.partitionBy(*enc[:-n]).orderBy(*_chunk_order(enc, n, chunk_nulls_last)) \
        .rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(per_chunk.schema["_chunk_sum"].dataType)
    offsets = per_chunk.select(*enc, F.coalesce(F.sum("_chunk_sum").over(before), zero).alias("_offset"))
    joined = inner.join(offsets, enc, "inner")
    return joined.withColumn(out, F.col("_offset") + F.col("_in")).drop("_v", "_in", "_offset", *enc)


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence, n: int = 1,
               rank_col: str | None = None) -> DataFrame:
    """Top-n rows per key (C13/F9/F11). ``row_number() <= n`` lets Spark put a
    partial group limit before the shuffle, so a hot key is cut map-side."""
    rn = rank_col or "_rn"
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    res = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)
    if rank_col is None:
        return res.drop(rn)
    return res.withColumn(rn, F.col(rn).cast("bigint"))


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence, out: str,
                chunk=None, chunk_nulls_last: bool = False) -> DataFrame:
    """``row_number()`` per key over a total order (the order must include a tie-break).

    With ``chunk`` it is computed as a running count split per (key, chunk),
    so a hot key is numbered by many tasks."""
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*_cols(order))
        return df.withColumn(out, F.row_number().over(w).cast("bigint"))
    return running_total(df, keys, order, F.lit(1).cast("bigint"), out, chunk=chunk,
                         chunk_nulls_last=chunk_nulls_last)


def shifted(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, out: str, direction: int = 1,
            chunk=None) -> DataFrame:
    """``lead(col)`` (direction 1) or ``lag(col)`` (direction -1) per key over an ascending total order.

    With ``chunk`` (a function of the first order column, e.g. its day) the
    shift runs per (key, chunk); the row at a chunk edge takes its neighbour
    from the first (or last) row of the next (or previous) non-empty chunk,
    found on the small per-(key, chunk) table. Order columns sort ascending
    with nulls first, as the plain window does.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    fn = F.lead if direction == 1 else F.lag
    if chunk is None:
        return df.withColumn(out, fn(col).over(w))
    tmp, enc, n = _chunked(df, keys, chunk)
    wk = Window.partitionBy(*enc).orderBy(*order)
    tmp = tmp.withColumn("_in", fn(col).over(wk)).withColumn("_edge", fn(F.lit(1)).over(wk).isNull())
    probe = F.struct(*[F.col(o) for o in order], F.col(col).alias("_v"))
    edge = (F.min(probe) if direction == 1 else F.max(probe))["_v"]
    per = tmp.groupBy(*enc).agg(edge.alias("_edge_v"))
    wc = Window.partitionBy(*enc[:-n]).orderBy(*_chunk_order(enc, n, nulls_last=False))
    nb = per.select(*enc, fn("_edge_v").over(wc).alias("_nb"))
    j = tmp.join(nb, enc, "inner")
    return j.withColumn(out, F.when(F.col("_edge"), F.col("_nb")).otherwise(F.col("_in"))) \
        .drop("_in", "_edge", "_nb", *enc)


def filled(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, out: str, chunk=None) -> DataFrame:
    """Forward fill: ``last(col, ignorenulls)`` per key over ROWS UNBOUNDED PRECEDING .. CURRENT ROW.

    ``order`` names columns sorted ascending, nulls first, and must be total
    for the rows that carry a value. With ``chunk`` the fill runs per
    (key, chunk); a chunk's first rows take the last value of the nearest
    earlier chunk that has one, found on the small per-(key, chunk) table.
    """
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    if chunk is None:
        return df.withColumn(out, F.last(col, ignorenulls=True).over(w))
    rows, enc, n = _chunked(df, keys, chunk)
    wk = Window.partitionBy(*enc).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    tmp = rows.withColumn("_in", F.last(col, ignorenulls=True).over(wk))
    # struct order = ascending, nulls first: the max is the chunk's last carrying row
    probe = F.struct(*[F.col(o) for o in order], F.col(col).alias("_v"))
    valued = rows.filter(F.col(col).isNotNull()).groupBy(*enc).agg(F.max(probe)["_v"].alias("_last_v"))
    # rows without a value only name their chunk: a maximum of structs would sort them all, this hashes them
    empty = rows.filter(F.col(col).isNull()).select(*enc).distinct() \
        .withColumn("_last_v", F.lit(None).cast(valued.schema["_last_v"].dataType))
    # a chunk of both kinds has two rows, the one without a value first; either sees what lies before the chunk
    has = F.col("_last_v").isNotNull()
    wc = Window.partitionBy(*enc[:-n]).orderBy(*_chunk_order(enc, n, nulls_last=False), has) \
        .rowsBetween(Window.unboundedPreceding, -1)
    carry = valued.unionByName(empty) \
        .withColumn("_carry", F.last("_last_v", ignorenulls=True).over(wc)) \
        .withColumn("_one", F.row_number().over(Window.partitionBy(*enc).orderBy(has))) \
        .filter("_one = 1").select(*enc, "_carry")
    j = tmp.join(carry, enc, "inner")
    return j.withColumn(out, F.coalesce(F.col("_in"), F.col("_carry"))).drop("_in", "_carry", *enc)
