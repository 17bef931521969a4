"""Episodes and interval joins.

``episodes`` turns a stream of start/stop markers per key into numbered
episodes: every stop closes the episode it belongs to, every start after
it opens the next one. The episode number of a row is the number of stops
at or before its time (RANGE frame, so a start at the same instant as a stop
belongs to the *next* episode), plus one for starts.

``episodes_with_points`` numbers markers and points (sessions) in one pass over their
union and aggregates the points of every episode on the way; no join of points and
intervals takes place.

``asof_join`` matches points to intervals that tile the time line of a key
(each runs from its start to the next start): intervals and points are
unioned and shuffled once per key, and every point takes the latest interval
starting at or before it (a forward fill, split by chunk for hot keys). No
interval is copied, however long it is.

``range_join`` matches points to intervals that may overlap, without forming
all pairs of a key: an interval goes to the one or two blocks, of the power of
two days next to its length, that it touches; a point goes to its block of each
length that occurs, and the join key is (key, length, block). A hot key is split
over its blocks. The bounds are then checked exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodic.operators.windows import _chunk_order, _chunked, filled, running_total, shifted

_UNITS = {"day", "week", "month", "year", "hour"}


def episodes(markers: DataFrame, key: str, ts: str, state: str, start_value: str = "active",
             stop_value: str = "done", extra_aggs: Sequence[Column] = (), chunk: Column | None = None,
             seq_col: str = "seq") -> DataFrame:
    """One row per (key, episode number): first start, last stop, last marker time."""
    is_stop = (F.col(state) == F.lit(stop_value)).cast("int")
    m = running_total(markers, [key], [F.col(ts)], is_stop, "_stops_le", chunk=chunk)
    m = m.withColumn(seq_col, F.when(F.col(state) == F.lit(stop_value), F.col("_stops_le"))
                     .otherwise(F.col("_stops_le") + 1).cast("bigint"))
    return m.groupBy(key, seq_col).agg(
        F.min(F.when(F.col(state) == F.lit(start_value), F.col(ts))).alias("active_timestamp"),
        F.max(F.when(F.col(state) == F.lit(stop_value), F.col(ts))).alias("done_timestamp"),
        F.max(ts).alias("marker_updated_at"),
        *extra_aggs,
    )


def _combined(fn: str, *cs: Column) -> Column:
    """Partial results of one aggregate put together; nulls (of empty parts) count for nothing."""
    if fn in ("min", "max"):
        return (F.least if fn == "min" else F.greatest)(*cs)
    a, b = cs
    return F.coalesce(a + b, a, b)


def episodes_with_points(rows: DataFrame, key: str, ts: str, kind: str, horizon: Column, chunk: Column,
                         marker_stats: Mapping[str, tuple[str, Column]], point_stats: Mapping[str, tuple[str, Column]],
                         seq_col: str = "seq") -> DataFrame:
    """One row per (key, episode): first start, last stop, last marker time, and aggregates of markers and contained points.

    ``kind`` says of a row whether it is a ``start``, a ``stop`` or a ``point``. A point belongs to an episode if it lies
    between its first start and its last stop, both included, or, of an episode that never stops, ``horizon``.
    Statistics are (``min``/``max``/``sum``/``count``, column).

    One pass: rows are shuffled once by (key, chunk) and the stops at or before each row counted (see ``windows``). Between
    two stops all points belong to the episode that is open there, from its first start on; within the start's chunk the
    points before it are left out row by row, later chunks count whole. A point on the very instant of a stop belongs to the
    episode that stops there as well. What remains is aggregated where it is into one small row per (key, episode, chunk),
    then into one per (key, episode). Where stops share an instant an episode is never closed (its number is passed over):
    it also holds the points of all later ones, taken from the aggregates of these as a running total from the last one back.
    """
    k = F.col(kind)
    rows = rows.filter((k != "point") | (F.col(key).isNotNull() & F.col(ts).isNotNull()))
    tmp, enc, n = _chunked(rows.withColumn("_stop", (k == "stop").cast("int")), [key], chunk)
    keys, day = enc[:-n], enc[-1]
    by_time = Window.partitionBy(*enc).orderBy(ts)
    inner = tmp.withColumn("_in", F.sum("_stop").over(by_time)) \
        .withColumn("_here", F.sum("_stop").over(by_time.rangeBetween(Window.currentRow, Window.currentRow)))
    per_chunk = inner.groupBy(*enc).agg(F.sum("_stop").alias("_stops"))
    before = Window.partitionBy(*keys).orderBy(*_chunk_order(enc, n, False)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.select(*enc, F.coalesce(F.sum("_stops").over(before), F.lit(0)).alias("_offset"))
    le = F.col("_offset") + F.col("_in")
    began = F.min(F.when(k == "start", F.col(ts))).over(Window.partitionBy(*enc, "_in"))
    role = F.when(k == "point", F.lit("point")).otherwise(F.lit("marker"))
    own = F.struct(F.when(k == "stop", le).otherwise(le + 1).alias("seq"), role.alias("role"))
    both = F.array(own, F.struct(le.alias("seq"), F.lit("edge").alias("role")))
    placed = inner.join(offsets, enc).withColumn("_began", began).withColumn(
        "_p", F.explode(F.when((k == "point") & (F.col("_here") > 0), both).otherwise(F.array(own))))
    r, t = F.col("_p.role"), F.col(ts)
    late = F.coalesce((k == "point") & (t > horizon), F.lit(False))

    def agg(fn: str, c: Column) -> Column:
        return {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}[fn](c)

    pieces = placed.groupBy(*enc, F.col("_p.seq").alias("_seq"), late.alias("_late")).agg(
        F.min(F.when(k == "start", t)).alias("_start"), F.max(F.when(k == "stop", t)).alias("_done"),
        F.max(F.when(r == "marker", t)).alias("_marked"),
        *[agg(fn, F.when(r == "marker", c)).alias(f"_m_{o}") for o, (fn, c) in marker_stats.items()],
        *[agg(fn, F.when((r == "point") & (t >= F.col("_began")), c)).alias(f"_a_{o}") for o, (fn, c) in point_stats.items()],
        *[agg(fn, F.when(r == "point", c)).alias(f"_b_{o}") for o, (fn, c) in point_stats.items()],
        *[agg(fn, F.when(r == "edge", c)).alias(f"_e_{o}") for o, (fn, c) in point_stats.items()])
    episode = Window.partitionBy(*keys, "_seq")
    pieces = pieces.withColumn("_first", F.min(F.when(F.col("_start").isNotNull(), F.col(day))).over(episode)) \
        .withColumn("_open", F.max("_done").over(episode).isNull())

    def total(fn: str, c: Column) -> Column:
        return agg("sum" if fn == "count" else fn, c)

    counted = ~(F.col("_late") & F.col("_open"))
    whole, part = F.col(day) > F.col("_first"), F.col(day) == F.col("_first")

    def own_points(o: str, fn: str) -> Column:
        inside = F.when(whole, F.col(f"_b_{o}")).when(part, F.col(f"_a_{o}"))
        return total(fn, F.when(counted, _combined(fn, inside, F.col(f"_e_{o}"))))

    eps = pieces.groupBy(*keys, "_seq").agg(
        F.min("_start").alias("active_timestamp"), F.max("_done").alias("done_timestamp"), F.max("_marked").alias("marker_updated_at"),
        *[total(fn, F.col(f"_m_{o}")).alias(o) for o, (fn, _) in marker_stats.items()],
        *[own_points(o, fn).alias(o) for o, (fn, _) in point_stats.items()],
        *[total(fn, F.when(~F.col("_late"), F.col(f"_b_{o}"))).alias(f"_b_{o}") for o, (fn, _) in point_stats.items()])
    later = Window.partitionBy(*keys).orderBy(F.col("_seq").desc()).rowsBetween(Window.unboundedPreceding, -1)
    out = eps.select("*", *[total(fn, F.col(f"_b_{o}")).over(later).alias(f"_l_{o}") for o, (fn, _) in point_stats.items()])
    out = out.select("*", *[
        F.when(F.col("active_timestamp").isNotNull(), F.when(F.col("done_timestamp").isNull(), _combined(
            fn, F.col(o), F.col(f"_l_{o}"))).otherwise(F.col(o))).alias(f"_r_{o}")
        for o, (fn, _) in point_stats.items()])
    named = F.when(~F.col(keys[0]), F.col(keys[1])).alias(key)
    return out.where(F.col("marker_updated_at").isNotNull() | F.col("active_timestamp").isNotNull()).select(
        named, F.col("_seq").cast("bigint").alias(seq_col), "active_timestamp", "done_timestamp", "marker_updated_at", *marker_stats,
        *[(F.coalesce(F.col(f"_r_{o}"), F.lit(0)) if fn == "count" else F.col(f"_r_{o}")).alias(o) for o, (fn, _) in point_stats.items()])


def with_next(df: DataFrame, key: str, order: Sequence, col: str, out: str,
              chunk: Column | None = None) -> DataFrame:
    """``lead(col)`` per key in ``order`` (tie-break belongs in ``order``).

    ``chunk`` (e.g. the month of the first order column) splits a hot key
    over many tasks; see ``windows.shifted``."""
    if chunk is not None:
        return shifted(df, [key], list(order), col, out, direction=1, chunk=chunk)
    w = Window.partitionBy(key).orderBy(*[F.col(o) if isinstance(o, str) else o for o in order])
    return df.withColumn(out, F.lead(col).over(w))


_DAY = "1970-01-01"


def _day(c: Column) -> Column:
    return F.datediff(c.cast("timestamp_ntz"), F.lit(_DAY).cast("timestamp_ntz"))


def _covered(intervals: DataFrame, start: str, end: str, outer: bool = False) -> DataFrame:
    """The intervals with the blocks (``_level``, ``_block``) of power-of-two days that cover them.

    An interval of n days takes the level whose blocks have at least n days: it touches one or two of them, however long
    it is. ``outer`` keeps intervals without a bound (or with bounds that cross) in a null block."""
    first, last = _day(F.col(start)), _day(F.col(end))
    level = F.ceil(F.log2((last - first + 1).cast("double"))).cast("int")
    size = F.pow(F.lit(2.0), F.col("_level"))
    iv = intervals.withColumn("_level", F.when(last >= first, level))
    ends = F.array_distinct(F.array(F.floor(first / size).cast("bigint"), F.floor(last / size).cast("bigint")))
    blocks = F.when(F.col("_level").isNotNull(), ends)
    return iv.withColumn("_block", (F.explode_outer if outer else F.explode)(blocks))


def _placed(iv: DataFrame, points: DataFrame, keys: Sequence[tuple[str, str]], point: str) -> DataFrame:
    """The points with their block (``_plevel``, ``_pblock``) of every level that an interval of their key has."""
    names = [f"_lk{i}" for i in range(len(keys))]
    levels = iv.where("_level is not null").groupBy(*[F.col(a).alias(n) for (a, _), n in zip(keys, names)]) \
        .agg(F.collect_set("_level").alias("_levels"))
    pt = points.join(levels, [points[b] == levels[n] for (_, b), n in zip(keys, names)]).drop(*names)
    pt = pt.withColumn("_plevel", F.explode("_levels")).drop("_levels")
    return pt.withColumn("_pblock", F.floor(_day(F.col(point)) / F.pow(F.lit(2.0), F.col("_plevel"))).cast("bigint"))


def range_join(intervals: DataFrame, points: DataFrame, keys: Sequence[tuple[str, str]],
               start: str, end: str, point: str, lower_inclusive: bool = True, upper_inclusive: bool = True) -> DataFrame:
    """Inner join of points to the intervals of the same key that contain them; intervals may overlap and last for years.

    ``keys`` pairs (interval column, point column). ``end`` must be non-null (open ends are closed by the caller, e.g.
    ``as_of + 1 month``). Columns of both sides are kept; names must not collide. An interval is copied at most twice, a
    point once for each length class (power of two days) among the intervals of its key, so copies grow with the
    logarithm of the longest interval; a hot key is spread over its blocks. The bounds are then checked exactly.
    """
    iv = _covered(intervals, start, end)
    pt = _placed(iv, points, keys, point)
    cond = [iv[a] == pt[b] for a, b in keys] + [iv["_level"] == pt["_plevel"], iv["_block"] == pt["_pblock"]]
    lo = pt[point] >= iv[start] if lower_inclusive else pt[point] > iv[start]
    hi = pt[point] <= iv[end] if upper_inclusive else pt[point] < iv[end]
    return iv.join(pt, cond + [lo, hi], "inner").drop("_level", "_block", "_plevel", "_pblock")


def interval_aggregate(intervals: DataFrame, points: DataFrame, keys: Sequence[tuple[str, str]],
                       start: str, end: str, point: str, aggs: Sequence[Column],
                       lower_inclusive: bool = True, upper_inclusive: bool = True) -> DataFrame:
    """Every interval with aggregates over the points it contains (LEFT join semantics).

    Each block copy of an interval is left-joined to the points of its (key, block) with the bounds in the ON clause, then
    rows are grouped back per interval. A block without a match contributes a null row, which aggregates ignore, so an
    interval without any point still appears once (count = 0, other aggregates null). ``intervals`` must be distinct rows
    and ``end`` non-null.
    """
    icols = intervals.columns
    iv = _covered(intervals, start, end, outer=True)
    pt = _placed(iv, points, keys, point)
    cond = [iv[a] == pt[b] for a, b in keys] + [iv["_level"] == pt["_plevel"], iv["_block"] == pt["_pblock"]]
    lo = pt[point] >= iv[start] if lower_inclusive else pt[point] > iv[start]
    hi = pt[point] <= iv[end] if upper_inclusive else pt[point] < iv[end]
    return iv.join(pt, cond + [lo, hi], "left").groupBy(*[iv[c] for c in icols]).agg(*aggs)


def asof_join(intervals: DataFrame, points: DataFrame, keys: Sequence[tuple[str, str]],
              start: str, end: str, point: str, tie: Sequence[str] = (), chunk_unit: str = "day",
              lower_inclusive: bool = True, upper_inclusive: bool = True) -> DataFrame:
    """``range_join`` for intervals that do not overlap within a key (they tile: each ends where
    the next, in (start, *tie) order, begins).

    Each point takes the last interval whose start is at or before it; then
    both bounds are checked exactly, so the result equals ``range_join`` on
    such intervals. Rows with a null key or start never match.
    """
    assert chunk_unit in _UNITS, chunk_unit
    kn = [f"_aj_k{i}" for i in range(len(keys))]
    # what is sorted holds a key and a time once: the key columns come back from the row's own
    of_iv, of_pt = {a: k for (a, _), k in zip(keys, kn)}, {b: k for (_, b), k in zip(keys, kn)}
    iv = F.struct(*[c for c in intervals.columns if c not in of_iv], F.lit(0).alias("_z"))
    pt = F.struct(*[c for c in points.columns if c not in of_pt], F.lit(0).alias("_z"))
    iv_t = intervals.select(iv.alias("_iv")).schema["_iv"].dataType
    pt_t = points.select(pt.alias("_pt")).schema["_pt"].dataType
    iv_ok = F.lit(True)
    for a, _ in keys:
        iv_ok = iv_ok & F.col(a).isNotNull()
    pt_ok = F.lit(True)
    for _, b in keys:
        pt_ok = pt_ok & F.col(b).isNotNull()
    tie_t = intervals.select(F.struct(*[F.col(c) for c in tie], F.lit(0).alias("_z")).alias("t")) \
        .schema["t"].dataType
    # at equal times an interval start sorts before the points, so "at or before" holds
    marks = intervals.filter(iv_ok & F.col(start).isNotNull()).select(
        *[F.col(a).alias(k) for (a, _), k in zip(keys, kn)],
        F.col(start).cast("timestamp_ntz").alias("_aj_t"), F.lit(0).alias("_aj_kind"),
        F.struct(*[F.col(c) for c in tie], F.lit(0).alias("_z")).alias("_aj_tie"),
        iv.alias("_iv"), F.lit(None).cast(pt_t).alias("_pt"))
    pts = points.filter(pt_ok).select(
        *[F.col(b).alias(k) for (_, b), k in zip(keys, kn)],
        F.col(point).cast("timestamp_ntz").alias("_aj_t"), F.lit(1).alias("_aj_kind"),
        F.lit(None).cast(tie_t).alias("_aj_tie"),
        F.lit(None).cast(iv_t).alias("_iv"), pt.alias("_pt"))
    u = filled(marks.unionByName(pts), kn, ["_aj_t", "_aj_kind", "_aj_tie"], "_iv", "_aj_iv",
               chunk=F.date_trunc(chunk_unit, F.col("_aj_t")))
    m = u.filter((F.col("_aj_kind") == 1) & F.col("_aj_iv").isNotNull()).select(
        *[F.col(of_iv[f.name]).cast(f.dataType).alias(f.name) if f.name in of_iv else F.col(f"_aj_iv.{f.name}") for f in intervals.schema],
        *[F.col(of_pt[f.name]).cast(f.dataType).alias(f.name) if f.name in of_pt else F.col(f"_pt.{f.name}") for f in points.schema])
    lo = F.col(point) >= F.col(start) if lower_inclusive else F.col(point) > F.col(start)
    hi = F.col(point) <= F.col(end) if upper_inclusive else F.col(point) < F.col(end)
    return m.filter(lo & hi)


def containing_join(intervals: DataFrame, points: DataFrame, keys: Sequence[tuple[str, str]],
                    start: str, end: str, point: str, tie: Sequence[str], chunk_unit: str = "day") -> DataFrame:
    """Inner join of points to the closed intervals [start, end] of their key that contain them.

    For intervals that mostly tile: each usually ends at or before the key's next start.

    * Those take the as-of join, in which nothing is copied. A point on an instant where one interval ends
      and the next starts lies in both, so interval ends that equal the next start join the points by
      equality instead.
    * An interval reaching beyond the next start takes ``range_join``: only these are copied, at most twice.

    ``start`` and ``end`` are timestamps, ``end`` non-null; (key, start, tie) identifies an interval.
    """
    ikeys = [a for a, _ in keys]
    icols, out = intervals.columns, intervals.columns + points.columns
    iv = shifted(intervals.filter(F.col(start).isNotNull()), ikeys, [start, *tie], start, "_next",
                 chunk=F.date_trunc(chunk_unit, F.col(start)))
    beyond = F.col("_next").isNotNull() & (F.col(end) > F.col("_next"))
    touches = F.coalesce(F.col(end) == F.col("_next"), F.lit(False))
    tiling = iv.filter(~beyond)
    main = asof_join(tiling, points, keys, start, end, point, tie=tie, chunk_unit=chunk_unit) \
        .filter(~(touches & (F.col(point) == F.col(end)))).select(*out)
    edge = tiling.filter(touches)
    on_edge = edge.join(points, [edge[a] == points[b] for a, b in keys] + [edge[end] == points[point]]).select(*out)
    over = range_join(iv.filter(beyond).select(*icols), points, keys, start, end, point).select(*out)
    return main.unionByName(on_edge).unionByName(over)
