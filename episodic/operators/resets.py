"""Running sums that start anew at each activation (M1, M7), continued from a stored state.

A lecture is active from an activation (the first start marker, or the first one after a stop) to the next stop, both
instants included. A session counts for the *active* sum if it lies in such a span, and the sum restarts from nothing at
every activation; the *total* sum never restarts. ``Batch.running`` gives both after every session of a batch,
``Batch.advance`` the state after it: per lecture whether it is open, per (lecture, part) the two sums. A batch continues from the state of the
batch before, so that any cutting of the log into batches (by time) gives the same sums.

All passes are chunked (see ``windows``): a lecture with most of the log is spread over its days, and a sum is of decimals,
so that its order does not matter.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodic.operators.sinks import materialize
from episodic.operators.windows import filled, running_total, shifted

STOP, START, SESSION = 0, 1, 2


@dataclass(frozen=True)
class State:
    """``lectures(key, mark, mark_at)``: each lecture's last marker; ``sums(key, part, active, total)``."""
    lectures: DataFrame
    sums: DataFrame


@dataclass(frozen=True)
class Log:
    """Columns of a log of markers and sessions: ``kind`` holds STOP, START or SESSION; ``id`` breaks ties."""
    rows: DataFrame
    key: str
    part: str
    ts: str
    kind: str
    id: str
    value: str

    @property
    def chunk(self) -> Column:
        return F.date_trunc("day", F.col(self.ts))


def empty_state(log: Log) -> State:
    s, spark = log.rows.schema, log.rows.sparkSession
    t = {c: s[c].dataType.simpleString() for c in (log.key, log.part, log.ts)}
    dec = log.rows.select(F.sum(log.value).alias("v")).schema["v"].dataType.simpleString()
    return State(spark.createDataFrame([], f"`{log.key}` {t[log.key]}, mark int, mark_at {t[log.ts]}"),
                 spark.createDataFrame([], f"`{log.key}` {t[log.key]}, `{log.part}` {t[log.part]}, active {dec}, total {dec}"))


class Batch:
    """One batch of a log after a stored state. The markers and the sessions' places are stored once and read by both results."""

    def __init__(self, log: Log, state: State | None = None):
        self.log, self.state = log, state or empty_state(log)
        self._order = [log.ts, log.kind, log.id]
        self._rows = log.rows.filter(F.col(log.key).isNotNull() & F.col(log.ts).isNotNull())

    @cached_property
    def marks(self) -> DataFrame:
        """The markers with ``reset``: 1 where an activation begins, that is, at a start after a stop or after no marker."""
        log = self.log
        rows = self._rows.filter(F.col(log.kind) < SESSION).select(log.key, *self._order)
        marks = shifted(rows, [log.key], self._order, log.kind, "_before", direction=-1, chunk=log.chunk)
        last = self.state.lectures.select(F.col(log.key).alias("_k"), F.col("mark").alias("_mark"))
        marks = marks.join(last, F.col(log.key) == F.col("_k"), "left")
        begins = (F.col(log.kind) == START) & (F.coalesce("_before", "_mark", F.lit(STOP)) == STOP)
        return materialize(marks.select(log.key, *self._order, begins.cast("int").alias("reset")), "log-marks")

    @cached_property
    def sessions(self) -> DataFrame:
        """The sessions with ``resets`` (activations of the batch at or before them) and ``counted`` (their value, 0 outside of an
        active span)."""
        log, schema = self.log, self._rows.schema
        marker = F.col(log.kind) < SESSION
        sessions = self._rows.filter(~marker).select(log.key, *self._order, F.lit(0).alias("reset"), log.part, log.value)
        marks = self.marks.select("*", *[F.lit(None).cast(schema[c].dataType).alias(c) for c in (log.part, log.value)])
        line = marks.unionByName(sessions).withColumn("_m", F.when(marker, F.struct(F.col(log.kind).alias("k"), F.col(log.ts).alias("t"))))
        line = running_total(line, [log.key], [log.ts], F.col("reset"), "resets", chunk=log.chunk)
        line = filled(line, [log.key], self._order, "_m", "_at", chunk=log.chunk).filter(~marker)
        last = self.state.lectures.select(F.col(log.key).alias("_k"), F.col("mark").alias("_mark"), F.col("mark_at").alias("_mark_at"))
        line = line.join(last, F.col(log.key) == F.col("_k"), "left")
        mark, at = F.coalesce("_at.k", "_mark"), F.coalesce("_at.t", "_mark_at")
        # a session on the instant of a stop still belongs to the span
        inside = F.coalesce((mark == START) | ((mark == STOP) & (at == F.col(log.ts))), F.lit(False))
        return materialize(line.select(log.key, log.part, log.ts, log.id, log.value, "resets", F.when(inside, F.col(log.value)).otherwise(
            F.lit(0).cast(schema[log.value].dataType)).alias("counted")), "log-sessions")

    def running(self) -> DataFrame:
        """Every session of the batch with its ``active_done`` and ``total_done``, the sums up to and with it."""
        log, sums = self.log, self.state.sums
        order = [log.ts, log.id]
        s = running_total(self.sessions, [log.key, log.part, "resets"], order, F.col("counted"), "_active", chunk=log.chunk)
        s = running_total(s, [log.key, log.part], order, F.col(log.value), "_total", chunk=log.chunk)
        base = sums.select(F.col(log.key).alias("_k"), F.col(log.part).alias("_p"), F.col("active").alias("_a0"), F.col("total").alias("_t0"))
        s = s.join(base, (F.col(log.key) == F.col("_k")) & F.col(log.part).eqNullSafe(F.col("_p")), "left")
        zero = F.lit(0).cast(sums.schema["active"].dataType)
        return s.select(
            log.key, log.part, log.id, log.ts, log.value,
            (F.col("_active") + F.when(F.col("resets") == 0, F.coalesce("_a0", zero)).otherwise(zero)).alias("active_done"),
            (F.col("_total") + F.coalesce("_t0", zero)).alias("total_done"))

    def advance(self) -> State:
        """The state after the batch."""
        log, sums = self.log, self.state.sums
        newest = self.marks.groupBy(log.key).agg(F.max(F.struct(log.ts, log.kind)).alias("m")) \
            .select(log.key, F.col(f"m.{log.kind}").cast("int").alias("mark"), F.col(f"m.{log.ts}").alias("mark_at"))
        lectures = self.state.lectures.join(newest.select(log.key), log.key, "left_anti").unionByName(newest)
        # a lecture with an activation in the batch has left its stored active sum behind, whether or not sessions follow
        began = self.marks.groupBy(log.key).agg(F.sum("reset").alias("began")).where("began > 0")
        zero = F.lit(0).cast(sums.schema["active"].dataType)
        fresh = self.sessions.join(began, log.key, "left").groupBy(log.key, log.part).agg(
            F.sum(F.when(F.col("resets") == F.coalesce("began", F.lit(0)), F.col("counted"))).alias("_a"), F.sum(log.value).alias("_t"))
        old = sums.join(began, log.key, "left").select(
            log.key, log.part, F.when(F.col("began").isNull(), F.col("active")).otherwise(zero).alias("active"), "total")
        both = old.unionByName(fresh.select(log.key, log.part, F.coalesce("_a", zero).alias("active"), F.coalesce("_t", zero).alias("total")))
        sums = both.groupBy(log.key, log.part).agg(*[F.sum(c).cast(sums.schema[c].dataType).alias(c) for c in ("active", "total")])
        return State(lectures, sums)
