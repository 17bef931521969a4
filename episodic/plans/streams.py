"""Streaming re-aims J1-J4 run on the events table delivered in three files.

Each registered query stages ``events`` (whole table, split by time) into an
inbox one slice at a time and runs the streaming job once per slice with
``availableNow`` - the cron cadence of the reference - then returns the
resulting table. Slice 3 also carries rows from Jan 17-18 that arrive after
slice 2's Jan 19-20 rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from episodic.operators.buckets import BucketTable
from episodic.plans.registry import register, ts
from episodic.session import scratch_path
from episodic.streaming.jobs import changes, mirror, run_once, weekly

_SLICE_SQL = """CASE WHEN ts < TIMESTAMP '2024-01-11 00:00:00' THEN 0
            WHEN ts >= TIMESTAMP '2024-01-17 00:00:00' AND ts < TIMESTAMP '2024-01-19 00:00:00' THEN 2
            WHEN ts < TIMESTAMP '2024-01-21 00:00:00' THEN 1 ELSE 2 END"""


def _slice(ev, i):
    c = ev["ts"]
    late = (c >= ts("2024-01-17 00:00:00")) & (c < ts("2024-01-19 00:00:00"))
    if i == 0:
        return ev.filter(c < ts("2024-01-11 00:00:00"))
    if i == 1:
        return ev.filter((c >= ts("2024-01-11 00:00:00")) & (c < ts("2024-01-21 00:00:00")) & ~late)
    return ev.filter((c >= ts("2024-01-21 00:00:00")) | late)


def _drive(spark, t, start_query):
    """Stage the slices one by one; after each, run the query until the inbox is drained."""
    root = scratch_path(spark, "stream")
    ev = t.events
    for i in range(3):
        _slice(ev, i).write.mode("append").parquet(f"{root}/inbox")
        run_once(start_query(f"{root}/inbox", ev.schema, root))
    return root


def _order():
    return [F.col("ts").desc(), F.col("event_id").desc()]


@register("stream_mirror", "J1: A4,G1,B1 as foreachBatch", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x
WHERE rn = 1
""")
def q_stream_mirror(spark, t):
    """Newest event per user kept by a micro-batch mirror; equals the batch latest_per_key."""
    def target(r):
        return BucketTable(spark, f"{r}/target", t.events.schema, ("user_id",))
    return target(_drive(spark, t, lambda inbox, schema, r: mirror(
        spark, inbox, target(r), _order(), f"{r}/_checkpoint"))).read()


@register("stream_state_changes", "J2: G4 by keyed state", f"""
WITH ev AS (SELECT *, {_SLICE_SQL} AS b FROM events),
cur AS (
  SELECT b, user_id, event_type AS tutoring_state FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY b, user_id ORDER BY ts DESC, event_id DESC) AS rn FROM ev) x
  WHERE rn = 1
), cmp AS (
  SELECT c.*, (SELECT p.tutoring_state FROM cur p WHERE p.user_id = c.user_id AND p.b < c.b
               ORDER BY p.b DESC LIMIT 1) AS old_state,
         EXISTS (SELECT 1 FROM cur p WHERE p.user_id = c.user_id AND p.b < c.b) AS seen
  FROM cur c
)
SELECT user_id, tutoring_state, CAST(b AS BIGINT) AS batch_id FROM cmp
WHERE NOT seen OR tutoring_state IS DISTINCT FROM old_state
""")
def q_stream_state_changes(spark, t):
    """History of state changes appended by each run (run = micro-batch)."""
    root = _drive(spark, t, lambda inbox, schema, r: changes(
        spark, inbox, schema, "user_id", "event_type", ["ts", "event_id"], f"{r}/history", f"{r}/_checkpoint"))
    h = spark.read.parquet(f"{root}/history")
    return h.select("user_id", F.col("event_type").alias("tutoring_state"), F.col("batch_id").cast("bigint"))


@register("stream_weekly", "J3,J4: Monday weeks, late rows added to their week", """
SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, event_type, COUNT(*) AS n_rows
FROM events GROUP BY 1, 2
""")
def q_stream_weekly(spark, t):
    """Rows per (Monday week, type) from an event-time stream, late rows included."""
    from episodic.operators.sinks import read_latest
    from pyspark.sql.types import DateType, LongType, StructField, StructType
    root = _drive(spark, t, lambda inbox, schema, r: weekly(
        spark, inbox, schema, "ts", "event_type", f"{r}/target", f"{r}/_checkpoint"))
    schema = StructType([StructField("week_start", DateType()), t.events.schema["event_type"],
                         StructField("n_rows", LongType(), False)])
    return read_latest(spark, f"{root}/target", schema)
