"""K1/K2/K3: episode tables built from payment and pause markers.

Stand-in (SURVEY 7.3): ``events`` per ``user_id`` (= lecture). ``purchase``
rows are payments (start markers), ``error`` rows are completed pause forms
(stop markers), ``view`` rows are sessions with ``value`` as done months.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from episodic.operators.buckets import BucketTable
from episodic.operators.incremental import carried_cumsum, high_water_mark, latest_per_key
from episodic.operators.intervals import episodes_with_points
from episodic.operators.sinks import materialize
from episodic.operators.windows import running_total
from episodic.plans.registry import AS_OF_EVENTS, register, ts
from episodic.session import scratch_path

ACTIVE_FROM = "2024-01-05 00:00:00"


def log_rows(ev: DataFrame, stop_filter=None) -> DataFrame:
    """Payments (start), pause forms (stop) and sessions (point) from one scan of the log."""
    m = ev.filter(F.col("event_type").isin("purchase", "error", "view"))
    if stop_filter is not None:
        m = stop_filter(m)
    kind = F.when(F.col("event_type") == "purchase", F.lit("start")).when(F.col("event_type") == "error", F.lit("stop"))
    return m.select(F.col("user_id").alias("lecture_vt_no"), "event_id", F.col("ts").alias("time_stamp"),
                    kind.otherwise(F.lit("point")).alias("kind"), F.col("value").cast("decimal(18,2)").alias("per_done_month"))


def group_lvt(ev: DataFrame, as_of: datetime = AS_OF_EVENTS, active_from: str = ACTIVE_FROM,
              stop_filter=None) -> DataFrame:
    """K1: episodes with their delivered sessions (D7 closed interval, open end -> as_of + 1 month), in one pass."""
    start = F.col("kind") == "start"
    eps = episodes_with_points(
        log_rows(ev, stop_filter), "lecture_vt_no", "time_stamp", "kind", ts(as_of) + F.expr("INTERVAL 1 MONTH"),
        F.date_trunc("day", F.col("time_stamp")),
        marker_stats={"min_payment_no": ("min", F.when(start, F.col("event_id"))),
                      "min_order_id": ("min", F.when(start, F.concat(F.lit("ord-"), F.col("event_id").cast("string"))))},
        point_stats={"max_session_update": ("max", F.col("time_stamp") + F.expr("INTERVAL 1 HOUR")),
                     "min_tutoring_datetime": ("min", F.col("time_stamp")), "min_schedule_no": ("min", F.col("event_id")),
                     "sum_done_month": ("sum", F.col("per_done_month")), "n_sessions": ("count", F.col("event_id"))})
    return eps.filter(F.col("active_timestamp") >= ts(active_from)).select(
        "lecture_vt_no",
        F.concat(F.col("lecture_vt_no").cast("string"), F.lit("_"), F.col("seq").cast("string")).alias("group_lecture_vt_no"),
        "seq", "active_timestamp", "done_timestamp", "min_payment_no", "min_order_id",
        F.greatest("marker_updated_at", "max_session_update").alias("updated_at"),
        "min_tutoring_datetime", "min_schedule_no", F.col("sum_done_month").cast("double").alias("done_month"),
        F.col("n_sessions").cast("bigint").alias("n_sessions"))


_K1_SQL_BODY = """
marks AS (
  SELECT user_id AS lecture_vt_no, event_id AS payment_no, 'ord-' || CAST(event_id AS VARCHAR) AS order_id,
         ts AS time_stamp, 'active' AS active_state
  FROM {events} WHERE event_type = 'purchase'
  UNION ALL
  SELECT user_id, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), ts, 'done'
  FROM {events} WHERE event_type = 'error' {stop_filter}
), numbered AS (
  SELECT *, SUM(CASE WHEN active_state = 'done' THEN 1 ELSE 0 END)
              OVER (PARTITION BY lecture_vt_no ORDER BY time_stamp) AS stops_le
  FROM marks
), eps AS (
  SELECT lecture_vt_no, seq,
         MIN(CASE WHEN active_state = 'active' THEN time_stamp END) AS active_timestamp,
         MAX(CASE WHEN active_state = 'done' THEN time_stamp END) AS done_timestamp,
         MAX(time_stamp) AS marker_updated_at,
         MIN(payment_no) AS min_payment_no, MIN(order_id) AS min_order_id
  FROM (SELECT *, CAST(CASE WHEN active_state = 'done' THEN stops_le ELSE stops_le + 1 END AS BIGINT) AS seq
        FROM numbered) x
  GROUP BY lecture_vt_no, seq
), sess AS (
  SELECT user_id, event_id AS schedule_no, ts AS tutoring_datetime, ts + INTERVAL 1 HOUR AS update_datetime,
         CAST(value AS DECIMAL(18,2)) AS per_done_month
  FROM {events} WHERE event_type = 'view'
), glvt AS (
  SELECT e.lecture_vt_no,
         CAST(e.lecture_vt_no AS VARCHAR) || '_' || CAST(e.seq AS VARCHAR) AS group_lecture_vt_no,
         e.seq, e.active_timestamp, e.done_timestamp, e.min_payment_no, e.min_order_id,
         CASE WHEN MAX(s.update_datetime) >= e.marker_updated_at THEN MAX(s.update_datetime)
              ELSE e.marker_updated_at END AS updated_at,
         MIN(s.tutoring_datetime) AS min_tutoring_datetime, MIN(s.schedule_no) AS min_schedule_no,
         CAST(SUM(s.per_done_month) AS DOUBLE) AS done_month, COUNT(s.schedule_no) AS n_sessions
  FROM eps e
  LEFT JOIN sess s ON s.user_id = e.lecture_vt_no AND s.tutoring_datetime >= e.active_timestamp
       AND s.tutoring_datetime <= COALESCE(e.done_timestamp, TIMESTAMP '2024-01-31 00:00:00' + INTERVAL 1 MONTH)
  WHERE e.active_timestamp >= TIMESTAMP '{active_from}'
  GROUP BY e.lecture_vt_no, e.seq, e.active_timestamp, e.done_timestamp, e.min_payment_no,
           e.min_order_id, e.marker_updated_at
)"""



def k1_sql(events: str = "events", stop_filter: str = "", active_from: str = ACTIVE_FROM) -> str:
    return "WITH " + _K1_SQL_BODY.format(events=events, stop_filter=stop_filter, active_from=active_from) + "\nSELECT * FROM glvt"


K1_SQL = k1_sql()


@register("episodes", "K1: H4,F7,E2,D7,E1,E12", K1_SQL)
def q_episodes(spark, t):
    return group_lvt(t.events)


CUT = "2024-01-20 00:00:00"


@register("episodes_incremental", "K1+A5+E10+G1", f"""
WITH stored AS ({k1_sql(f"(SELECT * FROM events WHERE ts < TIMESTAMP '{CUT}')")}),
fresh AS ({k1_sql()}),
unioned AS (
  SELECT *, 0 AS batch FROM stored
  UNION ALL
  SELECT *, 1 AS batch FROM fresh WHERE updated_at >= (SELECT MAX(updated_at) FROM stored)
)
SELECT * EXCLUDE (batch, rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY group_lecture_vt_no
                               ORDER BY updated_at DESC NULLS LAST, batch DESC) AS rn
  FROM unioned) x
WHERE rn = 1
""")
def q_episodes_incremental(spark, t):
    """Stored episode table from an earlier run, refreshed with the episodes
    updated at or after its high-water mark (inclusive scan, G1 dedupe)."""
    stored = materialize(group_lvt(t.events.filter(F.col("ts") < ts(CUT))), "group_lvt")
    hwm = high_water_mark(stored, "updated_at")
    fresh = group_lvt(t.events).filter(F.col("updated_at") >= F.lit(hwm).cast("timestamp_ntz"))
    both = stored.withColumn("batch", F.lit(0)).unionByName(fresh.withColumn("batch", F.lit(1)))
    return latest_per_key(both, ["group_lecture_vt_no"],
                          [F.col("updated_at").desc_nulls_last(), F.col("batch").desc()]).drop("batch")


def _pause_detail(ev: DataFrame) -> DataFrame:
    """Stand-in for the second pause table: one row per pause form with its decision."""
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.filter(F.col("event_type") == "error").select(
        F.col("event_id").alias("form_no"),
        F.when(k % 2 == 0, F.lit("stop")).otherwise(F.lit("resume")).alias("resume_left_lecture"))


@register("episodes_two_condition", "K2: K1 + D1 on the pause decision", k1_sql(
    stop_filter="AND event_id IN (SELECT event_id FROM events WHERE event_type = 'error' "
                "AND CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0)"))
def q_episodes_two_condition(spark, t):
    """K2: a pause closes an episode only when its detail row says 'stop'."""
    detail = _pause_detail(t.events).filter(F.col("resume_left_lecture") == "stop")

    def stop_filter(m):
        j = m.join(detail, m["event_id"] == detail["form_no"], "left")
        return j.filter((F.col("event_type") != "error") | F.col("form_no").isNotNull()).drop(*detail.columns)
    return group_lvt(t.events, stop_filter=stop_filter)


def _views(ev: DataFrame) -> DataFrame:
    return ev.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("schedule_no"), F.col("user_id").alias("lecture_vt_no"),
        F.col("ts").alias("tutoring_datetime"),
        F.col("value").cast("decimal(18,2)").alias("per_done_month"))


_K3_SQL = f"""
WITH v AS (
  SELECT event_id AS schedule_no, user_id AS lecture_vt_no, ts AS tutoring_datetime,
         CAST(value AS DECIMAL(18,2)) AS per_done_month
  FROM events WHERE event_type = 'view'
), stored AS (
  SELECT *, SUM(per_done_month) OVER (PARTITION BY lecture_vt_no ORDER BY tutoring_datetime) AS sum_done_month
  FROM v WHERE tutoring_datetime < TIMESTAMP '{CUT}'
), base AS (
  SELECT lecture_vt_no, MAX(sum_done_month) AS base FROM stored GROUP BY lecture_vt_no
), delta AS (
  SELECT v.*, COALESCE(b.base, 0)
         + SUM(v.per_done_month) OVER (PARTITION BY v.lecture_vt_no ORDER BY v.tutoring_datetime) AS sum_done_month
  FROM v LEFT JOIN base b ON b.lecture_vt_no = v.lecture_vt_no
  WHERE v.tutoring_datetime >= TIMESTAMP '{CUT}'
)"""


def _carried(t):
    v = _views(t.events)
    stored = materialize(running_total(v.filter(F.col("tutoring_datetime") < ts(CUT)), ["lecture_vt_no"],
                                       ["tutoring_datetime"], F.col("per_done_month"), "sum_done_month",
                                       chunk=F.date_trunc("day", "tutoring_datetime")), "voice_data")
    delta = v.filter(F.col("tutoring_datetime") >= ts(CUT))
    new = carried_cumsum(stored, delta, "lecture_vt_no", ["tutoring_datetime"], "per_done_month",
                         "sum_done_month", chunk=F.date_trunc("day", "tutoring_datetime"))
    return stored, new


def _carried_out(df):
    return df.select("schedule_no", "lecture_vt_no", "tutoring_datetime",
                     F.col("per_done_month").cast("double").alias("per_done_month"),
                     F.col("sum_done_month").cast("double").alias("sum_done_month"))


@register("carried_cumsum", "K3/G2: E11+F13+G1", _K3_SQL + """
SELECT schedule_no, lecture_vt_no, tutoring_datetime, CAST(per_done_month AS DOUBLE) AS per_done_month,
       CAST(sum_done_month AS DOUBLE) AS sum_done_month
FROM (SELECT * FROM stored UNION ALL SELECT * FROM delta) u
""")
def q_carried_cumsum(spark, t):
    """Cumulative done months per lecture kept in a stored table; new sessions
    continue from the stored maximum; the union is deduplicated by session."""
    stored, new = _carried(t)
    both = stored.withColumn("batch", F.lit(0)).unionByName(new.withColumn("batch", F.lit(1)))
    return _carried_out(latest_per_key(both, ["schedule_no"], [F.col("batch").desc()]))


@register("carried_base", "E11,F13,I34", _K3_SQL + """
SELECT schedule_no, lecture_vt_no, tutoring_datetime, CAST(per_done_month AS DOUBLE) AS per_done_month,
       CAST(sum_done_month AS DOUBLE) AS sum_done_month
FROM delta
""")
def q_carried_base(spark, t):
    """Only the new rows: group max of the stored cumulative (null -> 0) plus running sum."""
    return _carried_out(_carried(t)[1])


# ---------------------------------------------------------------- K3 voice data

ROOMS = ("1-URGENT", "2-HIGH", "3-MEDIUM")
VOICE = ("group_lecture_vt_no string, lecture_vt_no bigint, time_stamp timestamp_ntz, schedule_no bigint, room_id string, "
         "tutoring_datetime timestamp_ntz, per_done_month decimal(18,3), student_tokens bigint, sum_done_month decimal(28,3)")
VOICE_RUNS = ("1998-01-01 00:00:00", "2000-01-01 00:00:00", "2000-01-01 00:00:00")


def voice_run(t, table: BucketTable, visible_to: str, version: int, default: str = "1992-01-01 00:00:00") -> bool:
    """One run of the voice table over the rows that exist by ``visible_to``; False, and nothing written, without news.

    * rooms of the analysis join the cycles updated since the table's watermark (inclusive) on their trimmed id;
    * sessions are semi-joined to these cycles, pause forms since the watermark to their lectures;
    * sessions and pauses are numbered by the pauses of this run (a pause belongs to the episode it closes);
    * done months accumulate per episode from the stored maximum on; of each session the newest row stays, pauses have no
      session and go.
    """
    hwm = high_water_mark(table.read(), "time_stamp", default=default)
    since = F.lit(hwm).cast("timestamp_ntz")
    o = t.orders.filter(F.col("o_orderdate") < ts(visible_to))
    voice = o.filter(F.col("o_orderpriority").isin(*ROOMS)).select(
        F.concat(F.lit("r-"), F.col("o_orderkey").cast("string"), F.lit(" ")).alias("room"),
        F.floor("o_totalprice").alias("student_tokens")).select(F.trim("room").alias("room_id"), "student_tokens")
    lvc = o.filter(F.col("o_orderdate") >= since).select(
        F.col("o_orderkey").alias("cycle_no"), F.col("o_custkey").alias("lecture_vt_no"),
        F.concat(F.lit(" r-"), F.col("o_orderkey").cast("string")).alias("room"))
    # the cycles of this run are few beside all sessions, and three joins read them
    lvc = materialize(lvc.withColumn("room_id", F.trim("room")).drop("room").join(voice, "room_id"), "voice_cycles")
    sessions = t.lineitem.select(
        F.col("l_orderkey").alias("cycle_no"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("schedule_no"),
        F.col("l_shipdate").alias("tutoring_datetime"), (F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("time_stamp"),
        F.round((F.col("l_quantity") / 30.0).cast("decimal(38,10)"), 3).cast("decimal(18,3)").alias("per_done_month"))
    lvcs = sessions.join(lvc.select("cycle_no"), "cycle_no", "left_semi").join(lvc, "cycle_no").withColumn("done", F.lit(0))
    pauses = o.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderdate") >= since)).select(
        F.col("o_custkey").alias("lecture_vt_no"), F.col("o_orderdate").alias("time_stamp"), F.lit(1).alias("done")) \
        .join(lvc.select("lecture_vt_no"), "lecture_vt_no", "left_semi")
    both = materialize(lvcs.drop("cycle_no").unionByName(pauses, allowMissingColumns=True), "voice_delta")
    if both.isEmpty():
        return False
    year = F.date_trunc("year", "time_stamp")
    n = running_total(both, ["lecture_vt_no"], ["time_stamp"], F.col("done"), "_stops", chunk=year)
    n = n.withColumn("seq", F.col("_stops") + 1 - F.col("done")).withColumn("per_done_month", F.coalesce("per_done_month", F.lit(0).cast("decimal(18,3)")))
    n = n.withColumn("group_lecture_vt_no", F.concat_ws("_", F.col("lecture_vt_no").cast("string"), F.col("seq").cast("string")))
    fresh = carried_cumsum(table.read(), n, "group_lecture_vt_no", ["time_stamp", "schedule_no", "per_done_month"], "per_done_month",
                           "sum_done_month", chunk=year)

    def newest(stored, new):
        tagged = stored.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
        return latest_per_key(tagged, ["schedule_no"], [F.col(c).desc_nulls_last() for c in (
            "time_stamp", "_batch", "sum_done_month", "tutoring_datetime", "student_tokens", "group_lecture_vt_no")]).drop("_batch")

    table.merge(fresh.filter(F.col("schedule_no").isNotNull()), version, newest)
    return True


def _voice_sql() -> str:
    def run(i: int, hwm: str, to: str, base: str) -> str:
        return f"""
lvc{i} AS (SELECT o_orderkey, o_custkey, CAST(floor(o_totalprice) AS BIGINT) AS tokens FROM orders
  WHERE o_orderdate >= {hwm} AND o_orderdate < TIMESTAMP '{to}' AND o_orderpriority IN {ROOMS}),
list{i} AS (
  SELECT c.o_custkey AS lecture_vt_no, l.l_orderkey * 8 + l.l_linenumber AS schedule_no, 'r-' || CAST(l.l_orderkey AS VARCHAR) AS room_id,
    l.l_shipdate AS tutoring_datetime, l.l_shipdate + INTERVAL 1 DAY AS time_stamp,
    CAST(ROUND(CAST(l.l_quantity / 30.0 AS DECIMAL(38,10)), 3) AS DECIMAL(18,3)) AS per_done_month, c.tokens AS student_tokens, 0 AS done
  FROM lineitem l JOIN lvc{i} c ON c.o_orderkey = l.l_orderkey
  UNION ALL
  SELECT o_custkey, NULL, NULL, NULL, o_orderdate, NULL, NULL, 1 FROM orders
  WHERE o_orderstatus = 'P' AND o_orderdate >= {hwm} AND o_orderdate < TIMESTAMP '{to}' AND o_custkey IN (SELECT o_custkey FROM lvc{i})),
numbered{i} AS (
  SELECT * REPLACE (COALESCE(per_done_month, 0) AS per_done_month), CAST(lecture_vt_no AS VARCHAR) || '_' || CAST(
    SUM(done) OVER (PARTITION BY lecture_vt_no ORDER BY time_stamp) + 1 - done AS VARCHAR) AS group_lecture_vt_no FROM list{i}),
summed{i} AS (
  SELECT n.*, SUM(n.per_done_month) OVER (PARTITION BY n.group_lecture_vt_no ORDER BY n.time_stamp, n.schedule_no NULLS FIRST, n.per_done_month)
    + COALESCE(b.base, 0) AS sum_done_month, {i} AS batch
  FROM numbered{i} n LEFT JOIN ({base}) b ON b.group_lecture_vt_no = n.group_lecture_vt_no),
stored{i} AS (
  SELECT * FROM ({'' if i == 1 else f'SELECT * REPLACE (0 AS batch) FROM stored{i - 1} UNION ALL '}SELECT * FROM summed{i}) WHERE schedule_no IS NOT NULL
  QUALIFY ROW_NUMBER() OVER (PARTITION BY schedule_no ORDER BY time_stamp DESC, batch DESC, sum_done_month DESC, tutoring_datetime DESC,
    student_tokens DESC, group_lecture_vt_no DESC) = 1)"""
    first = run(1, "TIMESTAMP '1992-01-01 00:00:00'", VOICE_RUNS[0], "SELECT '' AS group_lecture_vt_no, 0 AS base")
    second = run(2, "(SELECT MAX(time_stamp) FROM stored1)", VOICE_RUNS[1],
                 "SELECT group_lecture_vt_no, MAX(sum_done_month) AS base FROM stored1 GROUP BY 1")
    return f"WITH {first},{second}" + """
SELECT group_lecture_vt_no, lecture_vt_no, time_stamp, schedule_no, room_id, tutoring_datetime, CAST(per_done_month AS DOUBLE) AS per_done_month,
  student_tokens, CAST(sum_done_month AS DOUBLE) AS sum_done_month
FROM stored2"""


@register("voice_data", "K3: D23,D14,H4,F7,A5,G2,G1,E11,F13", _voice_sql())
def q_voice_data(spark, t):
    """The voice table after three runs; the third finds no news and leaves the version of the second."""
    table = BucketTable(spark, scratch_path(spark, "voice_data"), StructType.fromDDL(VOICE), ("schedule_no",), 8)
    for version, to in enumerate(VOICE_RUNS):
        voice_run(t, table, to, version)
    return table.read().withColumns({c: F.col(c).cast("double") for c in ("per_done_month", "sum_done_month")})
