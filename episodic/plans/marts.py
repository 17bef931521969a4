"""Done-month marts (K29, K30, M1-M7; I8, I27, B16, B17).

Stand-in of the rounds (K29, K30): a delivered session is a lineitem with return
flag 'N'; its student is the order's customer, its teacher the supplier, and
``per_done_month = round(quantity/30, 3)`` as an exact decimal.

The marts (M1-M7) stand on the event log, whose payments and pauses activate and
end a lecture as in K1: "active" counts the sessions from the last activation to
the next pause and restarts at a payment after a pause; "total" counts all.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from episodic.operators.incremental import high_water_mark, insert_absent, upsert
from episodic.operators.resets import SESSION, START, STOP, Batch, Log, State
from episodic.operators.sinks import materialize
from episodic.plans.registry import register, ts

CUT = "2000-01-01 00:00:00"
CUT_LOG = "2024-01-18 12:00:00"
DEC = "decimal(38,3)"


def done_sessions(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = t.lineitem.filter(F.col("l_returnflag") == "N")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity",
        F.col("o_custkey").alias("student"), F.col("l_suppkey").alias("teacher"), "o_orderdate",
        F.round((F.col("l_quantity") / 30.0).cast("decimal(38,10)"), 3).cast(DEC).alias("per_done_month"))


_DONE_SQL = """done AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_extendedprice, l.l_quantity,
         o.o_custkey AS student, l.l_suppkey AS teacher, o.o_orderdate,
         CAST(ROUND(CAST(l.l_quantity / 30.0 AS DECIMAL(38,10)), 3) AS DECIMAL(38,3)) AS per_done_month
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  WHERE l.l_returnflag = 'N'
)"""
_SKEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]


@register("round_done", "K29: D1,I27,B16", "WITH " + _DONE_SQL + f""",
target AS (SELECT *, 'target' AS origin FROM done WHERE l_shipdate < TIMESTAMP '{CUT}')
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, student, teacher,
       CAST(per_done_month AS DOUBLE) AS per_done_month, origin
FROM (
  SELECT * FROM target
  UNION ALL
  SELECT d.*, 'new' FROM done d
  WHERE NOT EXISTS (SELECT 1 FROM target x WHERE x.l_orderkey = d.l_orderkey AND x.l_linenumber = d.l_linenumber
                    AND x.l_partkey = d.l_partkey AND x.l_suppkey = d.l_suppkey AND x.l_shipdate = d.l_shipdate
                    AND x.l_extendedprice = d.l_extendedprice AND x.l_quantity = d.l_quantity)
) u
""")
def q_round_done(spark, t):
    """Delivered rounds with rounded done months; insert-only against the stored table."""
    done = materialize(done_sessions(t), "done_sessions")       # one join; source and stored target both read it
    target = done.filter(F.col("l_shipdate") < ts(CUT)).withColumn("origin", F.lit("target"))
    res = insert_absent(target, done.withColumn("origin", F.lit("new")), _SKEY)
    return res.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "student", "teacher",
                      F.col("per_done_month").cast("double").alias("per_done_month"), "origin")


@register("pair_done", "K30: E1,I8,B17", "WITH " + _DONE_SQL + f""",
pairs AS (
  SELECT student, teacher, CAST(student AS VARCHAR) || CAST(teacher AS VARCHAR) AS pair_text,
         SUM(per_done_month) AS done_month, MAX(l_shipdate) AS max_update
  FROM done GROUP BY student, teacher
), target AS (
  SELECT student, teacher, CAST(student AS VARCHAR) || CAST(teacher AS VARCHAR) AS pair_text,
         SUM(per_done_month) AS done_month, MAX(l_shipdate) AS max_update
  FROM done WHERE l_shipdate < TIMESTAMP '{CUT}' GROUP BY student, teacher
), changed AS (SELECT * FROM pairs WHERE max_update >= (SELECT MAX(max_update) FROM target))
SELECT student, teacher, pair_text, CAST(done_month AS DOUBLE) AS done_month, max_update FROM (
  SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM changed c WHERE c.student = t.student AND c.teacher = t.teacher)
  UNION ALL SELECT * FROM changed) u
""")
def q_pair_done(spark, t):
    """Done months per (student, teacher), merged on the two key columns (the separator-free text key
    '1'||'23' = '12'||'3' collides, so it is only an output column)."""
    done = materialize(done_sessions(t), "done_sessions")

    def pairs(df):
        return df.groupBy("student", "teacher").agg(F.sum("per_done_month").alias("done_month"),
                                                    F.max("l_shipdate").alias("max_update")) \
            .withColumn("pair_text", F.concat(F.col("student").cast("string"), F.col("teacher").cast("string")))
    target = materialize(pairs(done.filter(F.col("l_shipdate") < ts(CUT))), "pair_done")      # the stored table
    hwm = high_water_mark(target, "max_update")
    changed = pairs(done).filter(F.col("max_update") >= F.lit(hwm).cast("timestamp_ntz"))
    res = upsert(target, changed, ["student", "teacher"])
    return res.select("student", "teacher", "pair_text", F.col("done_month").cast("double").alias("done_month"),
                      "max_update")


# ---------------------------------------------------------------- marts built on activations

def lecture_log(ev) -> Log:
    """Payments, pauses and sessions of the event log; a session's teacher is k % 3, a student has three lectures."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.when(F.col("event_type") == "error", STOP).when(F.col("event_type") == "purchase", START).otherwise(SESSION)
    session = F.col("event_type") == "view"
    rows = ev.filter(F.col("event_type").isin("purchase", "error", "view")).select(
        F.col("user_id").alias("lecture_vt_no"), F.when(session, k % 3).alias("teacher"), "ts", kind.alias("kind"), "event_id",
        F.when(session, F.col("value").cast("decimal(18,2)")).alias("per_done_month"))
    return Log(rows, "lecture_vt_no", "teacher", "ts", "kind", "event_id", "per_done_month")


def _before(ev, cut: str):
    return ev.filter(F.col("ts") < ts(cut))


def _stored(first: Batch) -> State:
    """The state an earlier run stored."""
    state = first.advance()
    return State(materialize(state.lectures, "lecture_open"), materialize(state.sums, "lecture_done"))


_LOG_SQL = """
WITH marks AS (
  SELECT user_id AS lecture_vt_no, ts, CASE event_type WHEN 'purchase' THEN 1 ELSE 0 END AS kind, event_id
  FROM events WHERE event_type IN ('purchase', 'error')
), placed AS (
  SELECT *, LAG(kind) OVER (PARTITION BY lecture_vt_no ORDER BY ts, kind, event_id) AS before FROM marks
), act AS (
  SELECT a.lecture_vt_no, a.ts AS activated, MIN(s.ts) AS ended
  FROM (SELECT DISTINCT lecture_vt_no, ts FROM placed WHERE kind = 1 AND COALESCE(before, 0) = 0) a
    LEFT JOIN marks s ON s.lecture_vt_no = a.lecture_vt_no AND s.kind = 0 AND s.ts > a.ts
  GROUP BY 1, 2
), sess AS (
  SELECT user_id AS lecture_vt_no, CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS teacher, ts, event_id,
         CAST(value AS DECIMAL(18,2)) AS v
  FROM events WHERE event_type = 'view'
), latest AS (
  SELECT * FROM act QUALIFY ROW_NUMBER() OVER (PARTITION BY lecture_vt_no ORDER BY activated DESC) = 1
)"""


@register("lecture_done_running", "M7: sums that restart on re-payment", _LOG_SQL + """,
since AS (
  SELECT s.*, (SELECT MAX(a.activated) FROM act a WHERE a.lecture_vt_no = s.lecture_vt_no AND a.activated <= s.ts) AS activated FROM sess s
), counted AS (
  SELECT s.*, CASE WHEN s.ts <= COALESCE(a.ended, TIMESTAMP '9999-01-01 00:00:00')
    OR EXISTS (SELECT 1 FROM marks m WHERE m.lecture_vt_no = s.lecture_vt_no AND m.kind = 0 AND m.ts = s.ts) THEN s.v ELSE 0 END AS inside
  FROM since s LEFT JOIN act a ON a.lecture_vt_no = s.lecture_vt_no AND a.activated = s.activated
)
SELECT lecture_vt_no, teacher, event_id AS schedule_no, ts AS tutoring_datetime,
  CAST(SUM(CASE WHEN activated IS NULL THEN 0 ELSE inside END) OVER (
    PARTITION BY lecture_vt_no, teacher, activated ORDER BY ts, event_id) AS DOUBLE) AS active_done_month,
  CAST(SUM(v) OVER (PARTITION BY lecture_vt_no, teacher ORDER BY ts, event_id) AS DOUBLE) AS total_done_month
FROM counted
""")
def q_lecture_done_running(spark, t):
    """Active and total done months after every session, in two batches: the second continues from the first's state."""
    first = Batch(lecture_log(_before(t.events, CUT_LOG)))
    second = Batch(lecture_log(t.events.filter(F.col("ts") >= ts(CUT_LOG))), _stored(first))
    both = first.running().unionByName(second.running())
    return both.select("lecture_vt_no", "teacher", F.col("event_id").alias("schedule_no"), F.col("ts").alias("tutoring_datetime"),
                       F.col("active_done").cast("double").alias("active_done_month"), F.col("total_done").cast("double").alias("total_done_month"))


def lecture_teacher(t, incremental: bool = False):
    """M1: per (lecture, teacher) active (since the last activation) and total done months, from the whole log or from a
    stored state and the log after it."""
    if incremental:
        delta = lecture_log(t.events.filter(F.col("ts") >= ts(CUT_LOG)))
        sums = Batch(delta, _stored(Batch(lecture_log(_before(t.events, CUT_LOG))))).advance().sums
    else:
        sums = Batch(lecture_log(t.events)).advance().sums
    return sums.select("lecture_vt_no", "teacher", F.floor(F.col("lecture_vt_no") / 3).alias("student"),
                       F.col("active").alias("active_dm"), F.col("total").alias("total_dm"))


_LT_SQL = _LOG_SQL + """,
lt AS (
  SELECT s.lecture_vt_no, s.teacher, CAST(floor(s.lecture_vt_no / 3) AS BIGINT) AS student,
         COALESCE(SUM(CASE WHEN s.ts >= l.activated AND (l.ended IS NULL OR s.ts <= l.ended) THEN s.v END), 0) AS active_dm, SUM(s.v) AS total_dm
  FROM sess s LEFT JOIN latest l ON l.lecture_vt_no = s.lecture_vt_no GROUP BY 1, 2, 3
), tut AS (
  SELECT lecture_vt_no, student, SUM(active_dm) AS active_dm, SUM(total_dm) AS total_dm FROM lt GROUP BY 1, 2
)"""


def _dbl(*cols):
    return [F.col(c).cast("double").alias(c) for c in cols]


@register("mart_lecture", "M1,M7", _LT_SQL + """
SELECT lecture_vt_no, teacher, student, CAST(active_dm AS DOUBLE) AS active_dm, CAST(total_dm AS DOUBLE) AS total_dm FROM lt
""")
def q_mart_lecture(spark, t):
    return lecture_teacher(t, incremental=True).select("lecture_vt_no", "teacher", "student", *_dbl("active_dm", "total_dm"))


def tutoring(t):
    return lecture_teacher(t).groupBy("lecture_vt_no", "student").agg(F.sum("active_dm").alias("active_dm"),
                                                                       F.sum("total_dm").alias("total_dm"))


@register("mart_tutoring", "M2", _LT_SQL + """
SELECT lecture_vt_no, student, CAST(active_dm AS DOUBLE) AS active_dm, CAST(total_dm AS DOUBLE) AS total_dm FROM tut
""")
def q_mart_tutoring(spark, t):
    """M2: sum of M1 per lecture."""
    return tutoring(t).select("lecture_vt_no", "student", *_dbl("active_dm", "total_dm"))


@register("mart_student", "M3", _LT_SQL + """
SELECT student, CAST(SUM(active_dm) AS DOUBLE) AS active_dm, CAST(SUM(total_dm) AS DOUBLE) AS total_dm
FROM tut GROUP BY student
""")
def q_mart_student(spark, t):
    """M3: sum of M2 per student."""
    return tutoring(t).groupBy("student").agg(F.sum("active_dm").alias("active_dm"),
                                              F.sum("total_dm").alias("total_dm")) \
        .select("student", *_dbl("active_dm", "total_dm"))


@register("mart_main", "M4", _LT_SQL + """
SELECT student, CAST(MAX(active_dm) AS DOUBLE) AS main_active_dm, CAST(MAX(total_dm) AS DOUBLE) AS main_total_dm
FROM tut GROUP BY student
""")
def q_mart_main(spark, t):
    """M4: the student's main lecture = max of M2."""
    return tutoring(t).groupBy("student").agg(F.max("active_dm").alias("main_active_dm"),
                                              F.max("total_dm").alias("main_total_dm")) \
        .select("student", *_dbl("main_active_dm", "main_total_dm"))


@register("mart_teacher_student", "M5", _LT_SQL + """
SELECT student, teacher, CAST(SUM(active_dm) AS DOUBLE) AS active_dm, CAST(SUM(total_dm) AS DOUBLE) AS total_dm
FROM lt GROUP BY student, teacher
""")
def q_mart_teacher_student(spark, t):
    """M5: sum of M1 per (student, teacher)."""
    return teacher_student(t).select("student", "teacher", *_dbl("active_dm", "total_dm"))


def teacher_student(t):
    return lecture_teacher(t).groupBy("student", "teacher").agg(F.sum("active_dm").alias("active_dm"),
                                                                F.sum("total_dm").alias("total_dm"))


@register("mart_teacher", "M6,M5", _LT_SQL + """,
ts_pair AS (SELECT student, teacher, SUM(active_dm) AS active_dm, SUM(total_dm) AS total_dm FROM lt GROUP BY 1, 2)
SELECT teacher, CAST(COUNT(*) AS BIGINT) AS n_students, CAST(SUM(active_dm) AS DOUBLE) AS active_dm,
       CAST(SUM(total_dm) AS DOUBLE) AS total_dm
FROM ts_pair GROUP BY teacher
""")
def q_mart_teacher(spark, t):
    """M5 per (student, teacher), then M6 per teacher."""
    return teacher_student(t).groupBy("teacher").agg(F.count(F.lit(1)).alias("n_students"), F.sum("active_dm").alias("active_dm"),
                                       F.sum("total_dm").alias("total_dm")) \
        .select("teacher", "n_students", *_dbl("active_dm", "total_dm"))
