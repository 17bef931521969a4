"""Feedback forms, flag lists and labels.

Stand-in form: every event carries a serialised form built from its row,
``{"k":"<k>","type":"<event_type>","at":"HH:mm:ss","k":"<2k>"}`` - a repeated
key and a value containing the key/value delimiter on purpose.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from episodic.operators.feedback import explode_pairs, pivot_slots
from episodic.operators.buckets import BucketTable
from episodic.operators.incremental import high_water_mark, latest_per_key, scan_since
from episodic.operators.sinks import conform, materialize
from episodic.operators.windows import shifted
from episodic.plans.episodes import group_lvt, k1_sql
from episodic.plans.registry import register, ts
from episodic.session import scratch_path
from episodic.sources.files import read_csv_worklist, write_csv_snapshot

def _k():
    return F.get_json_object("props", "$.k")


def forms(ev):
    body = F.concat(F.lit('{"k":"'), _k(), F.lit('","type":"'), F.col("event_type"), F.lit('","at":"'),
                    F.date_format("ts", "HH:mm:ss"), F.lit('","k":"'),
                    (_k().cast("int") * 2).cast("string"), F.lit('"}'))
    return ev.withColumn("body", body)


_FORMS_SQL = """forms AS (
  SELECT *, '{"k":"' || json_extract_string(props, '$.k') || '","type":"' || event_type || '","at":"'
            || strftime(ts, '%H:%M:%S') || '","k":"'
            || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) * 2 AS VARCHAR) || '"}' AS body
  FROM events
), parts AS (
  SELECT *, string_split(regexp_replace(body, '^\\s*\\{|\\}\\s*$', '', 'g'), '","') AS arr FROM forms
), pairs AS (
  SELECT event_id, user_id, ts, event_type, unnest(range(1, len(arr) + 1)) AS pair_no, unnest(arr) AS entry FROM parts
), kv AS (
  SELECT event_id, user_id, ts, event_type, pair_no,
         trim(translate(CASE WHEN strpos(entry, ':') > 0 THEN split_part(entry, ':', 1) ELSE entry END, '{}"', '')) AS key,
         trim(translate(CASE WHEN strpos(entry, ':') > 0 THEN substr(entry, strpos(entry, ':') + 1) END, '{}"', '')) AS value
  FROM pairs
)"""


@register("feedback_pairs", "I26,I14", "WITH " + _FORMS_SQL + """
SELECT event_id, pair_no, key, value FROM kv
""")
def q_feedback_pairs(spark, t):
    """split_to_multimap + UNNEST: one row per form entry, split at the first ':'."""
    return explode_pairs(forms(t.events), "body", keep=["event_id"])


_SLOTS = {"score": ["k"], "kind": ["type"], "answered_at": ["at"]}


@register("feedback_pivot", "E4,E5", "WITH " + _FORMS_SQL + """
SELECT user_id,
       MAX(CASE WHEN key IN ('k') THEN CAST(value AS INTEGER) END) AS score,
       MAX(CASE WHEN key IN ('type') THEN value END) AS kind,
       MAX(CASE WHEN key IN ('at') THEN value END) AS answered_at
FROM kv GROUP BY user_id
""")
def q_feedback_pivot(spark, t):
    """max(case when key in (...) then value end) per slot; the score slot is a strict int cast."""
    pairs = explode_pairs(forms(t.events), "body", keep=["user_id"])
    return pivot_slots(pairs, ["user_id"], "key", "value", _SLOTS, strict=True,
                       casts={"score": "int", "kind": None, "answered_at": None})


def _answers(li):
    """Five answers of a session survey, as text (some non-numeric)."""
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_linenumber") % 4).cast("string").alias("q1"),
        F.when(F.col("l_returnflag") == "R", "0").when(F.col("l_returnflag") == "A", "1").otherwise("x").alias("q2"),
        (F.col("l_quantity").cast("bigint") % 10).cast("string").alias("q3"),
        F.when(F.col("l_linestatus") == "O", "0").otherwise("5").alias("q4"),
        F.when(F.col("l_tax") == 0, "0").otherwise("n/a").alias("q5"))


@register("zero_item_list", "I9,I10,C8,I6", """
WITH a AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(l_linenumber % 4 AS VARCHAR) AS q1,
         CASE WHEN l_returnflag = 'R' THEN '0' WHEN l_returnflag = 'A' THEN '1' ELSE 'x' END AS q2,
         CAST(CAST(l_quantity AS BIGINT) % 10 AS VARCHAR) AS q3,
         CASE WHEN l_linestatus = 'O' THEN '0' ELSE '5' END AS q4,
         CASE WHEN l_tax = 0 THEN '0' ELSE 'n/a' END AS q5
  FROM lineitem
), z AS (
  SELECT *, COALESCE(TRY_CAST(q1 AS INTEGER) = 0, FALSE) AS z1, COALESCE(TRY_CAST(q2 AS INTEGER) = 0, FALSE) AS z2,
         COALESCE(TRY_CAST(q3 AS INTEGER) = 0, FALSE) AS z3, COALESCE(TRY_CAST(q4 AS INTEGER) = 0, FALSE) AS z4,
         COALESCE(TRY_CAST(q5 AS INTEGER) = 0, FALSE) AS z5
  FROM a
)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CAST(z1 AS INTEGER) + CAST(z2 AS INTEGER) + CAST(z3 AS INTEGER) + CAST(z4 AS INTEGER) + CAST(z5 AS INTEGER) AS BIGINT) AS n_zero,
       COALESCE(NULLIF(concat_ws(',', CASE WHEN z1 THEN 'q1' END, CASE WHEN z2 THEN 'q2' END, CASE WHEN z3 THEN 'q3' END,
                                 CASE WHEN z4 THEN 'q4' END, CASE WHEN z5 THEN 'q5' END), ''), 'none') AS zero_items
FROM z
WHERE z1 OR z2 OR z3 OR z4 OR z5
""")
def q_zero_item_list(spark, t):
    """Sessions with any zero answer (null-safe try_cast), how many and which."""
    a = _answers(t.lineitem)
    qs = ["q1", "q2", "q3", "q4", "q5"]
    z = {q: F.coalesce(F.expr(f"try_cast({q} AS INT)") == 0, F.lit(False)) for q in qs}
    a = a.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[z[q].alias("z_" + q) for q in qs])
    any_zero = F.exists(F.array(*[F.col("z_" + q) for q in qs]), lambda x: x)
    n_zero = sum((F.col("z_" + q).cast("int") for q in qs), F.lit(0)).cast("bigint")
    items = F.coalesce(F.nullif(F.concat_ws(",", *[F.when(F.col("z_" + q), F.lit(q)) for q in qs]), F.lit("")),
                       F.lit("none"))
    return a.filter(any_zero).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                     n_zero.alias("n_zero"), items.alias("zero_items"))


@register("sla_label", "I3,F1", """
WITH e AS (
  SELECT event_id, user_id, ts, event_type,
         LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts,
         LEAD(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type
  FROM events
)
SELECT event_id, user_id, CAST(date_sub('hour', ts, next_ts) AS BIGINT) AS hours,
       CASE WHEN event_type <> 'signup' THEN ''
            WHEN next_ts IS NULL THEN 'check'
            WHEN date_sub('hour', ts, next_ts) >= 24 THEN 'over'
            ELSE 'pass' END AS sla
FROM e WHERE event_type IN ('signup', 'view')
""")
def q_sla_label(spark, t):
    """Whole hours between a request and the next answer (truncated), labelled against 24 h."""
    e = shifted(t.events.select("event_id", "user_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"],
                "ts", "next_ts", direction=1, chunk=F.date_trunc("day", "ts"))
    hours = F.expr("timestampdiff(HOUR, ts, next_ts)")
    label = (F.when(F.col("event_type") != "signup", "")
             .when(F.col("next_ts").isNull(), "check")
             .when(hours >= 24, "over").otherwise("pass"))
    return e.filter(F.col("event_type").isin("signup", "view")).select(
        "event_id", "user_id", hours.cast("bigint").alias("hours"), label.alias("sla"))


NPS_CUT = "2024-01-20 00:00:00"
_NPS_SQL = """
WITH v AS (
  SELECT event_id AS schedule_no, user_id AS lecture_vt_no, ts AS tutoring_datetime, floor(user_id / 3) AS student,
    CASE WHEN k % 4 + 1 <= 3 THEN k % 3 END AS teacher
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_type = 'click')
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
), fbd AS (
  SELECT event_id, user_id AS lecture_vt_no, floor(user_id / 3) AS student, k % 3 AS teacher, ts AS created_at, event_id % 11 AS fst_nps
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) WHERE k % 4 + 1 = 1
), low AS (
  SELECT v.*, f.created_at, f.fst_nps, f.event_id,
    CAST(CAST(CAST(v.student AS BIGINT) AS VARCHAR) || CAST(v.teacher AS VARCHAR) AS BIGINT) AS student_teacher_no
  FROM v LEFT JOIN fbd f ON f.lecture_vt_no = v.lecture_vt_no AND f.student = v.student AND f.teacher = v.teacher WHERE f.fst_nps <= 6
)"""


@register("low_nps_first_session", "K24: F17,I26,I8,A5,E10,D3,G1,B1,B5", _NPS_SQL + f""",
first AS (SELECT * FROM low WHERE created_at < TIMESTAMP '{NPS_CUT}' QUALIFY ROW_NUMBER() OVER (PARTITION BY schedule_no ORDER BY created_at DESC, event_id DESC) = 1),
u AS (SELECT *, 0 AS batch FROM first UNION ALL SELECT *, 1 FROM low WHERE created_at >= (SELECT MAX(created_at) FROM first))
SELECT schedule_no, lecture_vt_no, tutoring_datetime, student_teacher_no, CAST(fst_nps AS INTEGER) AS fst_nps, created_at FROM u
QUALIFY ROW_NUMBER() OVER (PARTITION BY schedule_no ORDER BY created_at DESC, batch DESC, event_id DESC) = 1
""")
def q_low_nps_first_session(spark, t):
    """The stored list of low scores after two runs: the first finished session of every lecture, its feedback row (left), the
    scores of the first cycle's forms of that student and teacher (left, then 6 or less) from the list's watermark on; the
    newest row of each session stays. The table is published as CSV too and read back."""
    from episodic.plans.experience import SLOTS, surveys
    ev = t.events
    k = _k().cast("int")
    first = latest_per_key(ev.filter(F.col("event_type") == "click"), ["user_id"], [F.col("ts").asc(), F.col("event_id").asc()])
    v = first.select(F.col("event_id").alias("schedule_no"), F.col("user_id").alias("lecture_vt_no"), F.col("ts").alias("tutoring_datetime"),
                     F.floor(F.col("user_id") / 3).alias("student"), F.when(k % 4 + 1 <= 3, k % 3).alias("teacher"))
    pair = F.concat(F.col("student").cast("string"), F.col("teacher").cast("string")).cast("bigint")
    pairs = explode_pairs(surveys(ev).filter(F.col("cycle") == 1), "body", keep=["event_id", "f_user", "f_teacher", "f_ts"])
    fbd = pairs.filter(F.col("key").isin(SLOTS["score"])).select(
        F.col("f_user").alias("_u"), F.col("f_teacher").alias("_t"), F.col("f_ts").alias("created_at"),
        F.col("value").cast("int").alias("fst_nps"), F.col("event_id").alias("form_no"))
    low = v.join(fbd, (F.col("lecture_vt_no") == F.col("_u")) & (F.col("teacher") == F.col("_t")), "left").filter(F.col("fst_nps") <= 6) \
        .withColumn("student_teacher_no", pair)
    low = materialize(low, "low_scores")
    schema = StructType.fromDDL("schedule_no bigint, lecture_vt_no bigint, tutoring_datetime timestamp_ntz, student_teacher_no bigint, "
                                "fst_nps int, created_at timestamp_ntz, form_no bigint")
    table = BucketTable(spark, scratch_path(spark, "nps_7_under"), schema, ("schedule_no",), 8)

    def newest(stored, new):
        both = stored.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
        return latest_per_key(both, ["schedule_no"], [F.col(c).desc() for c in ("created_at", "_batch", "form_no")]).drop("_batch")

    for run, visible in enumerate((low.filter(F.col("created_at") < ts(NPS_CUT)), low)):
        hwm = high_water_mark(table.read(), "created_at", default="2019-01-01 00:00:00")
        table.merge(scan_since(visible, "created_at", hwm, inclusive=True), run, newest)
    path = scratch_path(spark, "nps_7_under_csv")
    write_csv_snapshot(table.read(), path)
    return conform(read_csv_worklist(spark, path), schema).drop("form_no")


COHORT_FROM = "2024-01-01 00:00:00"
SUBJECTS = ["BUILDING", "MACHINERY", "AUTOMOBILE"]


@register("first_feedback_cohort", "K23: F8,E5,I26,D11,D20,I33,C4,C3", (k1_sql(active_from=COHORT_FROM) + """,
forms1 AS (
  SELECT user_id AS lecture_vt_no, ts AS created_at, CAST(event_id % 11 AS INTEGER) AS score, CAST(k % 5 AS INTEGER) AS q1,
    CAST(event_id % 4 AS INTEGER) AS q3, CASE WHEN event_id % 7 <> 0 THEN CAST(event_id % 2 AS INTEGER) END AS q5
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) WHERE k % 4 + 1 = 1
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
), first_ep AS (
  SELECT * FROM (SELECT g.*, CAST(floor(lecture_vt_no / 3) AS BIGINT) AS student,
      DENSE_RANK() OVER (PARTITION BY floor(lecture_vt_no / 3) ORDER BY active_timestamp) AS dr
    FROM glvt g WHERE group_lecture_vt_no LIKE '%_1') WHERE dr = 1
)
SELECT e.lecture_vt_no, e.group_lecture_vt_no, e.student, c.c_mktsegment AS subject, n.n_name AS grade,
  CASE WHEN done_timestamp IS NOT NULL THEN 'done'
    WHEN CASE c.c_mktsegment WHEN 'BUILDING' THEN 'FINISH' WHEN 'MACHINERY' THEN 'REGISTER' ELSE 'STOPPED' END IN ('DONE', 'FINISH', 'AUTO_FINISH') THEN 'done'
    WHEN min_tutoring_datetime IS NULL AND c.c_mktsegment = 'MACHINERY' THEN 'active'
    WHEN min_tutoring_datetime IS NOT NULL THEN 'active' ELSE 'error' END AS active_state,
  done_month, active_timestamp, done_timestamp, f.created_at, f.score, f.q1, f.q3, f.q5
FROM first_ep e JOIN forms1 f ON f.lecture_vt_no = e.lecture_vt_no AND f.created_at BETWEEN e.active_timestamp AND e.updated_at
JOIN customer c ON c.c_custkey = e.lecture_vt_no AND c.c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')
JOIN nation n ON n.n_nationkey = c.c_nationkey AND n.n_name NOT LIKE '%_9'
""").replace("\nSELECT * FROM glvt,", ","))
def q_first_feedback_cohort(spark, t):
    """The first episode(s) of every student, among the groups that look like a lecture's first (``%_1``, where the sign in front
    of 1 is any), with the lecture's first form pivoted to integers, if it falls into the episode; subjects and grades from
    their names, the active state from a ladder."""
    from episodic.plans.experience import SLOTS, surveys
    g = group_lvt(t.events, active_from=COHORT_FROM).filter(F.col("group_lecture_vt_no").like("%_1")).withColumn("student", F.floor(F.col("lecture_vt_no") / 3))
    w = Window.partitionBy("student").orderBy("active_timestamp")
    first_ep = g.withColumn("dr", F.dense_rank().over(w)).filter(F.col("dr") == 1)
    f = latest_per_key(surveys(t.events).filter(F.col("cycle") == 1), ["f_user"], [F.col("f_ts").asc(), F.col("event_id").asc()])
    slots = {s: SLOTS[s] for s in ("score", "q1", "q3", "q5")}
    fb = pivot_slots(explode_pairs(f, "body", keep=["f_user", "f_ts"]), ["f_user", "f_ts"], "key", "value", slots, cast="int", strict=True)
    # a lecture has one first form and one such episode: an equality join, the interval is checked on its row
    j = first_ep.join(fb, (F.col("lecture_vt_no") == F.col("f_user")) & F.col("f_ts").between(F.col("active_timestamp"), F.col("updated_at")))
    c = t.customer.filter(F.col("c_mktsegment").isin(SUBJECTS)).select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("subject"))
    n = t.nation.filter(~F.col("n_name").like("%_9")).select("n_nationkey", F.col("n_name").alias("grade"))
    tutoring = F.when(F.col("subject") == "BUILDING", "FINISH").when(F.col("subject") == "MACHINERY", "REGISTER").otherwise("STOPPED")
    met = F.col("min_tutoring_datetime").isNotNull()
    state = F.when(F.col("done_timestamp").isNotNull(), "done").when(tutoring.isin("DONE", "FINISH", "AUTO_FINISH"), "done") \
        .when(~met & tutoring.isin("REGISTER", "REMATCH", "MATCHED", "REMATCH_B"), "active").when(met, "active").otherwise("error")
    return j.join(c, F.col("lecture_vt_no") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "lecture_vt_no", "group_lecture_vt_no", "student", "subject", "grade", state.alias("active_state"), "done_month", "active_timestamp",
        "done_timestamp", F.col("f_ts").alias("created_at"), *slots)
