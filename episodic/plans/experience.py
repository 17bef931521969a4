"""Experience sheets K14-K17 (events stand-in).

* episodes: K1 episodes per user, ``next_active`` = LEAD of the activation (F1)
* assignment: a ``signup`` inside an episode, half-open [active, next_active) (D5); its teacher is k % 3
* sessions: ``view``/``click`` of the assignment's lecture and teacher from the assignment on (D6, no upper bound); first four
  per assignment (F4), running count of finished ones (F5). A ``click`` is DONE, a ``view`` is reserved, contracted, running
  or cancelled by k % 4; the stage is a ladder over that count and the state (I1). A session ends one hour after it starts.
* feedback: a session belongs to feedback cycle k % 4 + 1 (cycles 1 to 3 exist); of the survey forms of one (lecture,
  teacher, cycle) the latest counts (F9), pivoted to ten slots (E4), joined on the three columns (D24) with a time residual in
  ON (D12); improvement and change wish fall down a ladder of slots (I2)
* matching time: first payment of the session's teacher strictly after the episode's activation (D9), falling back to the
  assignment time (I4); ticket: latest pause form of the lecture and teacher (F10); SLA label from the hours between (I3)
* names: students from ``customer``, teachers from ``supplier``; test accounts are left out, which makes the left join inner (D4)

Episodes tile the time line of a lecture (each ends at the next start), so assignments take the latest start at or before them
(as-of join), and matching times the next payment; no key pairs all of its rows and no interval is copied per day it spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodic.operators.feedback import explode_pairs, pivot_slots
from episodic.operators.incremental import latest_per_key
from episodic.operators.intervals import asof_join, with_next
from episodic.operators.sinks import materialize
from episodic.operators.windows import filled, first_rows, row_numbers
from episodic.plans.episodes import group_lvt, k1_sql
from episodic.plans.ranks import FAR_END
from episodic.plans.registry import AS_OF_EVENTS, register, ts

SINCE = "2024-01-08 00:00:00"        # assignments, sessions and matchings of the sheets
FINISHED_SINCE = "2024-01-10 00:00:00"
SUBMITTED_SINCE = "2024-01-12 00:00:00"
MATCHED_AGAIN = "2024-01-21 00:00:00"

# Labels of the sheets.
BEFORE_FIRST, ENDED, RUNNING, CANCELLED = "첫 수업 전", "종료", "수업 중", "취소"
DONE_LABEL = {1: "1회차 완료", 2: "2회차 완료", 3: "3회차 완료"}
BEFORE_LABEL = {1: "2회차 전", 2: "3회차 전"}
OVER, PASSED, TO_CHECK = "초과", "통과", "확인 필요"
NO_IMPROVEMENT, NO_CHANGE, NO_ITEM = "없음", "X", "해당 없음"
WISHES = ["yes", "yes_timechange"]
ZERO_ITEMS = {1: ["첫 수업 전 인사", "질문하는수업 약속", "질문하는 수업 진행", "학생 맞춤형 학습 계획 설정", "존중하는 태도"],
              2: ["수업 준비 태도", "질문하는 수업 진행", "선생님의 칭찬", "수업 마무리 정리", "존중하는 태도"]}
ZERO_ITEMS[3] = ZERO_ITEMS[2]
# Form keys of each slot, by feedback cycle.
SLOTS = {
    "q1": ["cycle01_01_hello", "cycle02_01_ready", "cycle03_01_ready"],
    "q2": ["cycle01_02_promise", "cycle02_02_question", "cycle03_02_question"],
    "q3": ["cycle01_03_question", "cycle02_03_compliment", "cycle03_03_compliment"],
    "q4": ["cycle01_04_monthlyplan", "cycle02_04_summary", "cycle03_04_summary"],
    "q5": ["cycle01_05_respect", "cycle02_05_respect", "cycle03_05_respect"],
    "score": ["cyMj2Q5EbCE2gOZPuvJs", "SbXI6fGKqJeuGagtJFqU", "9qiFkIjQ4ztJE5vyy0rY"],
    "neutral_improvement": ["V3m8LmkMKv265jK0gqGR", "CO6txyeWj4VL8EQIrkgd", "WuBLJuA2fRJPHxfp0W3i"],
    "neutral_change": ["cycle01_under_8_change_tutor", "cycle02_under_8_change_tutor", "cycle03_under_8_change_tutor"],
    "low_improvement": ["y6SQ8lSRfrrhzusiamMo", "dKuaT9i0aX76oV3wbr6C", "30y5Fl6sTpwI38EVY41g"],
    "low_change": ["cycle01_under_6_change_tutor", "cycle02_under_6_change_tutor", "cycle03_under_6_change_tutor"],
}


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _cycle() -> Column:
    return (_k() % 4 + 1).cast("bigint")


def surveys(ev: DataFrame) -> DataFrame:
    """Submitted survey forms: one serialised ``{"key":"value",...}`` per event of feedback cycles 1 to 3."""
    k, n = _k(), F.col("event_id")
    score = n % 11
    answers = {
        "q1": (k % 5).cast("string"), "q2": F.when(n % 6 == 0, F.lit("n/a")).otherwise((n % 3).cast("string")),
        "q3": (n % 4).cast("string"), "q4": F.when(k % 9 == 0, F.lit(" 0")).otherwise(F.lit("5")), "q5": F.when(n % 7 != 0, (n % 2).cast("string")),
        "score": score.cast("string"),
        "neutral_improvement": F.when(score.isin(7, 8), F.concat(F.lit("more: "), k.cast("string"))),
        "neutral_change": F.when(score.isin(7, 8), F.element_at(F.array(*map(F.lit, ("yes", "no", "yes_timechange"))), (n % 3 + 1).cast("int"))),
        "low_improvement": F.when(score <= 6, F.concat(F.lit("less "), k.cast("string"))),
        "low_change": F.when(score <= 6, F.element_at(F.array(*map(F.lit, ("yes", "no"))), (n % 2 + 1).cast("int")))}

    def key(slot):
        return F.element_at(F.array(*map(F.lit, SLOTS[slot])), _cycle().cast("int"))

    entries = [F.when(v.isNotNull(), F.concat(key(slot), F.lit('":"'), v)) for slot, v in answers.items()]
    return ev.filter(_cycle() <= 3).select(
        "event_id", F.col("user_id").alias("f_user"), (k % 3).alias("f_teacher"), _cycle().alias("cycle"), F.col("ts").alias("f_ts"),
        F.concat(F.lit('{"'), F.concat_ws('","', *entries), F.lit('"}')).alias("body"))


def _pivoted(f: DataFrame) -> DataFrame:
    keep = ["f_user", "f_teacher", "cycle", "f_ts"]
    return pivot_slots(explode_pairs(f, "body", keep=keep), keep, "key", "value", SLOTS)


def feedback(ev: DataFrame) -> DataFrame:
    """The latest form of every (lecture, teacher, cycle), one column a slot."""
    return _pivoted(latest_per_key(surveys(ev), ["f_user", "f_teacher", "cycle"], [F.col("f_ts").desc(), F.col("event_id").desc()]))


def stage(done: Column, state: Column) -> Column:
    """Ordered ladder over the finished sessions so far and the session's own state (first match wins)."""
    is_done, reserved = state == "DONE", state == "RESERVATION"
    out = F.when((done == 0) & state.isin("RESERVATION", "CONTRACT"), BEFORE_FIRST)
    for n in (1, 2, 3):
        out = out.when((done == n) & is_done, DONE_LABEL[n])
        if n in BEFORE_LABEL:
            out = out.when((done == n) & reserved, BEFORE_LABEL[n])
    return out.when((done == 3) & ~is_done, ENDED).when(done >= 4, ENDED).when(state == "TUTORING", RUNNING) \
        .when(state == "CANCEL", CANCELLED).otherwise(" ")


def sla(matched: Column, ticket: Column, state: Column) -> Column:
    """Whole hours from the matching to the ticket; without one of them, by the state."""
    hours = F.timestamp_diff("HOUR", matched, ticket)
    return F.when(hours >= 24, OVER).when(hours < 24, PASSED).when((state != "DONE") | state.isNull(), "").otherwise(TO_CHECK)


def improvement() -> Column:
    return F.coalesce("neutral_improvement", "low_improvement", F.lit(NO_IMPROVEMENT))


def change_wish() -> Column:
    return F.when(F.col("neutral_change").isin(WISHES), F.col("neutral_change")) \
        .when(F.col("low_change").isin(WISHES), F.col("low_change")).otherwise(NO_CHANGE)


def is_zero(q: str) -> Column:
    """Null-safe, and false for an answer that is no number."""
    return F.coalesce(F.trim(F.col(q)).try_cast("int") == 0, F.lit(False))


def sessions(ev: DataFrame) -> DataFrame:
    open_state = F.element_at(F.array(*map(F.lit, ("RESERVATION", "CONTRACT", "TUTORING", "CANCEL"))), _k() % 4 + 1)
    return ev.filter(F.col("event_type").isin("view", "click")).select(
        F.col("event_id").alias("session_id"), F.col("user_id").alias("s_user"), (_k() % 3).alias("s_teacher"),
        F.col("ts").alias("session_at"), (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("updated_at"),
        F.when(F.col("event_type") == "click", "DONE").otherwise(open_state).alias("state"),
        _cycle().alias("s_cycle"), F.col("value").alias("durations"))


def _episodes(ev: DataFrame, where: Column | None = None) -> DataFrame:
    """Episodes with the next activation, seen among those of ``where`` only (F2); stored once."""
    g = group_lvt(ev).select("lecture_vt_no", "group_lecture_vt_no", "seq", "active_timestamp")
    g = g if where is None else g.filter(where)
    eps = with_next(g, "lecture_vt_no", ["active_timestamp", "seq"], "active_timestamp", "next_active",
                    chunk=F.date_trunc("day", "active_timestamp"))
    return materialize(eps.withColumn("_eend", F.coalesce("next_active", ts(FAR_END))), "experience_episodes")


def _inside(eps: DataFrame, points: DataFrame, key: str, at: str) -> DataFrame:
    """Points inside an episode, half-open at the next activation."""
    hit = asof_join(eps, points, [("lecture_vt_no", key)], "active_timestamp", "_eend", at, tie=["seq"])
    return hit.filter(F.col("next_active").isNull() | (F.col(at) < F.col("next_active"))).drop("_eend")


def first_matches(eps: DataFrame, ev: DataFrame) -> DataFrame:
    """(episode, teacher, matched): the first payment of each teacher strictly after the episode's activation.

    Per (lecture, teacher) the next payment is carried back in time to every activation; no activation meets all payments."""
    pay = ev.filter(F.col("event_type") == "purchase").select(F.col("user_id").alias("u"), (_k() % 3).alias("tea"), F.col("ts").alias("at"))
    asked = eps.select(F.col("lecture_vt_no").alias("u"), F.explode(F.array(*map(F.lit, range(3)))).alias("tea"),
                       F.col("active_timestamp").alias("at"), "group_lecture_vt_no")
    back = -F.unix_micros(F.col("at").cast("timestamp"))
    line = pay.withColumn("group_lecture_vt_no", F.lit(None).cast("string")).withColumn("kind", F.lit(1)) \
        .unionByName(asked.withColumn("kind", F.lit(0))).withColumn("back", back) \
        .withColumn("paid", F.when(F.col("kind") == 1, F.col("at")))
    line = filled(line, ["u", "tea"], ["back", "kind"], "paid", "matched", chunk=F.floor(F.col("back") / 86_400_000_000))
    return line.filter((F.col("kind") == 0) & F.col("matched").isNotNull()).select(
        F.col("group_lecture_vt_no").alias("m_group"), F.col("tea").alias("m_teacher"), "matched")


def people(df: DataFrame, t) -> DataFrame:
    """Student and teacher names; rows of test accounts, or of no known student, go."""
    c = t.customer.select(F.col("c_custkey").alias("_c"), F.col("c_name").alias("student_name"), "c_mktsegment")
    s = t.supplier.select(F.col("s_suppkey").alias("_s"), F.col("s_name").alias("teacher_name"))
    real = c.filter(~F.col("student_name").like("%1_"))
    return df.join(real, F.col("lecture_vt_no") == F.col("_c")).join(s, F.col("teacher") + 1 == F.col("_s"), "left").drop("_c", "_s")


def experience_base(t, update_variant: bool = False, top_n: int = 4) -> DataFrame:
    ev = t.events
    eps = _episodes(ev)
    signups = ev.filter((F.col("event_type") == "signup") & (F.col("ts") >= ts(SINCE))).select(
        F.col("event_id").alias("assign_id"), F.col("user_id").alias("a_user"), F.col("ts").alias("assign_at"), (_k() % 3).alias("teacher"))
    # the assignment table is stored once: both parts of the session join read the copy
    assign = materialize(_inside(eps, signups, "a_user", "assign_at").drop("a_user"), "experience_assign")

    # The sessions of the same lecture and teacher from the assignment on, without an upper bound. Sessions are
    # numbered per (lecture, teacher); an assignment takes the last number before it, and its first sessions are
    # the next ``top_n`` numbers, so no assignment meets all sessions of its key.
    s = materialize(row_numbers(sessions(ev), ["s_user", "s_teacher"], ["session_at", "session_id"], "s_no",
                                chunk=F.date_trunc("day", "session_at")), "experience_sessions")
    none = F.lit(None).cast("bigint")
    line = s.select(F.col("s_user").alias("u"), F.col("s_teacher").alias("tea"), F.col("session_at").alias("at"),
                    F.lit(1).alias("kind"), F.col("session_id").alias("x"), "s_no", none.alias("a_id")) \
        .unionByName(assign.select(F.col("lecture_vt_no").alias("u"), F.col("teacher").alias("tea"), F.col("assign_at").alias("at"),
                                   F.lit(0).alias("kind"), F.col("assign_id").alias("x"), none.alias("s_no"),
                                   F.col("assign_id").alias("a_id")))
    last = F.coalesce("last_no", F.lit(0))
    before = filled(line, ["u", "tea"], ["at", "kind", "x"], "s_no", "last_no", chunk=F.date_trunc("day", "at")) \
        .filter(F.col("a_id").isNotNull()).select("a_id", F.explode(F.sequence(last + 1, last + top_n)).alias("want"), last.alias("last_no"))
    ranked = assign.join(before, assign["assign_id"] == before["a_id"]).drop("a_id")
    ranked = ranked.join(s, (F.col("lecture_vt_no") == F.col("s_user")) & (F.col("teacher") == F.col("s_teacher")) & (F.col("want") == F.col("s_no"))) \
        .withColumn("rn", (F.col("s_no") - F.col("last_no")).cast("bigint")).drop("s_user", "s_teacher", "s_no", "want", "last_no")
    w = Window.partitionBy("assign_id").orderBy("session_at", "session_id")
    ranked = ranked.withColumn("done_cnt", F.sum((F.col("state") == "DONE").cast("int")).over(w).cast("bigint"))
    # only finished sessions reach a sheet
    ranked = people(ranked.filter((F.col("state") == "DONE") & (F.col("session_at") >= ts(SINCE))), t)

    fb = feedback(ev)
    at = F.col("updated_at") if update_variant else F.col("session_at")
    base = ranked.join(fb, (ranked["lecture_vt_no"] == fb["f_user"]) & (ranked["teacher"] == fb["f_teacher"])
                       & (ranked["s_cycle"] == fb["cycle"]) & (fb["f_ts"] > at), "left").drop("f_user", "f_teacher", "cycle")
    m = first_matches(eps, ev).filter(F.col("matched") >= ts(SINCE))
    base = base.join(m, (base["group_lecture_vt_no"] == m["m_group"]) & (base["teacher"] == m["m_teacher"]), "left").drop("m_group", "m_teacher")
    tickets = ev.filter(F.col("event_type") == "error").groupBy(F.col("user_id").alias("t_user"), (_k() % 3).alias("t_teacher")) \
        .agg(F.max("ts").alias("ticket_at"))
    base = base.join(tickets, (F.col("lecture_vt_no") == F.col("t_user")) & (F.col("teacher") == F.col("t_teacher")), "left") \
        .drop("t_user", "t_teacher")
    return base.withColumn("stage", stage(F.col("done_cnt"), F.col("state"))).withColumn("matched_at", F.coalesce("matched", "assign_at")) \
        .withColumn("sla", sla(F.col("matched_at"), F.col("ticket_at"), F.col("state"))) \
        .withColumn("submitted_at", F.date_format("f_ts", "yyyy-MM-dd HH:mm:ss"))


_OUT = ["lecture_vt_no", "group_lecture_vt_no", "assign_id", "assign_at", "session_id", "session_at", "rn", "done_cnt", "stage",
        "student_name", "teacher_name", "matched_at", "submitted_at"]


def _base_sql(update_variant=False) -> str:
    at = "r.updated_at" if update_variant else "r.session_at"
    kk = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
    labels = "".join(f" WHEN done_cnt = {n} AND state = 'DONE' THEN '{DONE_LABEL[n]}'" + (
        f" WHEN done_cnt = {n} AND state = 'RESERVATION' THEN '{BEFORE_LABEL[n]}'" if n in BEFORE_LABEL else "") for n in (1, 2, 3))
    return (k1_sql() + f""",
epi AS (
  SELECT lecture_vt_no, group_lecture_vt_no, seq, active_timestamp,
         LEAD(active_timestamp) OVER (PARTITION BY lecture_vt_no ORDER BY active_timestamp, seq) AS next_active FROM glvt
), asg AS (
  SELECT e.*, s.event_id AS assign_id, s.ts AS assign_at, {kk} % 3 AS teacher FROM epi e JOIN events s ON s.user_id = e.lecture_vt_no
  AND s.event_type = 'signup' AND s.ts >= TIMESTAMP '{SINCE}' AND s.ts >= e.active_timestamp AND (e.next_active IS NULL OR s.ts < e.next_active)
), {_SESSIONS_SQL}, ranked AS (
  SELECT *, CAST(SUM(CASE WHEN state = 'DONE' THEN 1 ELSE 0 END) OVER (PARTITION BY assign_id ORDER BY session_at, session_id) AS BIGINT) AS done_cnt
  FROM (SELECT a.*, v.* EXCLUDE (s_user, s_teacher), CAST(ROW_NUMBER() OVER (PARTITION BY assign_id ORDER BY session_at, session_id) AS BIGINT) AS rn
        FROM asg a JOIN vs v ON v.s_user = a.lecture_vt_no AND v.s_teacher = a.teacher AND v.session_at >= a.assign_at) x WHERE rn <= 4
), {_FEEDBACK_SQL}, fb AS (
  SELECT * FROM fm QUALIFY ROW_NUMBER() OVER (PARTITION BY f_user, f_teacher, cycle ORDER BY f_ts DESC, event_id DESC) = 1
), matched AS (
  SELECT e.group_lecture_vt_no, {kk} % 3 AS tea, MIN(p.ts) AS matched FROM epi e JOIN events p ON p.user_id = e.lecture_vt_no
  AND p.event_type = 'purchase' AND p.ts > e.active_timestamp GROUP BY 1, 2 HAVING MIN(p.ts) >= TIMESTAMP '{SINCE}'
), tickets AS (SELECT user_id, {kk} % 3 AS tea, MAX(ts) AS ticket_at FROM events WHERE event_type = 'error' GROUP BY 1, 2
), base AS (
  SELECT r.*, fb.* EXCLUDE (event_id, f_user, f_teacher, cycle), c.c_name AS student_name, s.s_name AS teacher_name, m.matched,
    COALESCE(m.matched, r.assign_at) AS matched_at, t.ticket_at, strftime(fb.f_ts, '%Y-%m-%d %H:%M:%S') AS submitted_at,
    CASE WHEN done_cnt = 0 AND state IN ('RESERVATION', 'CONTRACT') THEN '{BEFORE_FIRST}'{labels}
      WHEN done_cnt = 3 AND state <> 'DONE' THEN '{ENDED}' WHEN done_cnt >= 4 THEN '{ENDED}' WHEN state = 'TUTORING' THEN '{RUNNING}'
      WHEN state = 'CANCEL' THEN '{CANCELLED}' ELSE ' ' END AS stage,
    CASE WHEN date_sub('hour', COALESCE(m.matched, r.assign_at), t.ticket_at) >= 24 THEN '{OVER}'
      WHEN date_sub('hour', COALESCE(m.matched, r.assign_at), t.ticket_at) < 24 THEN '{PASSED}'
      WHEN state <> 'DONE' OR state IS NULL THEN '' ELSE '{TO_CHECK}' END AS sla
  FROM ranked r JOIN customer c ON c.c_custkey = r.lecture_vt_no AND c.c_name NOT LIKE '%1_'
  LEFT JOIN supplier s ON s.s_suppkey = r.teacher + 1
  LEFT JOIN fb ON fb.f_user = r.lecture_vt_no AND fb.f_teacher = r.teacher AND fb.cycle = r.s_cycle AND fb.f_ts > {at}
  LEFT JOIN matched m ON m.group_lecture_vt_no = r.group_lecture_vt_no AND m.tea = r.teacher
  LEFT JOIN tickets t ON t.user_id = r.lecture_vt_no AND t.tea = r.teacher
  WHERE r.state = 'DONE' AND r.session_at >= TIMESTAMP '{SINCE}'
)""").replace("\nSELECT * FROM glvt,", ",")


_SESSIONS_SQL = """vs AS (
  SELECT event_id AS session_id, user_id AS s_user, CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS s_teacher, ts AS session_at,
    ts + INTERVAL 1 HOUR AS updated_at, CASE WHEN event_type = 'click' THEN 'DONE' ELSE CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 4
      WHEN 0 THEN 'RESERVATION' WHEN 1 THEN 'CONTRACT' WHEN 2 THEN 'TUTORING' ELSE 'CANCEL' END END AS state,
    CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 + 1 AS s_cycle, value AS durations
  FROM events WHERE event_type IN ('view', 'click')
)"""
_FEEDBACK_SQL = """fm AS (
  SELECT event_id, user_id AS f_user, k % 3 AS f_teacher, k % 4 + 1 AS cycle, ts AS f_ts, CAST(k % 5 AS VARCHAR) AS q1,
    CASE WHEN event_id % 6 = 0 THEN 'n/a' ELSE CAST(event_id % 3 AS VARCHAR) END AS q2, CAST(event_id % 4 AS VARCHAR) AS q3,
    CASE WHEN k % 9 = 0 THEN '0' ELSE '5' END AS q4, CASE WHEN event_id % 7 <> 0 THEN CAST(event_id % 2 AS VARCHAR) END AS q5,
    CAST(event_id % 11 AS VARCHAR) AS score, CASE WHEN event_id % 11 IN (7, 8) THEN 'more: ' || CAST(k AS VARCHAR) END AS neutral_improvement,
    CASE WHEN event_id % 11 IN (7, 8) THEN CASE event_id % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE 'yes_timechange' END END AS neutral_change,
    CASE WHEN event_id % 11 <= 6 THEN 'less ' || CAST(k AS VARCHAR) END AS low_improvement,
    CASE WHEN event_id % 11 <= 6 THEN CASE event_id % 2 WHEN 0 THEN 'yes' ELSE 'no' END END AS low_change
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) WHERE k % 4 + 1 <= 3
)"""
_WISH_SQL = (f"CASE WHEN neutral_change IN ('yes', 'yes_timechange') THEN neutral_change WHEN low_change IN ('yes', 'yes_timechange') "
             f"THEN low_change ELSE '{NO_CHANGE}' END")
_ZERO_SQL = " OR ".join(f"COALESCE(TRY_CAST({q} AS INTEGER) = 0, FALSE)" for q in ("q1", "q2", "q3", "q4", "q5"))


@register("experience_raw", "K14: F1,D5,D6,F4,F5,I1,I2,I3,D3,D4,D9,D12,D20,D24,F9,F10,I26,E4,I18,I20,I4,H1", _base_sql() + f"""
SELECT {', '.join(_OUT)}, score, q1, q2, q3, q4, q5, durations, sla,
  CASE WHEN neutral_improvement IS NOT NULL THEN neutral_improvement WHEN low_improvement IS NOT NULL THEN low_improvement
    ELSE '{NO_IMPROVEMENT}' END AS improvement, {_WISH_SQL} AS change_wish
FROM base WHERE matched_at >= TIMESTAMP '{SINCE}' AND updated_at >= TIMESTAMP '{FINISHED_SINCE}'""")
def q_experience_raw(spark, t):
    """Raw experience sheet: finished sessions among the first four of each assignment, with labels and answers."""
    b = experience_base(t).filter((F.col("matched_at") >= ts(SINCE)) & (F.col("updated_at") >= ts(FINISHED_SINCE)))
    return b.select(*_OUT, "score", "q1", "q2", "q3", "q4", "q5", "durations", "sla", improvement().alias("improvement"),
                    change_wish().alias("change_wish")).orderBy("session_at", "session_id", "assign_id")


@register("experience_monitoring", "K15: K14 + C8,I13,I18,D12(update)", _base_sql(update_variant=True) + f"""
SELECT {', '.join(_OUT)}, sla, 'https://replay.invalid/room/' || CAST(session_id AS VARCHAR) AS link
FROM base
WHERE ({_ZERO_SQL}) AND matched_at >= TIMESTAMP '{SINCE}' AND submitted_at >= '{SUBMITTED_SINCE}'""")
def q_experience_monitoring(spark, t):
    """Monitoring sheet: rows with any zero among the five answers since a cut (a string compare in a fixed format)."""
    zero = is_zero("q1") | is_zero("q2") | is_zero("q3") | is_zero("q4") | is_zero("q5")
    b = experience_base(t, update_variant=True).filter(zero & (F.col("matched_at") >= ts(SINCE)) & (F.col("submitted_at") >= SUBMITTED_SINCE))
    return b.select(*_OUT, "sla", F.concat(F.lit("https://replay.invalid/room/"), F.col("session_id").cast("string")).alias("link"))


def _items_sql(n: int) -> str:
    whens = ", ".join(f"CASE WHEN TRY_CAST(q{i + 1} AS INTEGER) = 0 THEN '{label}' END" for i, label in enumerate(ZERO_ITEMS[n]))
    return f"COALESCE(NULLIF(concat_ws(', ', {whens}), ''), '{NO_ITEM}')"


@register("experience_operation", "K16: K14 + E7,D13,I9,I10,C9", _base_sql(update_variant=True) + f""",
flagged AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup' AND CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 7),
b2 AS (
  SELECT b.* EXCLUDE (matched_at), CASE WHEN matched IS NOT NULL THEN matched WHEN f.user_id IS NOT NULL THEN assign_at END AS matched_at
  FROM base b LEFT JOIN flagged f ON f.user_id = b.lecture_vt_no AND b.matched IS NULL)
SELECT {', '.join(_OUT)}, TRY_CAST(score AS INTEGER) AS score_num, {_WISH_SQL} AS change_wish,
  CASE WHEN done_cnt IN (1, 2, 3) THEN CAST({' + '.join(f"CASE WHEN TRY_CAST(q{i} AS INTEGER) = 0 THEN 1 ELSE 0 END" for i in range(1, 6))} AS BIGINT)
    END AS n_zero,
  CASE done_cnt WHEN 1 THEN {_items_sql(1)} WHEN 2 THEN {_items_sql(2)} WHEN 3 THEN {_items_sql(3)} END AS zero_items
FROM b2
WHERE matched_at >= TIMESTAMP '{SINCE}' AND (TRY_CAST(score AS INTEGER) <= 7 OR {_ZERO_SQL} OR {_WISH_SQL} IN ('yes', 'yes_timechange'))""")
def q_experience_operation(spark, t):
    """Operation sheet: the matching time falls back to the assignment only for flagged lectures; counts and lists the zero
    items of each stage; keeps low scores, any zero item or a wish for change."""
    ev = t.events
    b = experience_base(t, update_variant=True)
    flagged = ev.filter((F.col("event_type") == "signup") & (_k() % 10 == 7)).select(F.col("user_id").alias("f_lecture")).distinct()
    b = b.join(flagged, (F.col("lecture_vt_no") == F.col("f_lecture")) & F.col("matched").isNull(), "left")
    b = b.withColumn("matched_at", F.coalesce("matched", F.when(F.col("f_lecture").isNotNull(), F.col("assign_at"))))
    qs = ["q1", "q2", "q3", "q4", "q5"]
    score, done = F.col("score").try_cast("int"), F.col("done_cnt")
    n_zero = sum((is_zero(q).cast("bigint") for q in qs), F.lit(0).cast("bigint"))

    def items(n):
        return F.coalesce(F.nullif(F.concat_ws(", ", *[F.when(is_zero(q), F.lit(x)) for q, x in zip(qs, ZERO_ITEMS[n])]), F.lit("")), F.lit(NO_ITEM))

    keep = F.coalesce(score <= 7, F.lit(False)) | (n_zero > 0) | change_wish().isin(WISHES)
    return b.filter((F.col("matched_at") >= ts(SINCE)) & keep).select(
        *_OUT, score.alias("score_num"), change_wish().alias("change_wish"), F.when(done.isin(1, 2, 3), n_zero).alias("n_zero"),
        F.when(done == 1, items(1)).when(done == 2, items(2)).when(done == 3, items(3)).alias("zero_items"))


@register("feedback_missing_list", "K17: F2,F6,D8,F11,E4,C11,C3", (k1_sql() + f""",
epi AS (
  SELECT lecture_vt_no, group_lecture_vt_no, active_timestamp,
         LEAD(active_timestamp) OVER (PARTITION BY lecture_vt_no ORDER BY active_timestamp, seq) AS next_active
  FROM glvt WHERE active_timestamp >= TIMESTAMP '{SINCE}' AND active_timestamp < TIMESTAMP '2024-01-25 00:00:00'
), {_SESSIONS_SQL}, sch AS (
  SELECT * FROM (
    SELECT e.group_lecture_vt_no, e.lecture_vt_no, v.* EXCLUDE (s_user),
      ROW_NUMBER() OVER (PARTITION BY e.lecture_vt_no ORDER BY v.session_at, v.session_id) AS rn,
      CAST(SUM(CASE WHEN v.state = 'DONE' THEN 1 ELSE 0 END) OVER (PARTITION BY e.lecture_vt_no ORDER BY v.session_at) AS BIGINT) AS done_cnt
    FROM epi e JOIN vs v ON v.s_user = e.lecture_vt_no AND e.active_timestamp <= v.session_at AND (e.next_active IS NULL OR v.session_at < e.next_active))
  WHERE rn <= 4
), {_FEEDBACK_SQL}, nps AS (
  SELECT DISTINCT f_user, f_teacher, cycle FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY f_user ORDER BY f_ts, event_id) AS frn FROM fm) WHERE frn <= 3
), first_match AS (
  SELECT e.group_lecture_vt_no, CAST(json_extract_string(p.props, '$.k') AS INTEGER) % 3 AS tea, MIN(p.ts) AS matched
  FROM epi e JOIN events p ON p.user_id = e.lecture_vt_no AND p.event_type = 'purchase' AND p.ts > e.active_timestamp GROUP BY 1, 2
)
SELECT sch.lecture_vt_no, sch.group_lecture_vt_no, session_id, session_at, c_name AS student_name, s_name AS teacher_name,
  CAST(done_cnt AS VARCHAR) AS session_no
FROM sch JOIN customer ON c_custkey = sch.lecture_vt_no AND c_name NOT LIKE '%1_' AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')
LEFT JOIN supplier ON s_suppkey = sch.s_teacher + 1
LEFT JOIN nps ON nps.f_user = sch.lecture_vt_no AND nps.f_teacher = sch.s_teacher AND nps.cycle = sch.s_cycle
LEFT JOIN first_match m ON m.group_lecture_vt_no = sch.group_lecture_vt_no AND m.tea = sch.s_teacher
WHERE (m.matched IS NULL OR m.matched < TIMESTAMP '{MATCHED_AGAIN}') AND state = 'DONE' AND done_cnt IN (1, 2, 3) AND nps.f_user IS NULL
  AND CAST(updated_at AS DATE) < DATE '2024-01-31' AND updated_at >= TIMESTAMP '{FINISHED_SINCE}'""").replace("\nSELECT * FROM glvt,", ","))
def q_feedback_missing_list(spark, t):
    """Episodes of a date range (cut before LEAD): among a lecture's first four sessions in them the first to third finished one,
    over before today, of an active lecture, whose cycle has none of the lecture's first three forms; lectures matched anew are
    excluded. The running count is over tied times (peers share it); rank() keeps every row it needs."""
    ev = t.events
    active = F.col("active_timestamp")
    eps = _episodes(ev, (active >= ts(SINCE)) & (active < ts("2024-01-25 00:00:00")))
    sch = _inside(eps, sessions(ev), "s_user", "session_at").withColumnRenamed("s_teacher", "teacher").drop("s_user")
    by_time = Window.partitionBy("lecture_vt_no").orderBy("session_at")
    sch = sch.withColumn("_rank", F.rank().over(by_time)).filter("_rank <= 4")
    sch = sch.withColumn("done_cnt", F.sum((F.col("state") == "DONE").cast("int")).over(by_time).cast("bigint"))
    sch = first_rows(sch, ["lecture_vt_no"], ["session_at", "session_id"], 4)
    sch = sch.filter((F.col("state") == "DONE") & F.col("done_cnt").isin(1, 2, 3) & (F.to_date("updated_at") < ts(AS_OF_EVENTS).cast("date"))
                     & (F.col("updated_at") >= ts(FINISHED_SINCE)))
    sch = people(sch, t).filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "AUTOMOBILE"))
    first3 = first_rows(surveys(ev), ["f_user"], ["f_ts", "event_id"], 3)
    nps = _pivoted(first3).select(F.col("f_user").alias("lecture_vt_no"), F.col("f_teacher").alias("teacher"), F.col("cycle").alias("s_cycle"))
    sch = sch.join(nps.distinct(), ["lecture_vt_no", "teacher", "s_cycle"], "left_anti")
    again = first_matches(eps, ev).filter(F.col("matched") >= ts(MATCHED_AGAIN))
    sch = sch.join(again, (F.col("group_lecture_vt_no") == F.col("m_group")) & (F.col("teacher") == F.col("m_teacher")), "left_anti")
    return sch.select("lecture_vt_no", "group_lecture_vt_no", "session_id", "session_at", "student_name", "teacher_name",
                      F.col("done_cnt").cast("string").alias("session_no"))
