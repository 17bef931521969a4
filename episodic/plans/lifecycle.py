"""Episode log, weekly actuals and retention curves on the orders stand-in.

Stand-in log: every order is an episode of lecture ``o_custkey`` starting on
its order day; plan months (cohort) come from the priority; closed orders end
``floor(totalprice) % 400`` days later, open ('O') orders are open episodes.
The run date is 1998-09-01, so the week is Mon 1998-08-31 .. Sun 1998-09-06.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from episodic.operators.lifecycle import (LOG_COLS, insert_new, renumber_episodes, run_counts, update_pause,
                                          weekly_actuals_for, weekly_counts)
from episodic.operators.sinks import materialize
from episodic.operators.windows import row_numbers
from episodic.operators.survival import (HORIZON_WEEKS, activate_version, compute_window, km_curve, replace_slice,
                                        should_retrain)
from episodic.plans.registry import register

RUN_DATE = date(1998, 9, 1)
STAMP = datetime(1998, 9, 1, 9, 0, 0)
WIN = compute_window(RUN_DATE)
WS, WE, FS, FE = WIN["week_start"], WIN["week_end"], WIN["fit_start"], WIN["fit_end"]

# Fixed plan-length mapping of the stand-in (priority -> months).
COHORT_OF_PRIORITY = {"1-URGENT": 1, "2-HIGH": 3, "3-MEDIUM": 6, "4-NOT SPECIFIED": 12, "5-LOW": 2}


def _cohort():
    c = None
    for k, v in COHORT_OF_PRIORITY.items():
        c = (F.when(F.col("o_orderpriority") == k, F.lit(v)) if c is None
             else c.when(F.col("o_orderpriority") == k, F.lit(v)))
    return c


def _base(orders):
    start = F.to_date("o_orderdate")
    days = (F.floor("o_totalprice") % 400).cast("int")
    return orders.select(
        F.col("o_custkey").alias("lecture_vt_no"), F.col("o_custkey").alias("student_user_no"),
        _cohort().cast("int").alias("fst_months"), start.alias("start_date"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("date")).otherwise(F.date_add(start, days))
        .alias("end_date"),
        F.col("o_orderstatus").alias("tutoring_state"), F.col("o_orderpriority").alias("grade"),
        F.col("o_orderkey").alias("src_order"), "o_totalprice", "o_orderstatus", "o_orderpriority")


def pre_log(orders):
    """The stored log before the run: one row per (lecture, start) from orders before the week."""
    b = _base(orders).filter(F.col("start_date") < F.lit(WS.isoformat()).cast("date"))
    w = Window.partitionBy("lecture_vt_no", "start_date").orderBy("src_order")
    b = b.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    b = row_numbers(b, ["lecture_vt_no"], ["start_date"], "episode_no", chunk=F.date_trunc("year", "start_date"))
    return b.select("lecture_vt_no", "episode_no", "student_user_no", "fst_months", "start_date",
                    "end_date", "tutoring_state", "grade",
                    F.col("start_date").cast("timestamp_ntz").alias("created_at"),
                    F.col("start_date").cast("timestamp_ntz").alias("updated_at"))


def new_lecture(orders):
    return _base(orders).select("lecture_vt_no", "student_user_no", "fst_months", "start_date",
                                "tutoring_state", "grade", "src_order")


def pause_lecture(orders):
    """Pause list: finished orders, paused ``floor(totalprice) % 60`` days after start; LOW has no state."""
    b = _base(orders).filter(F.col("o_orderstatus") == "F")
    return b.select("lecture_vt_no", F.date_add("start_date", (F.floor("o_totalprice") % 60).cast("int"))
                    .alias("end_date"),
                    F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
                    .otherwise(F.lit("paused")).alias("tutoring_state"))


def stored_log(t):
    """The pre-run log as the stored table it is in production (written once, read by every step)."""
    return materialize(pre_log(t.orders), "lvt_log")


def after_insert(t, log=None):
    return insert_new(stored_log(t) if log is None else log, new_lecture(t.orders), WS, WE, STAMP)


def after_pause(t, log=None):
    return update_pause(after_insert(t, log), pause_lecture(t.orders), WS, WE, STAMP)


# ---- oracle SQL: the same steps as CTEs -------------------------------------------------

_SQL_BASE = f"""
base AS (
  SELECT o_custkey AS lecture_vt_no, o_custkey AS student_user_no,
         CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 6
              WHEN '4-NOT SPECIFIED' THEN 12 WHEN '5-LOW' THEN 2 END AS fst_months,
         CAST(o_orderdate AS DATE) AS start_date,
         CASE WHEN o_orderstatus = 'O' THEN NULL
              ELSE CAST(CAST(o_orderdate AS DATE) + CAST(CAST(floor(o_totalprice) AS BIGINT) % 400 AS INTEGER) AS DATE) END AS end_date,
         o_orderstatus AS tutoring_state, o_orderpriority AS grade, o_orderkey AS src_order,
         o_totalprice, o_orderstatus, o_orderpriority
  FROM orders
), pre AS (
  SELECT lecture_vt_no, CAST(ROW_NUMBER() OVER (PARTITION BY lecture_vt_no ORDER BY start_date) AS BIGINT) AS episode_no,
         student_user_no, fst_months, start_date, end_date, tutoring_state, grade,
         CAST(start_date AS TIMESTAMP) AS created_at, CAST(start_date AS TIMESTAMP) AS updated_at
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY lecture_vt_no, start_date ORDER BY src_order) AS rn
        FROM base WHERE start_date < DATE '{WS}') x WHERE rn = 1
), src AS (
  SELECT lecture_vt_no, student_user_no, fst_months, start_date, COALESCE(tutoring_state, '') AS tutoring_state,
         grade, src_order
  FROM base WHERE start_date BETWEEN DATE '{WS}' AND DATE '{WE}'
), closed AS (
  SELECT l.*, (SELECT MIN(s.start_date) FROM src s WHERE s.lecture_vt_no = l.lecture_vt_no
                                                  AND s.start_date > l.start_date) AS next_start
  FROM pre l
), ins AS (
  SELECT s.lecture_vt_no,
         CAST(COALESCE((SELECT MAX(l.episode_no) FROM pre l WHERE l.lecture_vt_no = s.lecture_vt_no), 0) + 1 AS BIGINT) AS episode_no,
         s.student_user_no, s.fst_months, s.start_date, CAST(NULL AS DATE) AS end_date, s.tutoring_state, s.grade,
         TIMESTAMP '{STAMP}' AS created_at, TIMESTAMP '{STAMP}' AS updated_at
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY lecture_vt_no, start_date ORDER BY src_order) AS rn FROM src) s
  WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM pre l WHERE l.lecture_vt_no = s.lecture_vt_no AND l.start_date = s.start_date)
), log1 AS (
  SELECT lecture_vt_no, episode_no, student_user_no, fst_months, start_date,
         CASE WHEN end_date IS NULL AND next_start IS NOT NULL
              THEN GREATEST(start_date, CAST(next_start - INTERVAL 1 DAY AS DATE)) ELSE end_date END AS end_date,
         tutoring_state, grade, created_at,
         CASE WHEN end_date IS NULL AND next_start IS NOT NULL THEN TIMESTAMP '{STAMP}' ELSE updated_at END AS updated_at
  FROM closed
  UNION ALL SELECT * FROM ins
), psrc AS (
  SELECT lecture_vt_no, MAX({{'end_date': end_date, 'tutoring_state': tutoring_state}}) AS p FROM (
    SELECT lecture_vt_no, CAST(start_date + CAST(CAST(floor(o_totalprice) AS BIGINT) % 60 AS INTEGER) AS DATE) AS end_date,
           COALESCE(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'paused' END, '') AS tutoring_state
    FROM base WHERE o_orderstatus = 'F') y
  WHERE end_date BETWEEN DATE '{WS}' AND DATE '{WE}'
  GROUP BY lecture_vt_no
), log2 AS (
  SELECT l.lecture_vt_no, l.episode_no, l.student_user_no, l.fst_months, l.start_date,
         CASE WHEN l.end_date IS NULL AND p.p IS NOT NULL THEN GREATEST(p.p.end_date, l.start_date) ELSE l.end_date END AS end_date,
         CASE WHEN l.end_date IS NULL AND p.p IS NOT NULL THEN COALESCE(p.p.tutoring_state, l.tutoring_state)
              ELSE l.tutoring_state END AS tutoring_state,
         l.grade, l.created_at,
         CASE WHEN l.end_date IS NULL AND p.p IS NOT NULL THEN TIMESTAMP '{STAMP}' ELSE l.updated_at END AS updated_at
  FROM log1 l LEFT JOIN psrc p ON p.lecture_vt_no = l.lecture_vt_no
)"""

_LOG_SELECT = ", ".join(LOG_COLS)


@register("episode_log_insert", "K8: C5,B11,E13,B10,E9", f"WITH {_SQL_BASE}\nSELECT {_LOG_SELECT} FROM log1")
def q_episode_log_insert(spark, t):
    """New starts of the week: close earlier open episodes, insert (lecture, start) if absent."""
    return after_insert(t)


@register("episode_log_pause", "K9: B12,I21,E9", f"WITH {_SQL_BASE}\nSELECT {_LOG_SELECT} FROM log2")
def q_episode_log_pause(spark, t):
    """Pauses of the week close the lecture's open episode."""
    return after_pause(t)


@register("episode_run_counts", "K8,K9: E9", f"""WITH {_SQL_BASE}
SELECT CAST((SELECT COUNT(*) FROM src) AS BIGINT) AS source_rows,
       CAST((SELECT COUNT(*) FROM closed WHERE end_date IS NULL AND next_start IS NOT NULL) AS BIGINT) AS closed_rows,
       CAST((SELECT COUNT(*) FROM ins) AS BIGINT) AS inserted_new,
       CAST((SELECT COUNT(*) FROM log2 WHERE end_date BETWEEN DATE '{WS}' AND DATE '{WE}') AS BIGINT) AS updated_pause""")
def q_episode_run_counts(spark, t):
    """What the run reports: source rows, closed and inserted episodes, episodes ending in the week."""
    inserted = materialize(after_insert(t), "lvt_log_inserted")
    paused = update_pause(inserted, pause_lecture(t.orders), WS, WE, STAMP)
    return run_counts(new_lecture(t.orders), inserted, paused, WS, WE, STAMP)


@register("renumber_episodes", "K12: F14,B14,C7", f"""WITH {_SQL_BASE}, rn AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY lecture_vt_no
               ORDER BY start_date, COALESCE(end_date, DATE '2100-01-01')) AS BIGINT) AS new_no
  FROM log2
)
SELECT lecture_vt_no, new_no AS episode_no, student_user_no, fst_months, start_date, end_date, tutoring_state, grade,
       created_at, CASE WHEN episode_no IS DISTINCT FROM new_no THEN TIMESTAMP '{STAMP}' ELSE updated_at END AS updated_at,
       episode_no IS DISTINCT FROM new_no AS renumbered
FROM rn""")
def q_renumber_episodes(spark, t):
    return renumber_episodes(after_pause(t), STAMP, chunk=F.date_trunc("year", "start_date"))


@register("weekly_actuals", "K10: D18,D19,E3,B8,J3", f"""WITH {_SQL_BASE},
hist AS (
  SELECT week_start, cohort_months, new_actual, pause_actual FROM (
    SELECT w.week_start, c.cohort_months,
           CAST((SELECT COUNT(*) FROM pre l WHERE l.fst_months = c.cohort_months
                 AND CAST(date_trunc('week', l.start_date) AS DATE) = w.week_start) AS BIGINT) AS new_actual,
           CAST((SELECT COUNT(*) FROM pre l WHERE l.fst_months = c.cohort_months
                 AND CAST(date_trunc('week', l.end_date) AS DATE) = w.week_start) AS BIGINT) AS pause_actual
    FROM (SELECT DISTINCT CAST(date_trunc('week', start_date) AS DATE) AS week_start FROM pre
          UNION SELECT DISTINCT CAST(date_trunc('week', end_date) AS DATE) FROM pre WHERE end_date IS NOT NULL) w
    CROSS JOIN (SELECT UNNEST([1, 3, 6, 12]) AS cohort_months) c) x
), cur AS (
  SELECT DATE '{WS}' AS week_start, c.cohort_months,
         CAST(COALESCE(SUM(CASE WHEN l.start_date BETWEEN DATE '{WS}' AND DATE '{WE}' THEN 1 END), 0) AS BIGINT) AS new_actual,
         CAST(COALESCE(SUM(CASE WHEN l.end_date BETWEEN DATE '{WS}' AND DATE '{WE}' THEN 1 END), 0) AS BIGINT) AS pause_actual
  FROM (SELECT UNNEST([1, 3, 6, 12]) AS cohort_months) c LEFT JOIN log2 l ON l.fst_months = c.cohort_months
  GROUP BY c.cohort_months
)
SELECT week_start, CAST(cohort_months AS INTEGER) AS cohort_months, new_actual, pause_actual, 'history' AS source
FROM hist WHERE NOT EXISTS (SELECT 1 FROM cur WHERE cur.week_start = hist.week_start AND cur.cohort_months = hist.cohort_months)
UNION ALL
SELECT week_start, CAST(cohort_months AS INTEGER), new_actual, pause_actual, 'lvt_log' FROM cur""")
def q_weekly_actuals(spark, t):
    """History of weekly starts/ends per cohort, upserted with this week's row from the updated log."""
    log = stored_log(t)
    hist = weekly_counts(log).withColumn("source", F.lit("history"))
    cur = weekly_actuals_for(after_pause(t, log), WS, WE).withColumn("source", F.lit("lvt_log"))
    keys = ["week_start", "cohort_months"]
    return hist.join(cur.select(*keys), keys, "left_anti").unionByName(cur)


def _km_sql(log: str, fs: date, fe: date, as_of: date) -> str:
    return f"""
(WITH smp AS (
  SELECT fst_months AS cohort_months,
         CASE WHEN end_date IS NOT NULL AND end_date <= DATE '{as_of}' THEN 1 ELSE 0 END AS ev, start_date, end_date
  FROM {log} WHERE start_date BETWEEN DATE '{fs}' AND DATE '{fe}' AND fst_months IN (1, 3, 6, 12)
), obs AS (
  SELECT cohort_months, ev,
         GREATEST(0, CAST(floor((CASE WHEN ev = 1 THEN end_date ELSE DATE '{as_of}' END - start_date) / 7.0) AS BIGINT)) AS t
  FROM smp
), hist AS (SELECT cohort_months, t, SUM(ev) AS d, SUM(1 - ev) AS c FROM obs GROUP BY cohort_months, t),
n AS (SELECT cohort_months, SUM(d + c) AS n_all FROM hist GROUP BY cohort_months),
spine AS (SELECT cohort_months, n_all, UNNEST(range(0, 53)) AS time_k FROM n),
cv AS (
  SELECT s.cohort_months, s.n_all, s.time_k, COALESCE(h.d, 0) AS d, COALESCE(h.c, 0) AS c
  FROM spine s LEFT JOIN hist h ON h.cohort_months = s.cohort_months AND h.t = s.time_k
), rk AS (
  SELECT *, GREATEST(0, n_all - COALESCE(SUM(CASE WHEN time_k > 0 THEN d + c ELSE 0 END)
            OVER (PARTITION BY cohort_months ORDER BY time_k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS risk
  FROM cv
), hz AS (
  SELECT *, CASE WHEN time_k > 0 AND risk > 0 THEN LEAST(1.0, d / risk) ELSE 0.0 END AS h FROM rk
), sv AS (
  SELECT *, PRODUCT(1 - h) OVER (PARTITION BY cohort_months ORDER BY time_k
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s
  FROM hz
)
SELECT DATE '{fs}' AS fit_window_start, DATE '{fe}' AS fit_window_end, 'week' AS time_unit,
       CAST(cohort_months AS INTEGER) AS cohort_months, CAST(time_k AS INTEGER) AS time_k, ROUND(s, 12) AS s,
       ROUND(COALESCE(GREATEST(0.0, LAG(s) OVER (PARTITION BY cohort_months ORDER BY time_k) - s), 0.0), 12) AS q,
       ROUND(h, 12) AS h
FROM sv)"""


@register("km_curve", "K7,K11: E14,F15,F16,I22-I24,H3", f"WITH {_SQL_BASE}\nSELECT * FROM {_km_sql('log2', FS, FE, WE)} k")
def q_km_curve(spark, t):
    """Retention curve per plan-length cohort over the 12-month fit window, as of the week end."""
    return km_curve(after_pause(t), FS, FE, WE).orderBy("cohort_months", "time_k")


PREV = compute_window(date(1998, 8, 25))


@register("model_slice_replace", "B13", f"""WITH {_SQL_BASE},
old AS (
  SELECT * FROM {_km_sql('pre', PREV['fit_start'], PREV['fit_end'], PREV['week_end'])} a
  UNION ALL SELECT * FROM {_km_sql('pre', FS, FE, WE)} b
), fresh AS (SELECT * FROM {_km_sql('log2', FS, FE, WE)} c)
SELECT * FROM old WHERE NOT (fit_window_start = DATE '{FS}' AND fit_window_end = DATE '{FE}' AND time_unit = 'week')
UNION ALL SELECT * FROM fresh""")
def q_model_slice_replace(spark, t):
    """Stored curves of two windows; this window's slice is deleted and re-inserted from the updated log."""
    pre = stored_log(t)
    old = materialize(km_curve(pre, PREV["fit_start"], PREV["fit_end"], PREV["week_end"])
                      .unionByName(km_curve(pre, FS, FE, WE)), "km_models")
    return replace_slice(old, km_curve(after_pause(t, pre), FS, FE, WE), FS, FE)


_VERSIONS = ("fit_window_start date, fit_window_end date, time_unit string, horizon_weeks int, status string, "
             "created_at timestamp_ntz, created_by string, notes string")


@register("weekly_retrain", "K11: G5,K7,B13,B9", f"""WITH {_SQL_BASE},
models AS (
  SELECT * FROM {_km_sql('pre', PREV['fit_start'], PREV['fit_end'], PREV['week_end'])} a
  UNION ALL SELECT * FROM {_km_sql('log2', FS, FE, WE)} b
), n AS (SELECT fit_window_start, COUNT(*) AS n_rows FROM models GROUP BY 1)
SELECT v.*, COALESCE(n.n_rows, 0) AS n_rows FROM (
  SELECT DATE '{PREV['fit_start']}' AS fit_window_start, DATE '{PREV['fit_end']}' AS fit_window_end, 'week' AS time_unit,
         52 AS horizon_weeks, 'active' AS status, 'setup' AS created_by, 'earlier run' AS notes
  UNION ALL SELECT DATE '{FS}', DATE '{FE}', 'week', 52, 'active', 'airflow:daily', 'Daily retrain as_of={WE} run 1') v
LEFT JOIN n ON n.fit_window_start = v.fit_window_start""")
def q_weekly_retrain(spark, t):
    """The whole retrain step, run twice: the guard finds no active curve of the window, so the first run replaces its slice
    and activates its version; the second run finds both and leaves everything as it is."""
    pre = stored_log(t)
    log = materialize(after_pause(t, pre), "lvt_log_paused")
    models = materialize(km_curve(pre, PREV["fit_start"], PREV["fit_end"], PREV["week_end"]), "km_models")
    versions = spark.createDataFrame([(PREV["fit_start"], PREV["fit_end"], "week", HORIZON_WEEKS, "active", STAMP, "setup",
                                       "earlier run")], _VERSIONS)
    for run in (1, 2):
        if should_retrain(versions, models, FS, FE):
            models = materialize(replace_slice(models, km_curve(log, FS, FE, WE), FS, FE), "km_models")
            versions = materialize(activate_version(versions, FS, FE, HORIZON_WEEKS, STAMP, "airflow:daily",
                                                    f"Daily retrain as_of={WE} run {run}"), "model_versions")
    n = models.groupBy("fit_window_start").agg(F.count(F.lit(1)).alias("n_rows"))
    return versions.drop("created_at").join(n, "fit_window_start", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


def _dirty_key(c):
    """Keys as typed into the weekly sheet: leading zero, blanks and a dash."""
    return F.concat(F.lit(" 0"), c.cast("string"), F.lit("- "))


@register("episode_log_variant", "K13: D26,I37,B12,B10", f"""WITH {_SQL_BASE},
npre AS (
  SELECT regexp_replace(regexp_replace(lower(trim(CAST(lecture_vt_no AS VARCHAR))), '\\s|-', '', 'g'), '^0+', '') AS lecture_vt_no,
         episode_no, student_user_no, fst_months, start_date, end_date, tutoring_state, grade, created_at, updated_at
  FROM pre
), npsrc AS (
  SELECT regexp_replace(regexp_replace(lower(trim(' 0' || CAST(lecture_vt_no AS VARCHAR) || '- ')), '\\s|-', '', 'g'), '^0+', '')
         AS lecture_vt_no, MAX(p) AS p
  FROM psrc GROUP BY 1
), paused AS (
  SELECT l.lecture_vt_no, l.episode_no, l.student_user_no, l.fst_months, l.start_date,
         CASE WHEN l.end_date IS NULL AND p.p IS NOT NULL THEN GREATEST(p.p.end_date, l.start_date) ELSE l.end_date END AS end_date,
         CASE WHEN l.end_date IS NULL AND p.p IS NOT NULL THEN COALESCE(p.p.tutoring_state, l.tutoring_state)
              ELSE l.tutoring_state END AS tutoring_state,
         l.grade, l.created_at,
         CASE WHEN l.end_date IS NULL AND p.p IS NOT NULL THEN TIMESTAMP '{{STAMP}}' ELSE l.updated_at END AS updated_at
  FROM npre l LEFT JOIN npsrc p ON p.lecture_vt_no = l.lecture_vt_no
), nsrc AS (
  SELECT regexp_replace(regexp_replace(lower(trim(' 0' || CAST(lecture_vt_no AS VARCHAR) || '- ')), '\\s|-', '', 'g'), '^0+', '')
         AS lecture_vt_no, student_user_no, fst_months, start_date, tutoring_state, grade, src_order
  FROM src
), vclosed AS (
  SELECT l.*, (SELECT MIN(s.start_date) FROM nsrc s WHERE s.lecture_vt_no = l.lecture_vt_no
                                                   AND s.start_date > l.start_date) AS next_start
  FROM paused l
), vins AS (
  SELECT * FROM (
    SELECT s.lecture_vt_no,
           CAST(COALESCE((SELECT MAX(l.episode_no) FROM paused l WHERE l.lecture_vt_no = s.lecture_vt_no), 0) + 1 AS BIGINT) AS episode_no,
           s.student_user_no, s.fst_months, s.start_date, CAST(NULL AS DATE) AS end_date, s.tutoring_state, s.grade,
           TIMESTAMP '{{STAMP}}' AS created_at, TIMESTAMP '{{STAMP}}' AS updated_at,
           ROW_NUMBER() OVER (PARTITION BY s.lecture_vt_no ORDER BY s.src_order) AS rn
    FROM nsrc s) x
  WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM paused l WHERE l.lecture_vt_no = x.lecture_vt_no
                                                       AND l.episode_no = x.episode_no)
)
SELECT lecture_vt_no, episode_no, student_user_no, fst_months, start_date,
       CASE WHEN end_date IS NULL AND next_start IS NOT NULL
            THEN LEAST(CAST(next_start - INTERVAL 1 DAY AS DATE), DATE '{{WE}}') ELSE end_date END AS end_date,
       tutoring_state, grade, created_at,
       CASE WHEN end_date IS NULL AND next_start IS NOT NULL THEN TIMESTAMP '{{STAMP}}' ELSE updated_at END AS updated_at
FROM vclosed
UNION ALL
SELECT lecture_vt_no, episode_no, student_user_no, fst_months, start_date, end_date, tutoring_state, grade,
       created_at, updated_at FROM vins""".replace("{STAMP}", str(STAMP)).replace("{WE}", str(WE)))
def q_episode_log_variant(spark, t):
    """The weekly variant: keys matched after normalisation, pauses applied before inserts, open
    episodes closed at least(new start - 1, week end), conflicts on (lecture, episode_no)."""
    from episodic.functions.keys import normalise_key
    pre = stored_log(t).withColumn("lecture_vt_no", normalise_key(F.col("lecture_vt_no").cast("string")))
    pauses = pause_lecture(t.orders).withColumn("lecture_vt_no", normalise_key(_dirty_key(F.col("lecture_vt_no"))))
    news = new_lecture(t.orders).withColumn("lecture_vt_no", normalise_key(_dirty_key(F.col("lecture_vt_no"))))
    paused = update_pause(pre, pauses, WS, WE, STAMP)
    return insert_new(paused, news, WS, WE, STAMP, close_rule="least", conflict=("lecture_vt_no", "episode_no"))
