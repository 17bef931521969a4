"""Episode log maintenance (K8-K10, K12; B10-B14, E3, D19).

The log has one row per (lecture_vt_no, start_date); at most one episode per
lecture is open (``end_date`` null). Each step reads one immutable pre-state
and returns the whole post-state, which the caller writes to a new path and
swaps in: every derived value (closing date, next episode number) comes from
the pre-state, as the reference's single SQL statement does.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodic.operators.windows import filled, row_numbers

LOG_COLS = ["lecture_vt_no", "episode_no", "student_user_no", "fst_months", "start_date", "end_date",
            "tutoring_state", "grade", "created_at", "updated_at"]
COHORTS = (1, 3, 6, 12)


def _d(x: date) -> F.Column:
    return F.lit(x.isoformat()).cast("date")


def _stamp(x: datetime) -> F.Column:
    return F.lit(x.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def insert_new(log: DataFrame, new_lecture: DataFrame, week_start: date, week_end: date,
               stamp: datetime, close_rule: str = "greatest",
               conflict: tuple[str, ...] = ("lecture_vt_no", "start_date")) -> DataFrame:
    """K8: close open episodes before a new start, insert new starts if absent.

    ``new_lecture``: lecture_vt_no, student_user_no, fst_months, start_date,
    tutoring_state, grade, src_order (tie-break for duplicate keys).
    An open row is closed by the first new start strictly after it, at
    ``greatest(start, new_start - 1 day)`` (``close_rule='least'``, the weekly
    variant: ``least(new_start - 1 day, week_end)``); it is found with one
    scan over (open rows + new starts) of a lecture, never by pairing them. ``conflict`` is the key of ON CONFLICT DO NOTHING.
    """
    src = new_lecture.filter(F.col("start_date").between(_d(week_start), _d(week_end))) \
        .withColumn("tutoring_state", F.coalesce("tutoring_state", F.lit("")))
    # first new start strictly after each open row: a fill along falling dates (an open row before a start of its
    # own day), in chunks of a year, so the work is linear in a lecture's rows and a hot lecture is split
    opens = log.filter(F.col("end_date").isNull()).select(
        "lecture_vt_no", "start_date", F.lit(-1).alias("_kind"), F.lit(None).cast("date").alias("_start"))
    starts = src.select("lecture_vt_no", "start_date", F.lit(0).alias("_kind"), F.col("start_date").alias("_start"))
    marks = opens.unionByName(starts).withColumn("_back", -F.unix_date("start_date"))
    nxt = filled(marks, ["lecture_vt_no"], ["_back", "_kind"], "_start", "_next_start",
                 chunk=F.floor(F.col("_back") / 366)) \
        .filter((F.col("_kind") == -1) & F.col("_next_start").isNotNull()) \
        .select("lecture_vt_no", "start_date", "_next_start")
    if close_rule == "greatest":
        closing = F.greatest(F.col("start_date"), F.date_sub("_next_start", 1))
    else:
        closing = F.least(F.date_sub("_next_start", 1), _d(week_end))
    closed = log.join(nxt, ["lecture_vt_no", "start_date"], "left").select(
        *[c for c in LOG_COLS if c not in ("end_date", "updated_at")],
        F.when(F.col("_next_start").isNotNull(), closing).otherwise(F.col("end_date")).alias("end_date"),
        F.when(F.col("_next_start").isNotNull(), _stamp(stamp)).otherwise(F.col("updated_at")).alias("updated_at"))
    # next episode number from the pre-state; insert if (lecture, start) is absent
    max_ep = log.groupBy("lecture_vt_no").agg(F.max("episode_no").alias("_max_ep"))
    w1 = Window.partitionBy(*conflict).orderBy("src_order")
    fresh = src.join(max_ep, "lecture_vt_no", "left") \
        .withColumn("episode_no", (F.coalesce("_max_ep", F.lit(0)) + 1).cast("bigint")) \
        .withColumn("_rn", F.row_number().over(w1)).filter(F.col("_rn") == 1) \
        .join(log.select(*conflict), list(conflict), "left_anti") \
        .select("lecture_vt_no", "episode_no",
                "student_user_no", "fst_months", "start_date", F.lit(None).cast("date").alias("end_date"),
                "tutoring_state", "grade", _stamp(stamp).alias("created_at"), _stamp(stamp).alias("updated_at"))
    return closed.select(*LOG_COLS).unionByName(fresh.select(*LOG_COLS))


def update_pause(log: DataFrame, pause_lecture: DataFrame, week_start: date, week_end: date,
                 stamp: datetime) -> DataFrame:
    """K9: close the open episode of lectures paused in the week.

    ``end = greatest(pause_end, start)``; the state is overwritten by the
    pause state coalesced to ''. Several pauses of one lecture: the latest
    end date wins (then the larger state).
    """
    src = pause_lecture.filter(F.col("end_date").between(_d(week_start), _d(week_end))) \
        .select("lecture_vt_no", "end_date", F.coalesce("tutoring_state", F.lit("")).alias("tutoring_state")) \
        .groupBy("lecture_vt_no").agg(F.max(F.struct("end_date", "tutoring_state")).alias("_p"))
    j = log.join(src, "lecture_vt_no", "left")
    hit = F.col("end_date").isNull() & F.col("_p").isNotNull()
    return j.select(
        *[c for c in LOG_COLS if c not in ("end_date", "tutoring_state", "updated_at")],
        F.when(hit, F.greatest(F.col("_p.end_date"), F.col("start_date"))).otherwise(F.col("end_date"))
        .alias("end_date"),
        F.when(hit, F.coalesce(F.col("_p.tutoring_state"), F.col("tutoring_state")))
        .otherwise(F.col("tutoring_state")).alias("tutoring_state"),
        F.when(hit, _stamp(stamp)).otherwise(F.col("updated_at")).alias("updated_at")).select(*LOG_COLS)


def run_counts(new_lecture: DataFrame, inserted: DataFrame, paused: DataFrame, week_start: date, week_end: date,
               stamp: datetime) -> DataFrame:
    """K8/K9 results of one run as one row: new starts of the week, episodes closed by them, episodes inserted, and
    episodes ending in the week after the pauses.

    ``inserted`` and ``paused`` are the logs after each step; rows of this run carry its ``stamp``."""
    ws, we, now = _d(week_start), _d(week_end), _stamp(stamp)
    zero = F.lit(0).cast("bigint")
    names = ["source_rows", "closed_rows", "inserted_new", "updated_pause"]

    def part(df, **counts):
        return df.agg(*[(counts[n] if n in counts else F.max(zero)).alias(n) for n in names])

    touched = F.col("updated_at") == now
    parts = part(new_lecture, source_rows=F.count_if(F.col("start_date").between(ws, we))) \
        .unionByName(part(inserted, closed_rows=F.count_if(touched & (F.col("created_at") != now)),
                          inserted_new=F.count_if(F.col("created_at") == now))) \
        .unionByName(part(paused, updated_pause=F.count_if(F.col("end_date").between(ws, we))))
    return parts.agg(*[F.sum(n).cast("bigint").alias(n) for n in names])


def weekly_counts(log: DataFrame, cohorts=COHORTS) -> DataFrame:
    """K10 over every week: starts and ends per (Monday, cohort), zero-filled for each listed cohort.

    Starts and ends are counted with map-side combined aggregates; the
    (week x cohort) spine is generated from the distinct weeks with
    ``explode`` of the fixed cohort list (no join)."""
    starts = log.filter(F.col("fst_months").isin(list(cohorts))).groupBy(
        F.date_trunc("week", "start_date").cast("date").alias("week_start"),
        F.col("fst_months").alias("cohort_months")).agg(F.count(F.lit(1)).alias("new_actual"))
    ends = log.filter(F.col("fst_months").isin(list(cohorts)) & F.col("end_date").isNotNull()).groupBy(
        F.date_trunc("week", "end_date").cast("date").alias("week_start"),
        F.col("fst_months").alias("cohort_months")).agg(F.count(F.lit(1)).alias("pause_actual"))
    weeks = log.select(F.date_trunc("week", "start_date").cast("date").alias("week_start")) \
        .unionByName(log.filter(F.col("end_date").isNotNull())
                     .select(F.date_trunc("week", "end_date").cast("date").alias("week_start"))).distinct()
    spine = weeks.select("week_start", F.explode(F.array(*[F.lit(c) for c in cohorts])).alias("cohort_months"))
    return spine.join(starts, ["week_start", "cohort_months"], "left") \
        .join(ends, ["week_start", "cohort_months"], "left") \
        .select("week_start", F.col("cohort_months").cast("int").alias("cohort_months"),
                F.coalesce("new_actual", F.lit(0)).cast("bigint").alias("new_actual"),
                F.coalesce("pause_actual", F.lit(0)).cast("bigint").alias("pause_actual"))


def weekly_actuals_for(log: DataFrame, week_start: date, week_end: date, cohorts=COHORTS) -> DataFrame:
    """K10 for one week, exactly as scheduled: (week x cohorts) spine left-joined to the log."""
    ws, we = _d(week_start), _d(week_end)
    counts = log.filter(F.col("fst_months").isin(list(cohorts))).groupBy("fst_months").agg(
        F.count_if(F.col("start_date").between(ws, we)).alias("new_actual"),
        F.count_if(F.col("end_date").between(ws, we)).alias("pause_actual"))
    spine = log.sparkSession.range(1).select(
        ws.alias("week_start"), F.explode(F.array(*[F.lit(c) for c in cohorts])).alias("cohort_months"))
    return spine.join(counts, spine["cohort_months"] == counts["fst_months"], "left").select(
        "week_start", F.col("cohort_months").cast("int").alias("cohort_months"),
        F.coalesce("new_actual", F.lit(0)).cast("bigint").alias("new_actual"),
        F.coalesce("pause_actual", F.lit(0)).cast("bigint").alias("pause_actual"))


def renumber_episodes(log: DataFrame, stamp: datetime, chunk: Column | None = None) -> DataFrame:
    """episode_no = rank by (start, coalesce(end, 2100-01-01)); touch updated_at only on change.

    (lecture, start) is unique, so the order is total; ``chunk`` (e.g. the
    year of ``start_date``) numbers a hot lecture in many tasks."""
    res = row_numbers(log, ["lecture_vt_no"],
                      [F.col("start_date"), F.coalesce("end_date", F.lit("2100-01-01").cast("date"))], "_rn",
                      chunk=chunk)
    changed = ~F.col("episode_no").eqNullSafe(F.col("_rn"))
    return res.select(*[c for c in LOG_COLS if c not in ("episode_no", "updated_at")],
                      F.col("_rn").alias("episode_no"),
                      F.when(changed, _stamp(stamp)).otherwise(F.col("updated_at")).alias("updated_at"),
                      changed.alias("renumbered")).select(*LOG_COLS, "renumbered")
