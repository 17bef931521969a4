"""Golden cases on hand-made tables: one per trap of the blueprint (nulls, ties, order of steps)."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from episodic.functions.cleaning import parse_date_text, stringify, strip_nul
from episodic.functions.keys import normalise_key
from episodic.operators.feedback import explode_pairs, pivot_slots
from episodic.operators.incremental import insert_absent, latest_per_key, state_changes, upsert
from episodic.operators.intervals import episodes
from episodic.operators.lifecycle import insert_new, renumber_episodes, update_pause, weekly_counts
from episodic.operators.survival import compute_window, km_curve

T = datetime


# 1. latest_per_key: null key, equal timestamps, null timestamp
def test_latest_per_key_nulls_and_ties(spark):
    df = spark.createDataFrame(
        [(1, T(2024, 1, 1), 0, "a"), (1, T(2024, 1, 2), 0, "b"), (1, T(2024, 1, 2), 1, "c"),
         (2, None, 0, "d"), (2, T(2023, 1, 1), 0, "e"), (None, T(2025, 1, 1), 0, "f")],
        "k long, ts timestamp_ntz, batch int, v string")
    order = [F.col("ts").desc_nulls_last(), F.col("batch").desc()]
    assert rows(latest_per_key(df, ["k"], order), "k", "v") == [(1, "c"), (2, "e")]
    kept = latest_per_key(df, ["k"], order, null_keys="keep")
    assert rows(kept, "k", "v") == [(None, "f"), (1, "c"), (2, "e")]


# 2. episodes: payment and pause at the same instant; pause before the first payment; two pauses in a row
def _markers(spark, data):
    return spark.createDataFrame(data, "lvt long, ts timestamp_ntz, state string")


def test_episode_same_instant_goes_to_next(spark):
    m = _markers(spark, [(1, T(2024, 1, 1), "active"), (1, T(2024, 1, 5), "done"), (1, T(2024, 1, 5), "active")])
    e = episodes(m, "lvt", "ts", "state")
    assert rows(e, "seq", "active_timestamp", "done_timestamp") == [
        (1, T(2024, 1, 1), T(2024, 1, 5)), (2, T(2024, 1, 5), None)]


def test_episode_pause_first_and_double_pause(spark):
    m = _markers(spark, [(1, T(2024, 1, 1), "done"), (1, T(2024, 1, 2), "active"), (1, T(2024, 1, 3), "done"),
                         (1, T(2024, 1, 4), "done"), (1, T(2024, 1, 6), "active")])
    e = episodes(m, "lvt", "ts", "state")
    got = rows(e, "seq", "active_timestamp", "done_timestamp")
    # first paid group is 2; the second pause in a row forms a group with no payment
    assert got == [(1, None, T(2024, 1, 1)), (2, T(2024, 1, 2), T(2024, 1, 3)), (3, None, T(2024, 1, 4)),
                   (4, T(2024, 1, 6), None)]
    chunked = episodes(m, "lvt", "ts", "state", chunk=F.date_trunc("day", "ts"))
    assert rows(chunked, "seq", "active_timestamp", "done_timestamp") == got


# 3. KM: exits at week 0, all censored, hazard 1, beyond the horizon, absent cohort
def _km_loop(samples, horizon):
    """Plain-Python discrete KM of the blueprint: week-0 exits never leave the risk set."""
    out = {}
    for cohort in sorted({c for c, _, _ in samples}):
        ts_ = [(t, e) for c, t, e in samples if c == cohort]
        d = {}
        c_ = {}
        for t, e in ts_:
            (d if e else c_)[t] = (d if e else c_).get(t, 0) + 1
        risk, s = len(ts_), 1.0
        curve = [(0, 1.0, 0.0, 0.0)]
        for k in range(1, horizon + 1):
            if risk > 0:
                h = min(1.0, d.get(k, 0) / risk)
                s_new = s * (1 - h)
                curve.append((k, s_new, max(0.0, s - s_new), h))
                s = s_new
                risk = max(0, risk - d.get(k, 0) - c_.get(k, 0))
            else:
                curve.append((k, s, 0.0, 0.0))
        out[cohort] = curve
    return out


def test_km_matches_plain_loop(spark):
    as_of = date(2024, 6, 30)
    log = [  # (cohort, start, end)
        (1, date(2024, 1, 1), date(2024, 1, 3)),   # exit at week 0
        (1, date(2024, 1, 1), date(2024, 1, 15)),  # week 2
        (1, date(2024, 1, 1), date(2024, 1, 15)),
        (1, date(2024, 1, 1), None),               # censored at as_of
        (3, date(2024, 1, 1), None), (3, date(2024, 2, 1), None),       # all censored
        (6, date(2024, 1, 1), date(2024, 1, 8)),   # hazard 1 at week 1
        (12, date(2023, 12, 1), date(2024, 6, 1)),  # beyond a horizon of 8
        (12, date(2024, 1, 1), date(2024, 7, 30)),  # ends after as_of -> censored
    ]
    df = spark.createDataFrame([(i, c, s, e) for i, (c, s, e) in enumerate(log)],
                               "lecture_vt_no long, fst_months int, start_date date, end_date date")
    horizon = 8
    got = km_curve(df, date(2023, 1, 1), as_of, as_of, horizon=horizon, cohorts=(1, 3, 6, 12)).collect()
    samples = []
    for c, s, e in log:
        ev = e is not None and e <= as_of
        stop = e if ev else as_of
        samples.append((c, max(0, (stop - s).days // 7), ev))
    want = _km_loop(samples, horizon)
    assert {r.cohort_months for r in got} == set(want)
    for r in got:
        k, s, q, h = want[r.cohort_months][r.time_k]
        assert (r.s, r.q, r.h) == pytest.approx((s, q, h), abs=1e-12)
    by = {(r.cohort_months, r.time_k): r for r in got}
    assert by[(6, 1)].h == 1.0 and by[(6, 2)].s == 0.0
    assert all(by[(3, k)].s == 1.0 for k in range(horizon + 1))


def test_compute_window_is_the_week_of_yesterday():
    w = compute_window(date(2024, 3, 4))  # a Monday: yesterday is Sunday 2024-03-03
    assert (w["week_start"], w["week_end"]) == (date(2024, 2, 26), date(2024, 3, 3))
    assert w["fit_start"] == date(2023, 2, 27) and w["fit_start"].weekday() == 0


# 4. insert_new: two new rows of one lecture in a week; idempotence; pause earlier than start
def _log(spark, data):
    return spark.createDataFrame(data, "lecture_vt_no long, episode_no long, student_user_no long, fst_months int, "
                                       "start_date date, end_date date, tutoring_state string, grade string, "
                                       "created_at timestamp_ntz, updated_at timestamp_ntz")


def test_insert_new_snapshot_semantics_and_idempotence(spark):
    t0 = T(2024, 1, 1)
    log = _log(spark, [(1, 1, 10, 1, date(2023, 12, 1), None, "A", "g", t0, t0),
                       (2, 1, 20, 3, date(2023, 11, 1), date(2023, 11, 20), "A", "g", t0, t0)])
    src = spark.createDataFrame(
        [(1, 10, 1, date(2024, 1, 2), None, "g", 5), (1, 10, 1, date(2024, 1, 4), "B", "g", 6),
         (3, 30, 6, date(2024, 1, 3), "C", "g", 7), (3, 30, 6, date(2024, 1, 3), "D", "g", 8)],
        "lecture_vt_no long, student_user_no long, fst_months int, start_date date, tutoring_state string, "
        "grade string, src_order long")
    stamp = T(2024, 1, 8)
    out = insert_new(log, src, date(2024, 1, 1), date(2024, 1, 7), stamp)
    got = rows(out, "lecture_vt_no", "episode_no", "start_date", "end_date", "tutoring_state")
    assert got == [
        (1, 1, date(2023, 12, 1), date(2024, 1, 1), "A"),   # closed the day before the first new start
        (1, 2, date(2024, 1, 2), None, ""),                 # both new rows get max+1 from the pre-state
        (1, 2, date(2024, 1, 4), None, "B"),
        (2, 1, date(2023, 11, 1), date(2023, 11, 20), "A"),
        (3, 1, date(2024, 1, 3), None, "C"),                # duplicate key: first src_order wins
    ]
    again = insert_new(out, src, date(2024, 1, 1), date(2024, 1, 7), stamp)
    assert again.count() == out.count()  # a re-run inserts nothing twice (ON CONFLICT DO NOTHING)
    # the renumbering is stable on its own output
    r1 = renumber_episodes(out, stamp).drop("renumbered")
    r2 = renumber_episodes(r1, stamp)
    assert r2.filter("renumbered").count() == 0


def test_update_pause_greatest_and_null_state(spark):
    t0 = T(2024, 1, 1)
    log = _log(spark, [(1, 1, 10, 1, date(2024, 1, 5), None, "A", "g", t0, t0)])
    pauses = spark.createDataFrame([(1, date(2024, 1, 3), None)],
                                   "lecture_vt_no long, end_date date, tutoring_state string")
    out = update_pause(log, pauses, date(2024, 1, 1), date(2024, 1, 7), T(2024, 1, 8)).collect()[0]
    assert out.end_date == date(2024, 1, 5)  # greatest(pause end, start)
    assert out.tutoring_state == ""          # null state coalesced to '' first, then overwrites


def test_weekly_counts_zero_fill(spark):
    t0 = T(2024, 1, 1)
    log = _log(spark, [(1, 1, 1, 1, date(2024, 1, 3), date(2024, 1, 10), "A", "g", t0, t0)])
    got = rows(weekly_counts(log), "week_start", "cohort_months", "new_actual", "pause_actual")
    assert got == [(date(2024, 1, 1), 1, 1, 0), (date(2024, 1, 1), 3, 0, 0), (date(2024, 1, 1), 6, 0, 0),
                   (date(2024, 1, 1), 12, 0, 0), (date(2024, 1, 8), 1, 0, 1), (date(2024, 1, 8), 3, 0, 0),
                   (date(2024, 1, 8), 6, 0, 0), (date(2024, 1, 8), 12, 0, 0)]


# 5. pair keys (1,23) and (12,3); a late pair below the global max
def test_pair_keys_do_not_collide(spark):
    df = spark.createDataFrame([(1, 23, 1.0), (12, 3, 2.0)], "student long, teacher long, dm double")
    g = df.groupBy("student", "teacher").agg(F.sum("dm").alias("dm"))
    assert g.count() == 2
    text = df.select(F.concat(F.col("student").cast("string"), F.col("teacher").cast("string")).alias("t"))
    assert text.distinct().count() == 1  # the reference's text key would merge them


def test_upsert_replaces_only_changed_keys(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, v double")
    new = spark.createDataFrame([(2, 20.0), (3, 30.0)], "k long, v double")
    assert rows(upsert(old, new, ["k"])) == [(1, 1.0), (2, 20.0), (3, 30.0)]
    assert rows(insert_absent(old, new, ["k"])) == [(1, 1.0), (2, 2.0), (3, 30.0)]


# 6. feedback: repeated key, a value containing ':', a non-numeric score
def test_explode_pairs_and_pivot(spark):
    df = spark.createDataFrame([(1, '{"q1":"3","at":"10:00:05","q1":"9","score":"x"}')], "id long, body string")
    pairs = explode_pairs(df, "body", keep=["id"])
    assert rows(pairs, "pair_no", "key", "value") == [(1, "q1", "3"), (2, "at", "10:00:05"), (3, "q1", "9"),
                                                      (4, "score", "x")]
    piv = pivot_slots(pairs, ["id"], "key", "value", {"q": ["q1"], "score": ["score"]}, cast="int").collect()[0]
    assert (piv.q, piv.score) == (9, None)  # try_cast: the bad score is null
    with pytest.raises(PySparkException):
        pivot_slots(pairs, ["id"], "key", "value", {"score": ["score"]}, cast="int", strict=True).collect()


# 7. NOT IN with a null; LIKE '%_1'
def test_not_in_null_and_like_wildcard(spark):
    a = spark.createDataFrame([(1,), (2,)], "k long")
    b = spark.createDataFrame([(1,), (None,)], "k long")
    a.createOrReplaceTempView("ga")
    b.createOrReplaceTempView("gb")
    assert spark.sql("SELECT k FROM ga WHERE k NOT IN (SELECT k FROM gb)").count() == 0  # SQL NOT IN
    anti = a.join(b.filter(F.col("k").isNotNull()), "k", "left_anti")
    assert rows(anti) == [(2,)]  # our anti-join semantics
    s = spark.createDataFrame([("10_11",), ("1_2",)], "g string")
    assert rows(s.filter(F.col("g").like("%_1"))) == [("10_11",)]


# 8. rank first, then filter
def test_rank_then_filter(spark):
    from episodic.operators.windows import first_rows
    p = spark.createDataFrame([(1, date(2024, 10, 1), "paid"), (1, date(2024, 11, 5), "paid")],
                              "lvt long, d date, state string")
    first = first_rows(p, ["lvt"], ["d"], 1).filter(F.col("d") >= F.lit("2024-11-01").cast("date"))
    assert first.count() == 0  # the first payment is before the cut: no row (filtering first would give one)


# 9. three date spellings plus junk; NUL, blanks, null-like tokens
def test_cleaning(spark):
    df = spark.createDataFrame([("2025. 08. 28",), ("2025-08-28",), ("20250828",), (" 2025/08/28 ",), ("n/a",),
                                (None,)], "s string")
    got = [r.d for r in df.select(parse_date_text(F.col("s")).alias("d")).collect()]
    assert got == [date(2025, 8, 28)] * 4 + [None, None]
    t = spark.createDataFrame([("a\u0000b",), ("nan",), ("<NA>",), (None,), ("ok",)], "s string")
    got = [r.x for r in t.select(stringify(strip_nul(F.col("s"))).alias("x")).collect()]
    assert got == ["ab", "", "", "", "ok"]
    k = spark.createDataFrame([("  00123 - ",), ("12-3",)], "s string")
    assert [r.k for r in k.select(normalise_key(F.col("s")).alias("k")).collect()] == ["123", "123"]


# 10. state history with null stored or new state
def test_state_changes_null_safe(spark):
    stored = spark.createDataFrame([(1, None), (2, "A"), (3, "A")], "k long, s string")
    cur = spark.createDataFrame([(1, None), (2, None), (3, "A"), (4, "B")], "k long, s string")
    assert rows(state_changes(stored, cur, "k", "s")) == [(2, None), (4, "B")]
