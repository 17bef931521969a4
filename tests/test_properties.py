"""Skew-safe operators against brute force on random inputs (one key holds a third of the rows)."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from episodic.operators.intervals import (_covered, _placed, asof_join, containing_join, episodes_with_points, interval_aggregate, range_join,
                                           with_next)
from episodic.operators.resets import Batch, Log
from episodic.operators.windows import filled, running_total

BASE = datetime(2024, 1, 1)


def _events(seed, n=300):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if rnd.random() < 0.34 else rnd.randint(1, 12)  # key 0 is hot
        ts = BASE + timedelta(hours=rnd.randint(0, 24 * 40))     # many equal timestamps
        out.append((i, key, ts, rnd.randint(0, 5)))
    return out


def test_running_total_chunked_equals_window(spark):
    for seed in range(3):
        df = spark.createDataFrame(_events(seed), "id long, k long, ts timestamp_ntz, v long")
        plain = running_total(df, ["k"], ["ts"], F.col("v"), "r")
        chunked = running_total(df, ["k"], ["ts"], F.col("v"), "r", chunk=F.date_trunc("day", "ts"))
        assert rows(plain, "id", "r") == rows(chunked, "id", "r")
        # peers (equal ts) share the value, as the default RANGE frame does
        w = Window.partitionBy("k").orderBy("ts")
        assert rows(df.withColumn("r", F.sum("v").over(w)), "id", "r") == rows(chunked, "id", "r")


def test_range_join_and_interval_aggregate_equal_brute_force(spark):
    rnd = random.Random(7)
    ivs = []
    for i in range(60):
        k = 0 if i < 20 else rnd.randint(1, 6)
        s = BASE + timedelta(hours=rnd.randint(0, 24 * 60))
        e = s + timedelta(hours=rnd.randint(-24, 24 * 50))   # some empty (end < start)
        ivs.append((i, k, s, e))
    pts = [(j, 0 if rnd.random() < 0.34 else rnd.randint(1, 6), BASE + timedelta(hours=rnd.randint(0, 24 * 70)))
           for j in range(400)]
    iv = spark.createDataFrame(ivs, "iid long, ik long, s timestamp_ntz, e timestamp_ntz")
    pt = spark.createDataFrame(pts, "pid long, pk long, p timestamp_ntz")
    want = sorted((i, j) for i, k, s, e in ivs for j, pk, p in pts if k == pk and s <= p <= e)
    assert rows(range_join(iv, pt, [("ik", "pk")], "s", "e", "p"), "iid", "pid") == want
    agg = interval_aggregate(iv, pt, [("ik", "pk")], "s", "e", "p", aggs=[F.count("pid").alias("n")])
    counts = {}
    for i, _ in want:
        counts[i] = counts.get(i, 0) + 1
    assert rows(agg, "iid", "n") == sorted((i, counts.get(i, 0)) for i, *_ in ivs)


def test_range_join_copies_grow_with_the_logarithm_of_the_length(spark):
    rnd = random.Random(9)
    ivs = []
    for i in range(120):                                      # overlaps from hours to years, one hot key, bounds on day edges
        s = BASE + timedelta(days=rnd.randint(-400, 400), hours=rnd.choice([0, 0, 7]))
        ivs.append((i, 0 if i % 3 else rnd.randint(1, 3), s, s + timedelta(days=rnd.choice([0, 1, 2, 7, 31, 365, 3650]), hours=rnd.choice([0, 5]))))
    ivs += [(900, 1, None, BASE), (901, 1, BASE, None), (902, None, BASE, BASE + timedelta(days=9))]
    pts = [(j, 0 if j % 3 else rnd.choice([1, 2, 3, None]), BASE + timedelta(days=rnd.randint(-500, 4200), hours=rnd.choice([0, 7, 12])))
           for j in range(600)] + [(900, 1, None)]
    iv = spark.createDataFrame(ivs, "iid long, ik long, s timestamp_ntz, e timestamp_ntz")
    pt = spark.createDataFrame(pts, "pid long, pk long, p timestamp_ntz")
    for lo, hi in ((True, True), (False, False)):
        want = sorted((i, j) for i, k, s, e in ivs for j, pk, p in pts if None not in (k, s, e, p) and k == pk
                      and (s <= p if lo else s < p) and (p <= e if hi else p < e))
        got = range_join(iv, pt, [("ik", "pk")], "s", "e", "p", lower_inclusive=lo, upper_inclusive=hi)
        assert rows(got, "iid", "pid") == want
    copies = _covered(iv, "s", "e")
    assert copies.groupBy("iid").count().agg(F.max("count")).first()[0] <= 2
    # a point is copied once for each length class of its key, of which ten years have at most thirteen
    assert _placed(copies, pt, [("ik", "pk")], "p").groupBy("pid").count().agg(F.max("count")).first()[0] <= 13


def test_row_numbers_and_shifts_chunked_equal_window(spark):
    from episodic.operators.windows import row_numbers, shifted
    for seed in range(3):
        data = _events(seed)
        data += [(1000 + i, 5, None, i % 3) for i in range(4)]  # null order values
        df = spark.createDataFrame(data, "id long, k long, ts timestamp_ntz, v long")
        order = ["ts", "id"]
        chunk = F.date_trunc("day", "ts")
        want = rows(row_numbers(df, ["k"], order, "n"), "id", "n")
        assert want == rows(row_numbers(df, ["k"], order, "n", chunk=chunk), "id", "n")
        # rows without a time: one chunk, cut further by the next order column
        nulls = [chunk, F.when(F.col("ts").isNull(), F.floor(F.col("id") / 2))]
        assert want == rows(row_numbers(df, ["k"], order, "n", chunk=nulls), "id", "n")
        for direction in (1, -1):
            plain = rows(shifted(df, ["k"], order, "v", "x", direction), "id", "x")
            assert plain == rows(shifted(df, ["k"], order, "v", "x", direction, chunk=chunk), "id", "x")
            assert plain == rows(shifted(df, ["k"], order, "v", "x", direction, chunk=nulls), "id", "x")


def test_asof_join_equals_range_join_on_tiling_intervals(spark):
    """Intervals [start, next start) per key (ties on start, null keys and times included):
    the as-of join equals the bucketed range join with the same bounds, plain and chunked."""
    for seed in range(3):
        rnd = random.Random(100 + seed)
        iv, pts = [], []
        for i in range(60):
            key = 0 if rnd.random() < 0.34 else (None if rnd.random() < 0.05 else rnd.randint(1, 6))
            start = None if rnd.random() < 0.05 else BASE + timedelta(hours=rnd.randint(0, 24 * 30))
            iv.append((i, key, start))
        for j in range(300):
            key = 0 if rnd.random() < 0.34 else (None if rnd.random() < 0.05 else rnd.randint(1, 6))
            at = None if rnd.random() < 0.05 else BASE + timedelta(hours=rnd.randint(-48, 24 * 34))
            pts.append((j, key, at))
        ivs = spark.createDataFrame(iv, "iid long, ik long, istart timestamp_ntz")
        ivs = with_next(ivs, "ik", ["istart", "iid"], "istart", "inext") \
            .withColumn("iend", F.coalesce("inext", F.lit("2024-03-01").cast("timestamp_ntz")))
        p = spark.createDataFrame(pts, "pid long, pk long, pat timestamp_ntz")
        half_open = F.col("inext").isNull() | (F.col("pat") < F.col("inext"))
        want = rows(range_join(ivs, p, [("ik", "pk")], "istart", "iend", "pat").filter(half_open),
                    "pid", "iid")
        for unit in ("day", "month"):
            got = asof_join(ivs, p, [("ik", "pk")], "istart", "iend", "pat", tie=["iid"], chunk_unit=unit)
            assert want == rows(got.filter(half_open), "pid", "iid")
        strict = asof_join(ivs, p, [("ik", "pk")], "istart", "iend", "pat", tie=["iid"], lower_inclusive=False)
        want_strict = rows(range_join(ivs, p, [("ik", "pk")], "istart", "iend", "pat", lower_inclusive=False).filter(half_open), "pid", "iid")
        assert want_strict == rows(strict.filter(half_open), "pid", "iid")


def test_containing_join_equals_brute_force(spark):
    """Closed intervals that tile, touch, overlap, tie on start or are empty; key 0 is hot."""
    for seed in range(3):
        rnd = random.Random(300 + seed)
        iv, pts = [], []
        for k in range(6):
            at = BASE
            for i in range(40 if k == 0 else 8):
                start = at
                end = start + timedelta(hours=rnd.randint(0, 60))
                at = end + timedelta(hours=rnd.choice([0, 0, 5, -rnd.randint(1, 40)]))
                if rnd.random() < 0.1:
                    end = start - timedelta(hours=1)
                if rnd.random() < 0.1:
                    end = end + timedelta(days=90)
                iv.append((len(iv), k, start, end))
        for j in range(500):
            at = BASE + timedelta(hours=rnd.randint(-10, 24 * 60))
            pts.append((j, 0 if rnd.random() < 0.34 else rnd.choice([None, 1, 2, 3, 4, 5]), at))
        pts += [(1000 + n, k, e) for n, (_, k, s, e) in enumerate(iv)]       # points on every interval's end
        a = spark.createDataFrame(iv, "iid long, ik long, s timestamp_ntz, e timestamp_ntz")
        b = spark.createDataFrame(pts, "pid long, pk long, p timestamp_ntz")
        want = sorted((i, j) for i, k, s, e in iv for j, pk, p in pts if k == pk and s <= p <= e)
        assert rows(containing_join(a, b, [("ik", "pk")], "s", "e", "p", tie=["iid"]), "iid", "pid") == want


def test_closing_new_starts_is_linear_in_a_hot_lecture(spark):
    """One lecture with 60,000 open rows: the quadratic frame would take minutes."""
    import time
    from datetime import date, datetime
    from episodic.operators.lifecycle import insert_new
    n = 60_000
    log = spark.range(n).select(
        F.lit(1).cast("long").alias("lecture_vt_no"), (F.col("id") + 1).alias("episode_no"), F.lit(1).cast("long").alias("student_user_no"),
        F.lit(1).alias("fst_months"), F.date_add(F.lit("1900-01-01").cast("date"), (F.col("id") % 30_000).cast("int")).alias("start_date"),
        F.lit(None).cast("date").alias("end_date"), F.lit("").alias("tutoring_state"), F.lit("g").alias("grade"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("created_at"), F.lit("2024-01-01").cast("timestamp_ntz").alias("updated_at"))
    new = spark.createDataFrame([(1, 1, 1, date(1990, 1, 2), "", "g", 1), (1, 1, 1, date(1990, 1, 4), "", "g", 2)],
                                "lecture_vt_no long, student_user_no long, fst_months int, start_date date, tutoring_state string, "
                                "grade string, src_order long")
    t0 = time.time()
    out = insert_new(log, new, date(1990, 1, 1), date(1990, 1, 7), datetime(2024, 1, 1))
    assert out.filter("end_date = date'1990-01-01'").count() == out.filter("episode_no <= 60000 and start_date <= date'1990-01-01'").count()
    assert time.time() - t0 < 60


def test_filled_chunked_equals_window(spark):
    """Forward fill split per (key, day) equals last(ignorenulls) over the whole key (null order values
    and null fill values included; key 0 is hot)."""
    for seed in range(3):
        rnd = random.Random(200 + seed)
        data = []
        for i, k, ts, v in _events(seed):
            ts = None if rnd.random() < 0.05 else ts
            data.append((i, k, ts, None if rnd.random() < 0.6 else v))
        df = spark.createDataFrame(data, "id long, k long, ts timestamp_ntz, v long")
        w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
        want = rows(df.withColumn("f", F.last("v", ignorenulls=True).over(w)), "id", "f")
        chunk = F.date_trunc("day", "ts")
        assert want == rows(filled(df, ["k"], ["ts", "id"], "v", "f", chunk=chunk), "id", "f")


def _plain_episodes(data, horizon):
    """Episodes of (key, ts, kind, id, v) by their definition, every point against every episode."""
    out = {}
    for key in {r[0] for r in data if r[2] != "point"}:
        marks = [r for r in data if r[0] == key and r[2] != "point"]
        points = [r for r in data if r[0] == key and r[2] == "point" and key is not None and r[1] is not None]

        def stops(t):
            return sum(m[2] == "stop" and (m[1] is None or (t is not None and m[1] <= t)) for m in marks)
        eps = {}
        for m in marks:
            eps.setdefault(stops(m[1]) + (m[2] == "start"), []).append(m)
        for seq, ms in eps.items():
            first = min((m[1] for m in ms if m[2] == "start" and m[1] is not None), default=None)
            last = max((m[1] for m in ms if m[2] == "stop" and m[1] is not None), default=None)
            inside = [p for p in points if first is not None and first <= p[1] <= (last if last is not None else horizon)]
            out[key, seq] = (first, last, max((m[1] for m in ms if m[1] is not None), default=None), sum(m[2] == "start" for m in ms),
                             len(inside), sum(p[4] for p in inside) if inside else None, min((p[1] for p in inside), default=None))
    return out


def test_episodes_with_points_equal_brute_force(spark):
    rng = random.Random(11)
    t0 = datetime(2024, 1, 1)
    for trial in range(4):
        data = []
        for i in range(500):
            key = rng.choice([None, 1, 1, 1, 2, 3, 4])
            # few instants, so that starts, stops and points often share one; some without a time
            t = None if rng.random() < 0.02 else t0 + timedelta(hours=6 * rng.randrange(0, (20, 60, 200, 400)[trial]))
            data.append((key, t, rng.choices(["start", "stop", "point"], [3, 1 + trial, 10])[0], i, rng.randrange(0, 100)))
        horizon = t0 + timedelta(days=(3, 10, 30, 200)[trial], hours=7)
        df = spark.createDataFrame(data, "k long, t timestamp_ntz, kind string, id long, v int")
        got = episodes_with_points(
            df, "k", "t", "kind", F.lit(horizon).cast("timestamp_ntz"), F.date_trunc("day", F.col("t")),
            {"starts": ("count", F.when(F.col("kind") == "start", F.col("id")))},
            {"n": ("count", F.col("id")), "total": ("sum", F.col("v")), "earliest": ("min", F.col("t"))}).collect()
        want = {k: v for k, v in _plain_episodes(data, horizon).items() if v[2] is not None or v[0] is not None}
        assert {(r["k"], r["seq"]): (r["active_timestamp"], r["done_timestamp"], r["marker_updated_at"], r["starts"], r["n"], r["total"],
                                     r["earliest"]) for r in got} == want


def _plain_sums(data):
    """Sums after every session of (lecture, teacher, ts, kind, id, v), one row after the other."""
    after, sums, marks = {}, {}, {}
    for lecture, teacher, t, kind, i, v in sorted(data, key=lambda r: (r[2], r[3], r[4])):
        if kind == 2:
            mark = marks.get(lecture)
            a, b = sums.get((lecture, teacher), (0, 0))
            inside = mark is not None and (mark[0] == 1 or mark[1] == t)
            sums[lecture, teacher] = (a + (v if inside else 0), b + v)
            after[i] = sums[lecture, teacher]
        else:
            if kind == 1 and (lecture not in marks or marks[lecture][0] == 0):
                sums.update({k: (0, b) for k, (_, b) in sums.items() if k[0] == lecture})
            marks[lecture] = (kind, t)
    return after, sums


def test_sums_that_restart_equal_a_plain_loop_in_any_batches(spark):
    rng = random.Random(21)
    t0 = datetime(2024, 1, 1)
    for trial in range(2):
        data = []
        for i in range(300):
            kind = rng.choices([0, 1, 2], [1, 1, 6])[0]
            data.append((rng.choice([1, 1, 1, 2, 3, 4]), rng.choice([7, 8, None]) if kind == 2 else None,
                         t0 + timedelta(hours=4 * rng.randrange(0, (40, 200)[trial])), kind, i, rng.randrange(1, 50) if kind == 2 else None))
        after, sums = _plain_sums(data)
        schema = "l long, p long, t timestamp_ntz, kind int, id long, v decimal(18,2)"

        def log(rows):
            return Log(spark.createDataFrame([(*r[:5], None if r[5] is None else Decimal(r[5])) for r in rows], schema), "l", "p", "t", "kind", "id", "v")
        got = {r["id"]: (r["active_done"], r["total_done"]) for r in Batch(log(data)).running().collect()}
        assert got == after
        # the same in three batches, each continued from the state of the one before
        cuts = sorted(t0 + timedelta(hours=4 * rng.randrange(0, 300)) for _ in range(2))
        parts = [[r for r in data if r[2] < cuts[0]], [r for r in data if cuts[0] <= r[2] < cuts[1]], [r for r in data if r[2] >= cuts[1]]]
        state, seen = None, {}
        for part in parts:
            batch = Batch(log(part), state)
            seen.update({r["id"]: (r["active_done"], r["total_done"]) for r in batch.running().collect()})
            state = batch.advance()
            state = type(state)(*(spark.createDataFrame(d.collect(), d.schema) for d in (state.lectures, state.sums)))
        assert seen == after
        assert {(r["l"], r["p"]): (r["active"], r["total"]) for r in state.sums.collect()} == sums
