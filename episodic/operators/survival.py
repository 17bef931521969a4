"""Discrete Kaplan-Meier retention curves (K7, K11; E14, F15, F16, I22-I24).

Not the textbook estimator: events and censorings at week 0 never leave the
risk set. For t >= 1 the risk set is ``N - sum_{1<=j<t}(d_j + c_j)`` floored
at 0, ``h = min(1, d/risk)``, ``S`` is the running product of ``1 - h`` and
``q`` the drop of ``S``. Times beyond the horizon only count in ``N``.

The data-sized work is one map-side combined histogram per (cohort, week);
the curve itself is a window over at most ``horizon + 1`` rows per cohort.
The running product uses ``product`` (a log-sum would lose ``h = 1``).
"""

from __future__ import annotations

import calendar
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FIT_MONTHS = 12
HORIZON_WEEKS = 52


def _add_months(d: date, months: int) -> date:
    y, m = divmod(d.month - 1 + months, 12)
    y, m = d.year + y, m + 1
    return date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def compute_window(run_date: date, fit_months: int = FIT_MONTHS, horizon: int = HORIZON_WEEKS) -> dict:
    """K7: the Monday-Sunday week containing run_date - 1 day; fit window =
    [Monday of (week_end - fit_months), week_end]. Pure parameter arithmetic."""
    y = run_date - timedelta(days=1)
    ws = y - timedelta(days=y.weekday())
    we = ws + timedelta(days=6)
    fs = _add_months(we, -fit_months)
    fs = fs - timedelta(days=fs.weekday())
    return {"week_start": ws, "week_end": we, "fit_start": fs, "fit_end": we, "horizon_weeks": horizon}


def km_curve(log: DataFrame, fit_start: date, fit_end: date, as_of: date,
             horizon: int = HORIZON_WEEKS, cohorts=(1, 3, 6, 12)) -> DataFrame:
    """One row per (present cohort, k in 0..horizon) with s, q, h."""
    fs, fe, ao = (F.lit(x.isoformat()).cast("date") for x in (fit_start, fit_end, as_of))
    sample = log.filter(F.col("start_date").between(fs, fe) & F.col("fst_months").isin(list(cohorts)))
    event = (F.col("end_date").isNotNull() & (F.col("end_date") <= ao)).cast("int")
    stop = F.when(event == 1, F.col("end_date")).otherwise(ao)
    weeks = F.greatest(F.lit(0), F.floor(F.datediff(stop, F.col("start_date")) / 7).cast("int"))
    obs = sample.select(F.col("fst_months").alias("cohort_months"), event.alias("ev"), weeks.alias("t"))
    hist = obs.groupBy("cohort_months", "t").agg(F.sum("ev").alias("d"),
                                                F.sum(1 - F.col("ev")).alias("c"))
    n_all = hist.groupBy("cohort_months").agg(F.sum(F.col("d") + F.col("c")).alias("n_all"))
    spine = n_all.select("cohort_months", "n_all",
                         F.explode(F.sequence(F.lit(0), F.lit(horizon))).alias("time_k"))
    # hist is keyed by (cohort, t): the spine join touches at most horizon+1 rows per cohort
    curve = spine.join(hist.withColumnRenamed("t", "time_k"), ["cohort_months", "time_k"], "left") \
        .fillna(0, ["d", "c"])
    w_before = Window.partitionBy("cohort_months").orderBy("time_k") \
        .rowsBetween(Window.unboundedPreceding, -1)
    w_upto = Window.partitionBy("cohort_months").orderBy("time_k") \
        .rowsBetween(Window.unboundedPreceding, 0)
    w = Window.partitionBy("cohort_months").orderBy("time_k")
    ex = F.when(F.col("time_k") > 0, F.col("d") + F.col("c")).otherwise(F.lit(0))
    curve = curve.withColumn("risk", F.greatest(F.lit(0), F.col("n_all") - F.coalesce(F.sum(ex).over(w_before),
                                                                                      F.lit(0))))
    curve = curve.withColumn("h", F.when((F.col("time_k") > 0) & (F.col("risk") > 0),
                                         F.least(F.lit(1.0), F.col("d") / F.col("risk"))).otherwise(F.lit(0.0)))
    curve = curve.withColumn("s", F.product(1 - F.col("h")).over(w_upto))
    curve = curve.withColumn("q", F.coalesce(F.greatest(F.lit(0.0), F.lag("s").over(w) - F.col("s")),
                                             F.lit(0.0)))
    return curve.select(fs.alias("fit_window_start"), fe.alias("fit_window_end"), F.lit("week").alias("time_unit"),
                        F.col("cohort_months").cast("int").alias("cohort_months"),
                        F.col("time_k").cast("int").alias("time_k"),
                        F.round("s", 12).alias("s"), F.round("q", 12).alias("q"), F.round("h", 12).alias("h"))


def replace_slice(models: DataFrame, fresh: DataFrame, fit_start: date, fit_end: date,
                  time_unit: str = "week") -> DataFrame:
    """Delete the fit window's rows (a filter on the window parameters), insert the new curve."""
    fs, fe = (F.lit(x.isoformat()).cast("date") for x in (fit_start, fit_end))
    in_slice = (F.col("fit_window_start") == fs) & (F.col("fit_window_end") == fe) & \
        (F.col("time_unit") == time_unit)
    return models.filter(~F.coalesce(in_slice, F.lit(False))).unionByName(fresh)


def should_retrain(versions: DataFrame, models: DataFrame, fit_start: date, fit_end: date) -> bool:
    """Skip when an active version and a curve for the window both exist (two tiny probes)."""
    fs, fe = (F.lit(x.isoformat()).cast("date") for x in (fit_start, fit_end))
    in_window = (F.col("fit_window_start") == fs) & (F.col("fit_window_end") == fe) & (F.col("time_unit") == "week")
    has_active = not versions.filter(in_window & (F.col("status") == "active")).isEmpty()
    has_km = not models.filter(in_window).isEmpty()
    return not (has_active and has_km)


def activate_version(versions: DataFrame, fit_start: date, fit_end: date, horizon: int, stamp, by: str,
                     notes: str) -> DataFrame:
    """Upsert the window's version row with status 'active'."""
    spark = versions.sparkSession
    row = spark.createDataFrame(
        [(fit_start, fit_end, "week", horizon, "active", stamp, by, notes)],
        "fit_window_start date, fit_window_end date, time_unit string, horizon_weeks int, status string, "
        "created_at timestamp_ntz, created_by string, notes string")
    fs, fe = (F.lit(x.isoformat()).cast("date") for x in (fit_start, fit_end))
    same = (F.col("fit_window_start") == fs) & (F.col("fit_window_end") == fe) & (F.col("time_unit") == "week")
    return versions.filter(~F.coalesce(same, F.lit(False))).unionByName(row)
