"""Run ledger (A6): which interval a job has to read next.

The ledger is an append-only table of run events. A run's interval starts where the last *successful* run of its job
ended, whatever runs failed since, so no row is lost and none is read twice by runs that count. A job without a success
raises: its first interval has to be seeded by hand (``record`` with state ``success``).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "job string, run_id string, interval_start timestamp_ntz, interval_end timestamp_ntz, state string, seq int"


class NoSuccessfulRun(ValueError):
    pass


class RunLedger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        # an empty batch creates the table, so that reading it never depends on a first run
        if not self._exists():
            spark.createDataFrame([], EVENTS).write.mode("append").parquet(root)

    def _exists(self) -> bool:
        from episodic.operators.sinks import _fs
        fs, p = _fs(self.spark, self.root)
        return fs.exists(p)

    def events(self) -> DataFrame:
        return self.spark.read.schema(EVENTS).parquet(self.root)

    def record(self, job: str, run_id: str, start: datetime | None, end: datetime, state: str, seq: int = 0) -> None:
        """Appends one event; the write is committed as a whole or not at all."""
        self.spark.createDataFrame([(job, run_id, start, end, state, seq)], EVENTS).coalesce(1).write.mode("append").parquet(self.root)

    def runs(self) -> DataFrame:
        """One row per (job, run): its interval and its latest state."""
        return self.events().groupBy("job", "run_id").agg(
            F.max("interval_start").alias("interval_start"), F.max("interval_end").alias("interval_end"),
            F.max_by("state", "seq").alias("state"))

    def last_success(self, job: str, before: datetime) -> datetime:
        """End of the latest successful run of ``job`` that ended by ``before``; raises if there is none."""
        end = (self.runs().where((F.col("job") == job) & (F.col("state") == "success") & (F.col("interval_end") <= F.lit(before)))
               .agg(F.max("interval_end")).first()[0])
        if end is None:
            raise NoSuccessfulRun(f"no successful run of {job!r} ended by {before}")
        return end

    def run(self, job: str, run_id: str, end: datetime, body: Callable[[datetime, datetime], object]):
        """Runs ``body(start, end)`` on the interval since the last success and records how it ended.

        A failure is recorded and raised again; the next run then starts where this one did."""
        start = self.last_success(job, end)
        self.record(job, run_id, start, end, "running", 0)
        try:
            out = body(start, end)
        except BaseException:
            self.record(job, run_id, start, end, "failed", 1)
            raise
        self.record(job, run_id, start, end, "success", 1)
        return out


def within(ts: Column | str, start: datetime, end: datetime, kst: bool = False) -> Column:
    """``start <= ts < end`` as literals that reach the scan; ``kst`` renders UTC bounds nine hours on, in Korean wall-clock time."""
    from datetime import timedelta
    c = F.col(ts) if isinstance(ts, str) else ts
    shift = timedelta(hours=9 if kst else 0)
    return (c >= F.lit(start + shift).cast("timestamp_ntz")) & (c < F.lit(end + shift).cast("timestamp_ntz"))
