"""Named queries: each pairs a Spark plan with the DuckDB SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from episodic.sources.tables import load


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    ops: str


REGISTRY: dict[str, Query] = {}


def register(name: str, ops: str, oracle: str | None = None):
    def deco(fn: Callable[[SparkSession, load], DataFrame]):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            # wall-clock data: conversions to instants (watermarks) are defined in UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, load(spark, sf_dir))
        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, build, oracle, ops)
        return fn
    return deco


# Fixed reference times of the stand-in data.
AS_OF_EVENTS = datetime(2024, 1, 31)
AS_OF_ORDERS = datetime(1998, 9, 1)


def ts(value: str | datetime) -> Column:
    """Wall-clock timestamp literal (TIMESTAMP_NTZ), constant-folded into scans."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(value).cast("timestamp_ntz")


def d(value: str | date) -> Column:
    if isinstance(value, date):
        value = value.isoformat()
    return F.lit(value).cast("date")


def money(c: Column | str) -> Column:
    """Exact sum of currency-like doubles: add as decimal, report as double."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast("decimal(18,2)")).cast("double")
