"""Data-quality checks (L1-L4): unique, not_null, accepted values.

All checks of one table share one scan and one grouped aggregate over its key
(partial counts before the shuffle, so a repeated key stays small); the report
is the union of one row per check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_table(table_name: str, df: DataFrame, key: Sequence[str], accepted: Mapping[str, Sequence] | None = None) -> DataFrame:
    """(table_name, check_name, failures): keys occurring more than once, rows with a null in the key, and for each column of
    ``accepted`` the rows with another value or none."""
    accepted = accepted or {}
    bad = {c: F.col(c).isNull() | ~F.col(c).isin(list(v)) for c, v in accepted.items()}
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(b).alias(f"_bad_{c}") for c, b in bad.items()])
    any_null = F.lit(False)
    for c in key:
        any_null = any_null | F.col(c).isNull()
    names = ",".join(key)
    checks = {f"unique({names})": F.count_if(F.col("_n") > 1),
              f"not_null({names})": F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0)),
              **{f"accepted({c})": F.coalesce(F.sum(f"_bad_{c}"), F.lit(0)) for c in bad}}
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), v.cast("bigint").alias("failures")) for n, v in checks.items()])
    return per_key.agg(rows.alias("_r")).select(F.lit(table_name).alias("table_name"), F.explode("_r").alias("_c")) \
        .select("table_name", "_c.check_name", "_c.failures")


def quality_report(checks: Sequence[tuple]) -> DataFrame:
    """checks: (table_name, df, key, accepted)."""
    out = None
    for c in checks:
        r = check_table(*c)
        out = r if out is None else out.unionByName(r)
    return out


def assert_clean(report: DataFrame) -> None:
    """Raise if any check failed (for pipelines that must stop on bad data)."""
    bad = report.filter(F.col("failures") > 0).collect()   # one row per check
    if bad:
        raise AssertionError("data-quality checks failed: " + ", ".join(
            f"{r.table_name}.{r.check_name}={r.failures}" for r in bad))
