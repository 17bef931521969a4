"""Table sinks that survive re-runs and lost executors.

Parquet tables have no UPDATE, so every refresh writes a complete new
version under ``<root>/v<NNNNNN>`` and readers take the highest complete one.
A version is written before it becomes visible (Spark's commit protocol
publishes the folder only after every task succeeded), the previous version
is never overwritten while it is being read, and a failed attempt can be
re-run with the same version number (the write overwrites that folder).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, root: str) -> list[int]:
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v") and name[1:].isdigit() and fs.exists(
                spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(name[1:]))
    return sorted(out)


def read_latest(spark: SparkSession, root: str, schema: StructType, below: int | None = None) -> DataFrame:
    """The newest complete version (optionally the newest strictly below ``below``), or an empty frame."""
    vs = [v for v in versions(spark, root) if below is None or v < below]
    if not vs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/v{vs[-1]:06d}")


def write_version(df: DataFrame, root: str, version: int) -> str:
    """B1: replace-whole-table as a new version folder (idempotent for one version number)."""
    path = f"{root}/v{version:06d}"
    df.write.mode("overwrite").parquet(path)
    return path


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to the contract; missing columns become typed nulls, extra ones are dropped."""
    present = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a new folder under the shared checkpoint dir and read it back.

    Used where one intermediate feeds several branches of a plan (a stored
    table in production): it is computed once, its lineage is cut, and a
    lost executor re-reads files instead of recomputing shuffles.
    """
    from episodic.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def save_in_schema(df: DataFrame, name: str, schema: str | None = None) -> str:
    """Write ``df`` as table ``<schema>.<name>`` (schema ``public`` where none is given); returns the qualified name.

    The schema and every written version lie below the shared folder, and a rewrite takes a new path."""
    from episodic.session import scratch_path
    spark, schema = df.sparkSession, (schema or "public").strip()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}` LOCATION '{scratch_path(spark, schema)}'")
    df.write.mode("overwrite").option("path", scratch_path(spark, f"{schema}_{name}")).saveAsTable(f"`{schema}`.`{name}`")
    return f"`{schema}`.`{name}`"
