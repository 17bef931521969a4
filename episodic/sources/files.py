"""File sources: CSV worklists (A10/A11), CSV snapshots (B5), optional targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def read_or_empty(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The stored target, or an empty frame of the contract schema when it is missing."""
    if _exists(spark, path):
        return spark.read.format(fmt).schema(schema).load(path)
    return spark.createDataFrame([], schema)


def read_csv_worklist(spark: SparkSession, path: str, schema: StructType | None = None,
                      trim_strings: bool = True) -> DataFrame:
    """A header CSV list; every string column trimmed.

    With no schema all columns are read as strings (what a sheet export
    holds); types are applied later by the caller with try_* casts.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    df = reader.schema(schema).csv(path) if schema is not None else reader.csv(path)
    if trim_strings:
        df = df.select(*[F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType)
                         else F.col(f.name) for f in df.schema.fields])
    return df


def write_csv_snapshot(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Project to the published column list (missing -> typed null), then write."""
    if columns is not None:
        present = set(df.columns)
        df = df.select(*[F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in columns])
    # whole microseconds: the default keeps milliseconds
    df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)
