"""Table registry (A1/A2/A13): name -> spec, loaded lazily as DataFrames.

A ``TableSpec`` records the key and watermark column of a mirrored table,
the column list to extract (A3, column pruning reaches the Parquet scan)
and the columns never to copy downstream (privacy deny-list).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: tuple[str, ...]
    watermark: str | None = None
    inclusive: bool = False          # A5: '>=' scans (late duplicates removed by latest_per_key)
    columns: tuple[str, ...] | None = None
    deny: tuple[str, ...] = field(default_factory=tuple)


TABLES: dict[str, TableSpec] = {
    "region": TableSpec("region", ("r_regionkey",)),
    "nation": TableSpec("nation", ("n_nationkey",)),
    "customer": TableSpec("customer", ("c_custkey",)),
    "supplier": TableSpec("supplier", ("s_suppkey",)),
    "part": TableSpec("part", ("p_partkey",)),
    "orders": TableSpec("orders", ("o_orderkey",), watermark="o_orderdate"),
    "lineitem": TableSpec("lineitem", ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
                          watermark="l_shipdate"),
    "events": TableSpec("events", ("event_id",), watermark="ts"),
    "documents": TableSpec("documents", ("doc_id",)),
    "embeddings": TableSpec("embeddings", ("vec_id",)),
    "pages": TableSpec("pages", ("page_id",)),
    "benchmark": TableSpec("benchmark", ("item_id",)),
    "labels": TableSpec("labels", ("doc_id",)),
    "conversations": TableSpec("conversations", ("conv_id", "turn")),
}


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read one table of a data folder (``<base>/<name>.parquet``)."""
    spec = TABLES.get(name)
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    if spec is not None and spec.columns:
        df = df.select(*spec.columns)
    if spec is not None and spec.deny:
        df = df.drop(*spec.deny)
    return df


class load:
    """Attribute access to the tables of one folder: ``t = load(spark, d); t.orders``."""

    def __init__(self, spark: SparkSession, base: str):
        self._spark, self._base, self._frames = spark, base, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        # one DataFrame per table (file listing and footers are read once per query build)
        if name not in self._frames:
            self._frames[name] = table(self._spark, self._base, name)
        return self._frames[name]


def register_views(spark: SparkSession, base: str, names=None) -> None:
    """Expose the tables as temp views so SQL text and DataFrame code mix."""
    for n in names or TABLES:
        table(spark, base, n).createOrReplaceTempView(n)
