"""Table contracts that are checked while a batch is written (B15, E15, L1-L4 at write).

A contract declares a table's columns with their defaults, its key, the columns that must not be null, and its CHECK
rules. A batch is first conformed (missing columns are added with their default or as null, values cast); then it is
written to a folder nobody reads yet, and the rows that break NOT NULL and CHECK rules are counted in the same pass by
``DataFrame.observe``. Whether a key occurs twice is counted on the written folder by a partially aggregated groupBy, so
a key that holds most rows is no hot task. Only a batch without a failure may be published by the caller; otherwise
``ContractError`` carries the counts and the table keeps its version.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from episodic.operators.sinks import conform


@dataclass(frozen=True)
class Contract:
    schema: StructType
    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    #: rule name -> SQL condition; as in SQL, a row breaks it only where it is false (null passes)
    checks: Mapping[str, str] = field(default_factory=dict)
    #: column -> SQL value for batches that lack the column
    defaults: Mapping[str, str] = field(default_factory=dict)

    def conform(self, df: DataFrame) -> DataFrame:
        """The contract's columns in its types; a missing column is its default or null."""
        for c, value in self.defaults.items():
            if c not in df.columns:
                df = df.withColumn(c, F.expr(value))
        return conform(df, self.schema)

    def rules(self) -> list[Column]:
        """One count of broken rows per rule, and the number of rows."""
        out = [F.count(F.lit(1)).alias("rows")]
        for c in dict.fromkeys((*self.key, *self.not_null)):
            out.append(F.count(F.when(F.col(c).isNull(), 1)).alias(f"not_null({c})"))
        return out + [F.count(F.when(~F.expr(sql), 1)).alias(f"check({name})") for name, sql in self.checks.items()]


class ContractError(ValueError):
    """A batch broke its contract; ``counts`` holds broken rows (for the key: keys that occur twice) by rule."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        super().__init__(", ".join(f"{k}: {v}" for k, v in counts.items() if v and k != "rows"))


def check_write(df: DataFrame, path: str, contract: Contract | None, partition_by: str | None = None) -> dict[str, int]:
    """Writes ``df`` to the new folder ``path`` and returns the counts of its contract's rules.

    Raises ``ContractError`` after the write if any rule is broken: the folder exists then but must not be published."""
    counts: dict[str, int] = {}
    watch = Observation() if contract else None
    out = df.observe(watch, *contract.rules()) if contract else df
    writer = out.write.partitionBy(partition_by) if partition_by else out.write
    writer.parquet(path)
    if contract is None:
        return counts
    counts = {k: int(v or 0) for k, v in watch.get.items()}
    if contract.key and counts["rows"]:
        keys = df.sparkSession.read.parquet(path).groupBy(*contract.key).count()
        counts[f"unique({','.join(contract.key)})"] = keys.where("count > 1").count()
    if any(v for k, v in counts.items() if k != "rows"):
        raise ContractError(counts)
    return counts
