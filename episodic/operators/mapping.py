"""Declared source-to-target mappings (A3, B6, B7, K32): one description drives extract, insert and delete-then-reload.

A ``Mapping`` names the target, its key and, for every target column, the source column and its type. Rows are always
selected by name: a source whose columns come in another order, or with more columns than listed, gives the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from episodic.operators.buckets import BucketTable, Version


@dataclass(frozen=True)
class Mapping:
    target: str
    key: tuple[str, ...]
    #: target column -> (source column, type); a source column of None pads with typed nulls
    columns: dict[str, tuple[str | None, str]]
    #: rows to extract, as a SQL condition on source columns
    where: str | None = None
    #: (source columns by falling order, n): only the newest n rows are extracted
    newest: tuple[tuple[str, ...], int] | None = None

    @property
    def schema(self) -> StructType:
        return StructType([StructField(c, StructType.fromDDL(f"x {t}")["x"].dataType) for c, (_, t) in self.columns.items()])

    def extract(self, source: DataFrame) -> DataFrame:
        """The mapped rows of ``source``; the column list reaches its scan."""
        df = source.where(self.where) if self.where else source
        if self.newest:
            by, n = self.newest
            df = df.orderBy(*[F.col(c).desc_nulls_last() for c in by]).limit(n)
        missing = [s for s, _ in self.columns.values() if s is not None and s not in source.columns]
        if missing:
            raise ValueError(f"{self.target}: the source lacks {', '.join(missing)}")
        return df.select(*[(F.col(s) if s is not None else F.lit(None)).cast(t).alias(c) for c, (s, t) in self.columns.items()])

    def table(self, spark: SparkSession, root: str, buckets: int = 64) -> BucketTable:
        return BucketTable(spark, root, self.schema, self.key, buckets)


def insert(table: BucketTable, mapping: Mapping, source: DataFrame, version: int | None = None) -> Version:
    """Appends the extract; stored rows stay as they are. A repeated run passes its version again and adds nothing twice."""
    return table.append(mapping.extract(source), table.next_version() if version is None else version, lambda stored, new: new)


def reload(table: BucketTable, mapping: Mapping, source: DataFrame, version: int | None = None) -> Version:
    """Deletes all rows and inserts the extract, in one published version (no reader sees the table empty)."""
    return table.replace(mapping.extract(source), table.next_version() if version is None else version)


def top_k_left_join(left: DataFrame, right: DataFrame, on: Column, left_key: str, right_key: str, left_order: list[Column],
                    order: list[Column], k: int) -> DataFrame:
    """``left LEFT JOIN right ORDER BY left_order, order LIMIT k`` without joining all of ``left``.

    A left join never lowers the number of rows, so the first ``k`` rows of the result come from the first ``k`` rows of
    ``left``. Only these (at most ``k`` rows, hence the broadcast) meet ``right``, whose other rows are not shuffled."""
    chosen = left.orderBy(*left_order).limit(k)
    ids = F.broadcast(chosen.select(F.col(left_key).alias("_chosen")).distinct())
    near = right.join(ids, F.col(right_key) == F.col("_chosen"), "left_semi")
    return chosen.join(near, on, "left").orderBy(*left_order, *order).limit(k)


def gated(as_of: Column, rows: DataFrame, sinks: list[tuple[BucketTable, Column]], version: int) -> list[Version | None]:
    """``rows`` replace each sink whose gate (a condition on ``as_of``) is true; the source is read once.

    The first sink's new version is what the others copy."""
    spark = rows.sparkSession
    gates = spark.range(1).select(*[g.alias(f"g{i}") for i, (_, g) in enumerate(
        [(t, F.coalesce(c, F.lit(False))) for t, c in sinks])], as_of.alias("as_of")).first()
    out, held = [], None
    for i, (table, _) in enumerate(sinks):
        if not gates[f"g{i}"]:
            out.append(None)
            continue
        out.append(table.replace(rows if held is None else held.read(), version))
        held = held or table
    return out


def is_month_end(day: Column) -> Column:
    """Tomorrow is the first of a month."""
    return F.dayofmonth(F.date_add(day, 1)) == 1
