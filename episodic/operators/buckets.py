"""Bucketed copy-on-write tables (B2, B8, B15, B17, B20): a batch rewrites only the key buckets it touches.

A table is a folder of data folders and manifests. Every row lies in the bucket of its key's hash; a version is a
manifest that names, for each bucket, the folders holding its rows. A batch reads the buckets its keys fall into, writes
these buckets' new rows into a fresh data folder and publishes a manifest in which only their entries differ: the cost of a
batch follows the buckets touched, not the table. Data folders are never written twice, so readers of an older version
are undisturbed, a batch that dies leaves nothing visible, and a replayed batch starts from the version below its own and
publishes an equal version. Rows that are only added (``append``) leave the bucket's folders as they are and add one; a
bucket of ``COMPACT`` folders is rewritten into one.

A contract (see ``contracts``) is checked while the new folder is written; a batch that breaks it is never published.

The driver holds one entry a bucket (``buckets`` is a fixed number of the table), never anything that grows with its rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from episodic.operators.contracts import Contract, check_write
from episodic.operators.sinks import _fs, conform, versions

COMPACT = 8
_MANIFEST = "bucket int, folder string"


@dataclass(frozen=True)
class Version:
    """One published version: number, buckets whose rows were written for it, and the whole manifest."""
    number: int
    written: tuple[int, ...]
    folders: dict[int, tuple[str, ...]]
    rules: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class BucketTable:
    spark: SparkSession
    root: str
    schema: StructType
    keys: tuple[str, ...]
    buckets: int = 64
    contract: Contract | None = None

    # ---- reading

    def versions(self) -> list[int]:
        return versions(self.spark, f"{self.root}/manifest")

    def manifest(self, below: int | None = None) -> Version | None:
        """The newest version (strictly below ``below``), or None."""
        found = [v for v in self.versions() if below is None or v < below]
        if not found:
            return None
        folders: dict[int, list[str]] = {}
        for r in self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/v{found[-1]:06d}").orderBy("bucket", "folder").collect():
            folders.setdefault(r["bucket"], []).append(r["folder"])
        return Version(found[-1], (), {b: tuple(f) for b, f in folders.items()})

    def read(self, below: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The rows of the newest version (below ``below``), of all buckets or of some."""
        return self._rows(self.manifest(below), only)

    def _rows(self, version: Version | None, only: Sequence[int] | None = None) -> DataFrame:
        entries = version.folders if version else {}
        paths = [f"{self.root}/{f}" for b, fs in entries.items() if only is None or b in only for f in fs]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _conform(self, df: DataFrame) -> DataFrame:
        return self.contract.conform(df) if self.contract else conform(df, self.schema)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    # ---- writing

    def merge(self, batch: DataFrame, version: int, how: Callable[[DataFrame, DataFrame], DataFrame]) -> Version:
        """Publishes ``how(stored, batch)`` as ``version``; only buckets of the batch's keys are read and written.

        ``how`` sees the stored rows of these buckets and the batch, and must decide key by key."""
        batch = self._conform(batch)
        base = self.manifest(below=version)
        touched = self._touched(batch)
        if base is not None and not touched:
            return base
        return self._publish(base, version, touched, how(self._rows(base, touched), batch))

    def replace(self, rows: DataFrame, version: int) -> Version:
        """Publishes exactly ``rows`` as ``version``."""
        return self._publish(None, version, list(range(self.buckets)), self._conform(rows))

    def append(self, batch: DataFrame, version: int, fresh: Callable[[DataFrame, DataFrame], DataFrame]) -> Version:
        """Publishes the stored rows and ``fresh(stored, batch)``, the batch's rows that are new; no stored row is rewritten
        (but for a bucket that has ``COMPACT`` folders already)."""
        batch = self._conform(batch)
        base = self.manifest(below=version)
        touched = self._touched(batch)
        if base is not None and not touched:
            return base
        full = [b for b in touched if base and len(base.folders.get(b, ())) >= COMPACT]
        rows = fresh(self._rows(base, touched), batch)
        if full:
            rows = rows.unionByName(self._rows(base, full))
        return self._publish(base, version, full, rows)

    def _touched(self, batch: DataFrame) -> list[int]:
        # at most one row a bucket reaches the driver
        return sorted(r[0] for r in batch.select(self.bucket().alias("b")).distinct().collect())

    def _publish(self, base: Version | None, version: int, replaced: Sequence[int], rows: DataFrame) -> Version:
        name = f"data/v{version:06d}-{uuid.uuid4().hex[:12]}"
        # one task a bucket, but a large bucket is split by its size at run time (rebalance)
        laid = conform(rows, self.schema).withColumn("_bucket", self.bucket()).hint("rebalance", F.col("_bucket"))
        rules = check_write(laid, f"{self.root}/{name}", self.contract, partition_by="_bucket")
        fs, path = _fs(self.spark, f"{self.root}/{name}")
        held = [st.getPath().getName() for st in fs.listStatus(path)]
        written = sorted(int(h.split("=")[1]) for h in held if h.startswith("_bucket="))
        gone = set(replaced)
        folders = {b: f for b, f in (base.folders if base else {}).items() if b not in gone}
        for b in written:
            folders[b] = (*folders.get(b, ()), f"{name}/_bucket={b}")
        entries = [(b, f) for b, fs_ in folders.items() for f in fs_]
        self.spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/manifest/v{version:06d}")
        return Version(version, tuple(written), folders, rules)

    def next_version(self) -> int:
        vs = self.versions()
        return vs[-1] + 1 if vs else 0
