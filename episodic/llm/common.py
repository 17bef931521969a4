"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from episodic.operators.sinks import materialize
from episodic.session import scratch_path

#: A word of the contracts: no ASCII white space inside.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` for texts and packed arrays: written to the shared folder with a denser compression."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def crc_of_id(c: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary"))


def slices(batch, column: str, limit: int = 4 << 20, overhead: int = 64):
    """Cut an Arrow batch into runs of rows of about ``limit`` bytes of text (and ``overhead`` a row), so that work arrays stay bounded."""
    col = batch.column(column)
    start, held = 0, 0
    for i, v in enumerate(col):
        n = overhead + (v.as_buffer().size if v.is_valid else 0)
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def small_batches(spark: SparkSession) -> None:
    """Rows cross to the Python workers a thousand at a time: with whole documents in them, the default of 10,000 holds several
    copies of tens of megabytes beside the heap, in the executor and in the worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def give_back() -> None:
    """Returns memory that a finished task leaves behind in its worker, which lives on for other tasks and stages."""
    _POW.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):        # not a glibc
        pass


def released(fn):
    """A ``mapInArrow`` function after whose end the worker's memory is given back."""
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            give_back()

    return run


_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), vectorised."""
    with np.errstate(over="ignore"):
        x = x + _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW.get("up", ())) < n:
        size = max(1 << 16, 1 << n.bit_length())
        with np.errstate(over="ignore"):
            _POW["up"] = np.cumprod(np.concatenate([[_U(1)], np.full(size, _BASE, _U)]), dtype=_U)
            _POW["down"] = np.cumprod(np.concatenate([[_U(1)], np.full(size, _INV, _U)]), dtype=_U)
    return _POW["up"], _POW["down"]


def word_hashes(data: np.ndarray, piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and first byte of every word of a UTF-8 byte array (words end at ASCII white space).

    The hash of a word is its polynomial in an odd base, read from one running
    sum over the bytes, so no Python code runs per word. Long arrays are cut at
    white space into pieces; a longer word only makes its piece longer.
    """
    n, at, hs, starts = len(data), 0, [], []
    while at < n:
        end = min(n, at + piece)
        while end < n and not _SPACE[data[end]]:
            nxt = np.flatnonzero(_SPACE[data[end:end + piece]])
            end = end + int(nxt[0]) if len(nxt) else min(n, end + piece)
        part = data[at:end]
        word = ~_SPACE[part]
        edge = np.diff(word.astype(np.int8), prepend=0, append=0)
        lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = _powers(len(part))
        with np.errstate(over="ignore"):
            run = np.concatenate([[_U(0)], np.cumsum((part.astype(_U) + _U(1)) * up[:len(part)], dtype=_U)])
            h = (run[hi] - run[lo]) * down[lo]
        hs.append(mix64(h ^ (hi - lo).astype(_U)))
        starts.append(lo + at)
        at = end
    if not hs:
        return np.empty(0, _U), np.empty(0, np.int64)
    return np.concatenate(hs), np.concatenate(starts)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(id, component)``, component = the smallest id reachable.

    Alternates large-star and small-star steps: each is one grouped minimum and
    one join, so no vertex's neighbours are ever held in memory, and a star or
    chain of any size settles in a logarithmic number of rounds. Every round is
    written to the shared folder, which cuts the lineage. Ids are 64-bit.
    """
    e = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where("u <> v").distinct(), name)
    seen = None
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: every larger neighbour of u is linked to the smallest of u and its neighbours
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: u and its smaller neighbours are linked to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = materialize(small, name)
        row = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == (row["n"], row["h"]):
            break
        seen = (row["n"], row["h"])
    return e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component")
