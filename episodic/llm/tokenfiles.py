"""Token counts by separator scan over flat token files that have no index.

A token file is a stream of 16-bit token ids, each document followed by the
end-of-document id, cut into blocks of ``BLOCK`` ids without regard to documents
(rows ``file, block, tokens``, kept as Parquet so that any store Spark reads will
do). The scan searches every block for the separator with one vectorised
comparison, independently of all others. A document that crosses blocks is put
together by a prefix scan over the blocks' totals: ids before the block, the
position of the last separator before it, and separators before it. No block
needs another's ids, so a file of any length is read by many tasks.

Edge cases: a document without tokens (null or empty text) counts 0; ids after
the last separator are a last, unended document (``ended`` false); an empty file
or table gives no rows; a missing block is not noticed, as the files have no index.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from episodic.llm import bpe
from episodic.llm.common import slices
from episodic.session import scratch_path

BLOCK = 1 << 16
SEPARATOR = 49407        # <|endoftext|> of the vocabulary


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, separator: int = SEPARATOR) -> None:
    """Encodes every whole text into token files below ``path``; the order of the documents in each file goes to a folder beside them."""

    def encode(batches):
        file, block, rest, order = TaskContext.get().partitionId(), 0, np.empty(0, np.uint16), 0
        end = np.array([separator], np.uint16)
        cols = ("kind", "file", "block", "tokens", "ids")
        types = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], cols)

        tok = bpe.tokenizer(vocabulary)
        for batch in batches:
            for piece in slices(batch, "text"):
                ids, parts = piece.column("doc_id").to_pylist(), [rest]
                rows = [("order", file, order, None, ids)]
                order += len(ids)
                for raw, _ in tok.encode_many(piece.column("text").to_pylist(), special_as_text=True):
                    parts += [np.frombuffer(raw, np.uint32).astype(np.uint16), end]
                full = np.concatenate(parts)
                n = len(full) // BLOCK
                rows += [("tokens", file, block + i, full[i * BLOCK:(i + 1) * BLOCK].tobytes(), None) for i in range(n)]
                block, rest = block + n, full[n * BLOCK:].copy()
                yield out(rows)
        tok.forget()
        while len(rest):
            yield out([("tokens", file, block, rest[:BLOCK].tobytes(), None)])
            block, rest = block + 1, rest[BLOCK:]

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .mapInArrow(encode, "kind string, file long, block long, tokens binary, ids array<long>")
     .write.partitionBy("kind").parquet(path))


def _read(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    # the base folder keeps a listing of an empty write from failing
    return spark.read.schema(schema + ", kind string").parquet(path).where(F.col("kind") == kind).drop("kind")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, "tokens", "file long, block long, tokens binary")


def read_order(spark: SparkSession, path: str) -> DataFrame:
    """(file, ordinal, doc_id): which document stands where."""
    o = _read(spark, path, "order", "file long, block long, ids array<long>")
    return o.select("file", "block", F.posexplode("ids").alias("i", "doc_id")).select(
        "file", (F.col("block") + F.col("i")).alias("ordinal"), "doc_id")


def scan(blocks: DataFrame, separator: int = SEPARATOR, dtype: str = "<u2") -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) of every document of ``blocks(file, block, tokens)``."""

    def search(batches):
        for batch in batches:
            rows = []
            for b in batch.column("tokens").to_pylist():
                ids = np.frombuffer(b or b"", dtype)
                at = np.flatnonzero(ids == separator)
                rows.append((len(ids), len(at), int(at[-1]) + 1 if len(at) else None, at))
            n, k, last, at = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array(n, pa.int64()), pa.array(k, pa.int64()),
                 pa.array(last, pa.int64()), pa.array(list(at), pa.list_(pa.int64()))],
                ["file", "block", "n", "ends", "last", "at"])

    found = blocks.select("file", "block", "tokens").mapInArrow(
        search, "file long, block long, n long, ends long, last long, at array<long>")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n").over(before), F.lit(0))
    placed = found.withColumn("offset", offset).withColumn("ordinal", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    # where the document open at the block's start began
    placed = placed.withColumn("open", F.coalesce(F.max(F.col("offset") + F.col("last")).over(before), F.lit(0)))
    ended = placed.select("file", "ordinal", "offset", "open", "at", F.posexplode("at").alias("i", "pos")).select(
        "file", (F.col("ordinal") + F.col("i")).alias("ordinal"),
        F.when(F.col("i") == 0, F.col("open")).otherwise(F.col("offset") + F.get("at", F.col("i") - 1) + 1).alias("start"),
        (F.col("offset") + F.col("pos")).alias("end"), F.lit(True).alias("ended"))
    tails = placed.groupBy("file").agg(F.sum("ends").alias("ordinal"), F.sum("n").alias("end"),
                                       F.coalesce(F.max(F.col("offset") + F.col("last")), F.lit(0)).alias("start")).where("end > start")
    every = ended.unionByName(tails.select("file", "ordinal", "start", "end", F.lit(False).alias("ended")))
    return every.select("file", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "ended")


def count_tokens(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, file, ordinal, start of every document: texts are written as token files and counted from these alone."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path)
    return (scan(read_blocks(spark, path)).join(read_order(spark, path), ["file", "ordinal"])
            .select("doc_id", "n_tokens", "file", "ordinal", "start"))
