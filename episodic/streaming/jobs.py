"""Structured Streaming forms of the incremental jobs.

The reference runs its mirrors on a cron; here each run is an
``availableNow`` trigger over a file inbox: it processes whatever arrived
since the last run and stops, with progress and operator state kept in a
checkpoint on shared storage (so a lost executor or a re-run resumes
exactly where the last committed batch ended).

* J1 ``mirror``: foreachBatch -> newest row per key of (stored target + batch)
  in a bucketed table: only the buckets of the batch's keys are rewritten
  (idempotent per batch id).
* J2 ``changes``: the latest state of every key is kept in the state store,
  in buckets of keys; a key emits a row only when its state is new or differs.
  The rows of a micro-batch go to a folder of their own (overwritten on a
  replay), and no stored table is read.
* J3/J4 ``weekly``: event-time weeks starting Monday; each batch adds its
  counts to the stored table by (week, key), so a row corrects its week
  however late it comes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import ArrayType, DateType, LongType, StructField, StructType

from episodic.operators.buckets import BucketTable
from episodic.operators.incremental import latest_per_key
from episodic.operators.sinks import read_latest, write_version
from episodic.operators.windows import _encode


def _start(writer, available_now: bool = True) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_once(q: StreamingQuery) -> None:
    """Wait for an availableNow run to finish, however long it takes (raises the query's error, if any)."""
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def mirror(spark: SparkSession, inbox: str, target: BucketTable, order: Sequence[Column], checkpoint: str) -> StreamingQuery:
    """Micro-batch mirror upsert (A4 + G1 + B1) into a bucketed table keyed as the mirror is."""
    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        # one row a key before anything is shuffled: a hot key is cut within the tasks that read it
        newest = latest_per_key(batch, target.keys, order)
        target.merge(newest, batch_id, lambda stored, new: latest_per_key(stored.unionByName(new), target.keys, order))

    src = spark.readStream.schema(target.schema).parquet(inbox)
    return _start(src.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", checkpoint))


def changes(spark: SparkSession, inbox: str, schema: StructType, key: str, state: str, order: Sequence[str],
            history_root: str, checkpoint: str, buckets: int = 1024) -> StreamingQuery:
    """Append-on-change history of ``state`` per ``key`` (G4), by keyed state.

    A key's state in a micro-batch is that of its newest row there (largest in the columns ``order``, nulls oldest). It is
    compared null-safely with the state kept for the key, and emitted where it is new or differs.

    The state store holds the keys by bucket of their hash, so one call of ``step`` takes all keys of a bucket: a micro-batch
    costs at most ``buckets`` calls, however many keys it has. Like the number of state partitions, ``buckets`` is fixed for
    the life of a checkpoint; a task holds the keys of one bucket at a time."""
    cols = [key, state, *(c for c in order if c not in (key, state))]
    out_schema = StructType([schema[key], schema[state]])
    # (is-null flag, value) pairs: no column changes its type in pandas because of a null
    src, names = _encode(spark.readStream.schema(schema).parquet(inbox).select(*cols), cols)
    pair = {c: names[2 * i:2 * i + 2] for i, c in enumerate(cols)}
    src = src.select(F.pmod(F.xxhash64(*pair[key]), F.lit(buckets)).cast("int").alias("_bucket"), *names)
    moved = StructType([f for f in src.schema if f.name in pair[key] + pair[state]])
    held = StructType([StructField(f.name, ArrayType(f.dataType)) for f in moved])
    by_age = [n for c in order for n in pair[c]]
    falling = [i % 2 == 0 for i in range(len(by_age))]      # nulls (flag true) last, values largest first

    def newest(pdf):
        return pdf.sort_values(by_age, ascending=falling, kind="stable").drop_duplicates(pair[key])

    def thin(pdfs):
        """A stateless cut to the newest row a key of every Arrow batch, so that a hot key reaches its task as few rows."""
        for pdf in pdfs:
            yield newest(pdf)

    def step(bucket, pdfs, kept):
        import pandas as pd
        best = None
        for pdf in pdfs:
            best = newest(pdf if best is None else pd.concat([best, pdf]))
        if best is None:
            return
        width = len(pair[key])
        last = {row[:width]: row[width:] for row in zip(*kept.get)} if kept.exists else {}
        rows = list(zip(*(best[n].tolist() for n in moved.names)))
        new = [row for row in rows if last.get(row[:width]) != row[width:]]
        if new:
            last.update((row[:width], row[width:]) for row in new)
            kept.update(tuple(map(list, zip(*(k + v for k, v in last.items())))))
            yield pd.DataFrame(new, columns=moved.names)

    def log_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{history_root}/batch_id={batch_id}")

    found = src.mapInPandas(thin, src.schema).groupBy("_bucket").applyInPandasWithState(
        step, moved, held, "append", GroupStateTimeout.NoTimeout)
    found = found.select(*[F.when(~F.col(pair[c][0]), F.col(pair[c][1])).alias(c) for c in out_schema.names])
    return _start(found.writeStream.foreachBatch(log_batch).outputMode("append").option("checkpointLocation", checkpoint))


def weekly(spark: SparkSession, inbox: str, schema: StructType, ts: str, group: str, target: str,
           checkpoint: str) -> StreamingQuery:
    """Rows per (Monday week, group). However late a row comes, its week is corrected.

    Counts add up, so each micro-batch adds its own (few) partial counts to the stored table; nothing waits in
    operator state and no watermark drops a row. A replayed batch starts from the version below its own, so no row
    counts twice."""
    out_schema = StructType([StructField("week_start", DateType()), schema[group],
                             StructField("n_rows", LongType(), False)])
    key = ["week_start", group]

    def add_batch(batch: DataFrame, batch_id: int) -> None:
        stored = read_latest(spark, target, out_schema, below=batch_id)
        fresh = batch.groupBy(F.date_trunc("week", ts).cast("date").alias("week_start"), group).agg(
            F.count(F.lit(1)).alias("n_rows"))
        write_version(stored.unionByName(fresh).groupBy(*key).agg(F.sum("n_rows").alias("n_rows")), target, batch_id)

    src = spark.readStream.schema(schema).parquet(inbox)
    return _start(src.writeStream.foreachBatch(add_batch).option("checkpointLocation", checkpoint))
