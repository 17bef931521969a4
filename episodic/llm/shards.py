"""Sharding by best-fit-decreasing bin packing of indivisible groups (all copies of one text stay together).

Best fit: groups enter by falling size, each into the bin with the tightest
remaining capacity that still holds it; the open bins are kept in a balanced
tree ordered by remaining capacity.

One pass over all groups would be one task's work, so it runs twice. First every
hash range of groups (at most about ``RANGE`` groups) is packed into bricks, bins
of a small fixed capacity; then the bricks, a bounded fraction of the groups,
are packed into the shards. A group larger than a brick is a brick of its own.
Slots count through a shard brick by brick; a brick of many rows (a hot group)
is numbered in several ranges of a hash of the id.

Edge cases: a null text has size 1 like the empty one, checksum 0, and shares a
group with the other nulls; repeated rows get slots of their own; a group larger
than a shard makes that shard larger; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episodic.operators.sinks import materialize

RANGE = 100_000          # groups packed by one task in the first pass
BRICKS = 64              # bricks of a shard, at least
NODE = 512


class Capacities:
    """Balanced two-level tree of (remaining capacity, bin): nodes of at most NODE entries, split when full."""

    def __init__(self):
        self.nodes: list[list[tuple[int, int]]] = [[]]
        self.last: list[tuple[int, int]] = []        # largest entry of each node but the final one

    def add(self, room: int, bin_: int) -> None:
        i = bisect_left(self.last, (room, bin_))
        node = self.nodes[i]
        insort(node, (room, bin_))
        if len(node) > NODE:
            half = len(node) // 2
            self.nodes[i:i + 1] = [node[:half], node[half:]]
            self.last.insert(i, node[half - 1])

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the entry with the least room of at least ``size``."""
        i = bisect_left(self.last, (size, -1))
        j = bisect_left(self.nodes[i], (size, -1))
        if j == len(self.nodes[i]):
            i, j = i + 1, 0
            while i < len(self.nodes) and not self.nodes[i]:
                i += 1
            if i >= len(self.nodes):
                return None
        return self._pop(i, j)

    def take_roomiest(self) -> tuple[int, int] | None:
        i = len(self.nodes) - 1
        while i > 0 and not self.nodes[i]:
            i -= 1
        return self._pop(i, len(self.nodes[i]) - 1) if self.nodes[i] else None

    def _pop(self, i: int, j: int) -> tuple[int, int]:
        node = self.nodes[i]
        out = node.pop(j)
        if not node and len(self.nodes) > 1:
            del self.nodes[i]
            del self.last[min(i, len(self.last) - 1)]
        return out


def best_fit(sizes: list[int], capacity: int, bins: int | None = None) -> list[int]:
    """Bin of each item, given by falling size. ``bins``: open that many and never more (what fits nowhere enters the roomiest)."""
    tree, n, out = Capacities(), bins or 0, []
    for b in range(n):
        tree.add(capacity, b)
    for s in sizes:
        got = tree.take_tightest(s)
        if got is None and bins:
            got = tree.take_roomiest()
        if got is None:
            got = (max(capacity, s), n)
            n += 1
        tree.add(got[0] - s, got[1])
        out.append(got[1])
    return out


def _pack(t: pa.Table, capacity: int, bins: int | None, first: int) -> list[int]:
    """Bins of a table's rows (columns key, bytes) in its own order."""
    key, size = t.column("key").to_pylist(), t.column("bytes").to_pylist()
    order = sorted(range(len(key)), key=lambda i: (-size[i], key[i]))
    out = [0] * len(key)
    for i, b in zip(order, best_fit([size[i] for i in order], capacity, bins)):
        out[i] = first + b
    return out


def pack(groups: DataFrame, capacity: int, shards: int | None = None) -> DataFrame:
    """Packs ``groups(key, bytes, rows)``: returns (key, bytes, rows, brick, shard).

    Shards hold ``capacity`` bytes; their number is what best fit needs, or exactly ``shards``.
    """
    n, total = groups.agg(F.count("*"), F.sum("bytes")).first()
    ranges = max(4, math.ceil(n / RANGE))
    brick = max(1, min(capacity // BRICKS, (total or 0) // (4 * ranges)))

    def first_pass(t: pa.Table) -> pa.Table:
        bins = _pack(t, brick, None, t.column("range")[0].as_py() << 32)
        return pa.table({"key": t.column("key"), "bytes": t.column("bytes"), "rows": t.column("rows"), "brick": pa.array(bins, pa.int64())})

    def second_pass(t: pa.Table) -> pa.Table:
        return pa.table({"brick": t.column("key"), "shard": pa.array(_pack(t, capacity, shards, 0), pa.int32())})

    placed = materialize(groups.withColumn("range", F.pmod(F.xxhash64("key"), F.lit(ranges))).groupBy("range")
                         .applyInArrow(first_pass, "key string, bytes long, rows long, brick long"), "shards-bricks")
    bricks = placed.groupBy("brick").agg(F.sum("bytes").alias("bytes")).select(F.col("brick").alias("key"), "bytes", F.lit(0).alias("all"))
    where = materialize(bricks.groupBy("all").applyInArrow(second_pass, "brick long, shard int"), "shards-where")
    return placed.join(where, "brick")


def place(docs: DataFrame, shards: int | None, capacity: int | None = None, rows_per_task: int = 200_000) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every document: ``shards`` shards of near equal bytes, or shards of ``capacity`` bytes."""
    light = materialize(docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null")).alias("key")), "shards-rows")
    groups = light.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    if capacity is None:
        total = light.agg(F.sum("size")).first()[0] or 0
        capacity = max(1, math.ceil(total / shards))
    placed = pack(groups, capacity, shards)
    ranges = placed.groupBy("brick", "shard").agg(F.ceil(F.sum("rows") / rows_per_task).cast("int").alias("parts"))
    where = placed.select("key", "brick", "shard").join(ranges.select("brick", "parts"), "brick")
    rows = light.join(where, "key").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    # rows of each (brick, part) by a small table, whose running sum gives the first slot
    counts = rows.groupBy("shard", "brick", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("brick", "part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("brick", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("brick", "part").orderBy("key", "doc_id")
    numbered = rows.withColumn("at", F.row_number().over(order) - 1)
    return (numbered.join(first, ["brick", "part"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("at")).cast("long").alias("slot")))


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document (law ``bytes``)."""
    return place(docs, shards).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                      F.lit(None).cast("int").alias("grown_shard"))
