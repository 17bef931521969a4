"""Merkle manifest of a grouped table, its upper proofs made by a butterfly exchange.

Every row is a leaf (sha256 of its fields). The leaves of a group, in key order, are joined sixteen at a time until one
node, the group's subroot, remains; the subroots, in order of the group's name, are joined likewise to the root.

Leaves are cut into aligned partitions of ``PART`` = 16 x 16 x 16, so a partition's own levels need no other. Above
them the partitions exchange round by round: in round r the sixteen neighbours of a run, each holding the node of its
16^r partitions, meet in lanes (partitions of equal offset), swap their nodes and all hash the common ancestor. After
log16(partitions) rounds every partition holds all siblings above it; no pass goes down again. A short last run has
fewer partitions than lanes; its partitions then send to the lanes left over as well. No round brings more than sixteen
nodes together, and the rows exchanged are one a partition, whatever a group's size.

Positions come from one range shuffle of the leaf digests (never of the texts): sorted within ranges, numbered there,
and moved on by the rows of the ranges before. A group that holds most rows is spread over many ranges and partitions.

Edge cases: nulls count as ``-``; a null key comes first and is never tampered with; a null group comes first; rows of
equal key are ordered by leaf, equal rows are equal leaves in any order, each with a proof of its own; texts of any
length are hashed within the scan; a group of one leaf has that leaf as its subroot; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodic.operators.sinks import materialize

FANOUT = 16
PART = FANOUT ** 3
#: Leaf digests sorted by one task.
RANGE_ROWS = 1 << 19


def leaf(*fields: Column) -> Column:
    """sha256 over the fields, each ``-`` if null, else its UTF-8 byte count, a colon and its value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _levels(t: pa.Table, part: int) -> list[list[str]]:
    """The levels of one partition: to a single node, or to the partition's level where the group has several partitions."""
    out, width, alone = [t.column("node").to_pylist()], 1, t.column("total")[0].as_py() <= part
    while len(out[-1]) > 1 or (not alone and width < part):
        last = out[-1]
        out.append([_hash("".join(last[i:i + FANOUT])) for i in range(0, len(last), FANOUT)])
        width *= FANOUT
    return out


def indexed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``at`` (gapless from 0 in its group by ``order``) and ``total`` (rows of its group)."""
    rows = materialize(rows, "merkle-leaves")
    n = max(1, -(-rows.count() // RANGE_ROWS))
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    # equal rows may fill a range of their own: their number in the stored table parts them
    tie = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = tie.repartitionByRange(n, *keys, "tie").sortWithinPartitions(*keys, "tie").drop("tie")
    ranged = materialize(ranged.withColumn("range", F.spark_partition_id())
                         .withColumn("spot", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "merkle-ranges")
    held = ranged.groupBy("range", group).agg(F.count(F.lit(1)).alias("n"), F.min("spot").alias("first"))
    own = Window.partitionBy(group)
    held = held.select("range", group, "first", (F.sum("n").over(own.orderBy("range")) - F.col("n")).alias("before"),
                       F.sum("n").over(own).alias("total"))
    a, b = ranged.alias("a"), held.alias("b")
    return (a.join(b, (F.col("a.range") == F.col("b.range")) & F.col(f"a.{group}").eqNullSafe(F.col(f"b.{group}")))
            .select("a.*", "b.before", "b.first", "b.total")
            .withColumn("at", F.col("before") + F.col("spot") - F.col("first")).drop("range", "spot", "before", "first"))


def _roots(part: int):
    def run(t: pa.Table) -> pa.Table:
        """The top node of one partition; ``t`` holds all its leaves."""
        t = t.sort_by("at")
        return pa.table({"grp": t.column("grp")[:1], "part": t.column("part")[:1], "parts": t.column("parts")[:1],
                         "node": [_levels(t, part)[-1][0]]})
    return run


def butterfly(parts: DataFrame) -> DataFrame:
    """``parts(grp, part, parts, node)`` with ``node`` raised to the group's top and ``steps``, the siblings met on the way.

    A step is the own place in the run and the other nodes' digests, joined; a run of one has an empty step."""
    state = parts.withColumn("steps", F.expr("cast(array() as array<struct<place:int,others:string>>)"))
    most = parts.agg(F.max("parts")).first()[0] or 0
    width = 1
    while width < most:
        open_ = F.col("parts") > width
        block, lane = F.floor(F.col("part") / width), F.col("part") % width
        # the block's partitions; those of a short block serve the lanes beyond it too
        size = F.least(F.lit(width), F.col("parts") - block * width)
        sent = state.withColumn("block", block).withColumn(
            "lane", F.explode(F.when(open_, F.sequence(lane, F.lit(width - 1).cast("long"), size)).otherwise(F.array(lane))))
        met = sent.groupBy("grp", "parts", F.floor(F.col("block") / FANOUT).alias("run"), "lane").agg(
            F.array_sort(F.collect_list(F.struct("block", "node"))).alias("run_nodes"),
            F.collect_list(F.when(F.col("part") % width == F.col("lane"), F.struct("part", "block", "node", "steps"))).alias("members"))
        met = met.withColumn("m", F.explode("members"))
        nodes = F.transform("run_nodes", lambda x: x["node"])
        others = F.filter("run_nodes", lambda x: x["block"] != F.col("m.block"))
        step = F.struct((F.col("m.block") % FANOUT).cast("int").alias("place"),
                        F.concat_ws("", F.transform(others, lambda x: x["node"])).alias("others"))
        state = met.select(
            "grp", "m.part", "parts",
            F.when(open_, F.sha2(F.concat_ws("", nodes), 256)).otherwise(F.col("m.node")).alias("node"),
            F.when(open_, F.concat(F.col("m.steps"), F.array(step))).otherwise(F.col("m.steps")).alias("steps"))
        width *= FANOUT
    return state


def _tree(rows: DataFrame, part: int) -> tuple[DataFrame, DataFrame]:
    """Of ``rows(grp, at, total, node, ...)``: the rows with their partition, and the partitions after the exchange."""
    rows = rows.withColumn("part", F.floor(F.col("at") / part)).withColumn("parts", F.ceil(F.col("total") / part))
    schema = f"grp {rows.schema['grp'].dataType.simpleString()}, part long, parts long, node string"
    heads = rows.select("grp", "part", "parts", "at", "total", "node").groupBy("grp", "part").applyInArrow(_roots(part), schema)
    return rows, butterfly(materialize(heads, "merkle-parts"))


def _fold(node: str, steps) -> str:
    for place, others in steps:
        node = _hash(others[:64 * place] + node + others[64 * place:])
    return node


def _steps(whole: list[list[str]], at: int) -> list[tuple[int, str]]:
    """(place, other nodes) of leaf ``at`` in every level of its partition; ``whole`` are the levels' runs, joined."""
    steps = []
    for runs in whole:
        run, place = runs[at // FANOUT], at % FANOUT
        steps.append((place, run[:64 * place] + run[64 * place + 64:]))
        at //= FANOUT
    return steps


def _joined(t: pa.Table, part: int) -> list[list[str]]:
    return [["".join(level[i:i + FANOUT]) for i in range(0, len(level), FANOUT)] for level in _levels(t, part)[:-1]]


def _prove(part: int):
    def run(leaves: pa.Table, top: pa.Table) -> pa.Table:
        """Proof and folded root of every leaf of one partition; ``top`` is its one row of the exchange."""
        t = leaves.sort_by("at")
        up = [(s["place"], s["others"]) for s in top.column("steps")[0].as_py()]
        above, whole = "".join(o for _, o in up), _joined(t, part)
        proofs, folded = [], []
        for i, claim in enumerate(t.column("claimed").to_pylist()):
            steps = _steps(whole, i)
            proofs.append(_hash("".join(o for _, o in steps) + above))
            folded.append(_fold(claim, steps + up))
        fixed = {c: pa.array([top.column(c)[0].as_py()] * t.num_rows, pa.string()) for c in ("subroot", "root")}
        return pa.table({"id": t.column("id"), "grp": t.column("grp"), "leaf": t.column("node"), **fixed,
                         "proof_sha256": proofs, "folded_root": folded})
    return run


def _lift(part: int):
    def run(names: pa.Table, top: pa.Table) -> pa.Table:
        """Steps from every subroot of one partition of the upper tree to the root."""
        t = names.sort_by("at")
        up, whole = top.column("steps")[0].as_py(), _joined(t, part)
        tails = [[{"place": p, "others": o} for p, o in _steps(whole, i)] + up for i in range(t.num_rows)]
        kind = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.string())]))
        return pa.table({"name": t.column("name"), "root": [top.column("node")[0].as_py()] * t.num_rows, "tail": pa.array(tails, kind)})
    return run


def manifest(rows: DataFrame, group: str, key: str, node: Column, claimed: Column, part: int = PART) -> DataFrame:
    """(key, group, leaf, subroot, root, proof_sha256, folded_root) of every row.

    ``node`` is the leaf's digest, ``claimed`` the digest that is folded with the leaf's proof: equal to the root only
    if nothing was changed. ``part`` (a power of sixteen) leaves make a partition."""
    name, id_type, grp_type = key, rows.schema[key].dataType.simpleString(), rows.schema[group].dataType.simpleString()
    leaves = rows.select(F.col(group).alias("grp"), F.col(key).alias("id"), node.alias("node"), claimed.alias("claimed"))
    rows, parts = _tree(indexed(leaves, "grp", ["id", "node"]), part)
    parts = materialize(parts.withColumnRenamed("node", "subroot"), "merkle-proofs")
    # the subroots are the leaves of the upper tree, a tree of one group
    tops = parts.where("part = 0").select(F.lit(0).alias("grp"), F.col("grp").alias("name"), F.col("subroot").alias("node"))
    tops, top_parts = _tree(indexed(tops, "grp", ["name"]), part)
    upper = tops.groupBy("grp", "part").cogroup(top_parts.groupBy("grp", "part")).applyInArrow(
        _lift(part), f"name {grp_type}, root string, tail array<struct<place:int,others:string>>")
    p, u = parts.alias("p"), upper.alias("u")
    proofs = p.join(u, F.col("p.grp").eqNullSafe(F.col("u.name"))).select(
        "p.grp", "p.part", "p.subroot", "u.root", F.concat("p.steps", "u.tail").alias("steps"))
    out = rows.groupBy(F.col("grp").isNull(), "grp", "part").cogroup(proofs.groupBy(F.col("grp").isNull(), "grp", "part")).applyInArrow(
        _prove(part), f"id {id_type}, grp {grp_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.select(F.col("id").alias(name), F.col("grp").alias(group), "leaf", "subroot", "root", "proof_sha256", "folded_root")


def manifest_documents(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` by source; where 5 divides the crc32 of the id, a lower-cased text is folded instead."""
    id_, source, lang, n_chars, text = (F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    tampered = F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))
    out = manifest(docs, "source", "doc_id", leaf(id_, source, lang, n_chars, text),
                   leaf(id_, source, lang, n_chars, F.when(tampered, lower_ascii(text)).otherwise(text)))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE = """
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: xor(c >> 8, tab.t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM documents, tab),
hashed AS (
  SELECT rid, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN coalesce(crc % 5 = 0, false)
      THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
      ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS claimed
  FROM docs),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS idx FROM hashed),
nodes(lvl, source, idx, h, n) AS (
  SELECT 0, source, idx, leaf, count(*) OVER (PARTITION BY source) FROM leaves
  UNION ALL
  SELECT * FROM (
    SELECT lvl + 1, source, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (max(n) + 15) // 16
    FROM nodes WHERE n > 1 GROUP BY lvl, source, idx // 16)),
subroots AS (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM nodes WHERE n = 1),
tops(lvl, idx, h, n) AS (
  SELECT 0, s, h, count(*) OVER () FROM subroots
  UNION ALL
  SELECT * FROM (
    SELECT lvl + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (max(n) + 15) // 16 FROM tops WHERE n > 1 GROUP BY lvl, idx // 16)),
siblings AS (
  SELECT l.rid, n.lvl, n.idx, n.h, n.idx = l.idx // (16 ** n.lvl)::BIGINT AS own
  FROM leaves l JOIN nodes n ON n.source IS NOT DISTINCT FROM l.source AND n.n > 1
    AND n.idx // 16 = l.idx // (16 ** (n.lvl + 1))::BIGINT
  UNION ALL
  SELECT l.rid, 100 + n.lvl, n.idx, n.h, n.idx = s.s // (16 ** n.lvl)::BIGINT
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
    JOIN tops n ON n.n > 1 AND n.idx // 16 = s.s // (16 ** (n.lvl + 1))::BIGINT),
runs AS (
  SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY lvl) AS step,
    coalesce(string_agg(h, '' ORDER BY idx) FILTER (NOT own), '') AS others,
    count(*) FILTER (NOT own AND idx < o) AS place
  FROM (SELECT *, max(CASE WHEN own THEN idx END) OVER (PARTITION BY rid, lvl) AS o FROM siblings) GROUP BY rid, lvl),
proofs AS (SELECT rid, sha256(string_agg(others, '' ORDER BY step)) AS proof, count(*) AS steps FROM runs GROUP BY rid),
folds(rid, step, cur) AS (
  SELECT rid, 0, claimed FROM leaves
  UNION ALL
  SELECT f.rid, f.step + 1, sha256(r.others[1:64 * r.place] || f.cur || r.others[64 * r.place + 1:])
  FROM folds f JOIN runs r ON r.rid = f.rid AND r.step = f.step + 1),
folded AS (SELECT rid, arg_max(cur, step) AS folded FROM folds GROUP BY rid)
SELECT l.doc_id, l.source, l.leaf, s.h AS subroot, t.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
  f.folded AS folded_root, f.folded = t.h AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source JOIN tops t ON t.n = 1
  JOIN folded f ON f.rid = l.rid LEFT JOIN proofs p ON p.rid = l.rid
"""
