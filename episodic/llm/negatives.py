"""Hard negatives by rotated one-bit codes with deterministic score intervals.

A vector of integer components v is turned by a fixed orthogonal matrix and coded by the signs of its components; what the
signs leave over is coded by its own signs, ``LEVELS`` times (64 bits a level for 64 components). Stored with the codes are
the alignments a_l = <v, c_l> of the vector (then of its residue) with its unit code vectors, and the length of the last
residue r. So <v, q> = sum a_l <c_l, q> + <r, q>. The anchor q is turned too and cut into ``PLANES`` bit planes, so that
every <c_l, q> is a sum of popcounts of code and plane, off by at most the length of what the planes leave over of q. As r
is at right angles to the last code vector, <r, q> lies within |r| sqrt(|q|^2 - <c_L, q>^2) by Cauchy-Schwarz. Both bounds
hold for every pair, not in the mean: a row whose interval cannot reach the best k found surely by others, or that lies
outside of the asked band, is left out without loss, and the rows that remain are scored with their integers.

Anchors (a stated query set) meet all rows in cells of an anchor block and a row block, both cut by a hash of the id, so no
key is hot. A cell returns the best few of each anchor; a partial top-k cuts these before their shuffle.

Edge cases: rows with a null id, label or vector, an empty vector, a null or non-finite component, or a component beyond
2^26 after scaling take no part; vectors of different lengths do not meet; of rows of one id the least by label and vector
stands for all; equal scores go by the smaller id; an anchor without a row of its label, or a positive without a row in its
band, gives no rows; zero vectors take part with score 0; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episodic.operators.sinks import materialize

LEVELS = 4
PLANES = 10
ROW_BLOCK = 4096
ANCHOR_BLOCK = 2048
#: Bound of a scaled component; inner products of up to 2^11 components then fit 64 bits.
LARGEST = 1 << 26


def rotation(dim: int) -> np.ndarray:
    """A fixed orthogonal matrix: the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def _padded(dim: int) -> int:
    return -(-dim // 64) * 64


def _bits(on: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    return np.packbits(on, axis=-1, bitorder="little").view(np.uint64)


def encode(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows x levels x words) and alignments (rows x levels, then the last residue's length)."""
    n, dim = v.shape
    wide = _padded(dim)
    r = np.zeros((n, wide))
    r[:, :dim] = v
    r = r @ rotation(wide).T
    codes, kept = [], []
    for _ in range(LEVELS):
        on = r >= 0
        unit = np.where(on, 1.0, -1.0) / np.sqrt(wide)
        a = (r * unit).sum(axis=1)
        r = r - a[:, None] * unit
        codes.append(_bits(on))
        kept.append(a)
    kept.append(np.sqrt((r * r).sum(axis=1)))
    return np.stack(codes, axis=1), np.stack(kept, axis=1)


def intervals(codes: np.ndarray, kept: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds (anchors x rows) of the inner products of anchors ``q`` with the coded vectors."""
    n, dim = q.shape
    wide = _padded(dim)
    y = np.zeros((n, wide))
    y[:, :dim] = q
    y = y @ rotation(wide).T
    low, span = y.min(axis=1), np.ptp(y, axis=1)
    step = np.where(span > 0, span / ((1 << PLANES) - 1), 1.0)
    u = np.rint((y - low[:, None]) / step[:, None]).astype(np.int64)
    left = np.sqrt(((y - low[:, None] - step[:, None] * u) ** 2).sum(axis=1))
    length = np.sqrt((y * y).sum(axis=1))
    planes = [_bits((u >> j & 1).astype(bool)) for j in range(PLANES)]
    total = (low * wide + step * u.sum(axis=1))[:, None]
    est = np.zeros((n, len(codes)))
    slack = np.zeros((n, len(codes)))
    for level in range(codes.shape[1]):
        dot = np.zeros((n, len(codes)), np.int32)
        ones = np.zeros(len(codes), np.int32)
        for w in range(wide // 64):
            word = codes[:, level, w]
            ones += np.bitwise_count(word).astype(np.int32)
            for j, plane in enumerate(planes):
                dot += np.bitwise_count(word[None, :] & plane[:, w, None]).astype(np.int32) << j
        # <c, y> = (2 * sum over the set bits - sum over all) / sqrt(wide)
        c = (2 * (low[:, None] * ones + step[:, None] * dot) - total) / np.sqrt(wide)
        est += c * kept[:, level]
        slack += np.abs(kept[:, level]) * left[:, None]
    near = np.maximum(np.abs(c) - left[:, None], 0.0)
    across = np.sqrt(np.maximum(length[:, None] ** 2 - near ** 2, 0.0))
    # the last term pays for rounding in doubles
    slack += kept[:, -1] * across + 1e-9 * (1.0 + length[:, None] * np.sqrt((kept ** 2).sum(axis=1)))
    return est - slack, est + slack


def _kth(x: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of every row; minus infinity where there are fewer."""
    if x.shape[1] < k:
        return np.full(len(x), -np.inf)
    return np.partition(x, x.shape[1] - k, axis=1)[:, x.shape[1] - k]


def _scores(q: np.ndarray, v: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), 1 << 16):
        s = slice(i, i + (1 << 16))
        out[s] = np.einsum("ij,ij->i", q[a[s]], v[b[s]])
    return out


def _best(a: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k pairs of every anchor, higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, a))
    a = a[order]
    first = np.concatenate([[True], a[1:] != a[:-1]]) if len(a) else np.empty(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(a)), 0))
    return order[np.arange(len(a)) - start < k]


def _unpack(t: pa.Table):
    ids, label = t.column("id").to_numpy(), t.column("label").to_numpy()
    v = np.frombuffer(b"".join(t.column("v").to_pylist()), np.int64).reshape(len(ids), -1)
    return ids, label, v


def _coded(t: pa.Table):
    n = t.num_rows
    codes = np.frombuffer(b"".join(t.column("code").to_pylist()), np.uint64).reshape(n, LEVELS, -1)
    return codes, np.frombuffer(b"".join(t.column("kept").to_pylist()), np.float64).reshape(n, LEVELS + 1)


def _positives(k: int, batch: int = 128):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            ids, label, v = _unpack(rows)
            codes, kept = _coded(rows)
            aid, alabel, q = _unpack(anchors)
            for i in range(0, len(aid), batch):
                s = slice(i, i + batch)
                lo, hi = intervals(codes, kept, q[s].astype(np.float64))
                same = (label[None, :] == alabel[s, None]) & (ids[None, :] != aid[s, None])
                a, b = np.nonzero(same & (hi >= _kth(np.where(same, lo, -np.inf), k)[:, None]))
                score = _scores(q[s], v, a, b)
                top = _best(a, score, ids[b], k)
                out.append((aid[s][a[top]], ids[b[top]], score[top]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 3
        return pa.table(dict(zip(("anchor_id", "positive_id", "positive_score"), cols)))
    return run


def _negatives(k: int, least: int, most: int, batch: int = 64):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            ids, label, v = _unpack(rows)
            codes, kept = _coded(rows)
            aid, alabel, q = _unpack(anchors)
            pid, pscore = anchors.column("positive_ids").to_pylist(), anchors.column("positive_scores").to_pylist()
            for i in range(0, len(aid), batch):
                s = slice(i, i + batch)
                lo, hi = intervals(codes, kept, q[s].astype(np.float64))
                other = label[None, :] != alabel[s, None]
                slots = max(len(p) for p in pid[s])
                # a slot without a positive has an empty band
                p = np.array([x + [np.nan] * (slots - len(x)) for x in pscore[s]], np.float64)
                found = np.zeros_like(other)
                for j in range(slots):
                    down, up = p[:, j, None] * least / 100, p[:, j, None] * most / 100
                    sure = np.where(other & (lo >= down) & (hi <= up), lo, -np.inf)
                    found |= other & (hi >= down) & (lo <= up) & (hi >= _kth(sure, k)[:, None])
                a, b = np.nonzero(found)
                score = _scores(q[s], v, a, b)
                for j in range(slots):
                    has = np.array([j < len(x) for x in pid[s]])
                    ps = np.array([x[j] if j < len(x) else 0 for x in pscore[s]], np.int64)
                    ok = np.flatnonzero(has[a] & (least * ps[a] <= 100 * score) & (100 * score <= most * ps[a]))
                    top = ok[_best(a[ok], score[ok], ids[b[ok]], k)]
                    at = a[top]
                    names = np.array([x[j] if j < len(x) else 0 for x in pid[s]], np.int64)
                    out.append((aid[s][at], names[at], ps[at], ids[b[top]], score[top]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 5
        return pa.table(dict(zip(("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"), cols)))
    return run


def _codes(batches):
    for batch in batches:
        ids, label, lists = batch.column("id"), batch.column("label"), batch.column("q")
        flat, off = lists.values.to_numpy(), lists.offsets.to_numpy()
        dims = np.diff(off)
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            v = np.stack([flat[off[i]:off[i + 1]] for i in at])
            codes, kept = encode(v.astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at)), label.take(pa.array(at)), pa.array([int(dim)] * len(at), pa.int32()),
                 *(pa.array([r.tobytes() for r in x], pa.binary()) for x in (v, codes, kept))],
                ["id", "label", "dim", "v", "code", "kept"])


def coded(vectors: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, dim, v, code, kept): one row per id that takes part, stored."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("x"))
    fits = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST / 256.0)))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("x") > 0) & fits)
    rows = rows.select("id", "label", F.transform("x", lambda c: F.floor(c * 256)).alias("q"))
    one = rows.groupBy("id").agg(F.min(F.struct("label", "q")).alias("r")).select("id", "r.label", "r.q")
    return materialize(one.mapInArrow(_codes, "id long, label long, dim int, v binary, code binary, kept binary"), "negatives-codes")


def _cells(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, row_block: int, anchor_block: int):
    """Rows and anchors of every cell, grouped alike."""
    xs, ys = max(1, -(-n_rows // row_block)), max(1, -(-n_anchors // anchor_block))
    x, y = F.pmod(F.xxhash64("id"), F.lit(xs)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(ys))
    tasks = min(xs * ys, 1 << 15)
    key = ("dim", "x", "y")
    left = rows.withColumn("x", x).withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ys - 1).cast("long"))))
    right = anchors.withColumn("y", y).withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(xs - 1).cast("long"))))
    return (left.repartition(tasks, *key).groupBy(*key).cogroup(right.repartition(tasks, *key).groupBy(*key)))


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
                   row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of coded ``anchors`` among coded ``rows``.

    Negatives score between ``least`` and ``most`` percent of the positive, both included."""
    n_rows, n_anchors = rows.count(), anchors.count()
    size = (n_rows, n_anchors, row_block, anchor_block)
    near = _cells(rows, anchors, *size).applyInArrow(_positives(positives), "anchor_id long, positive_id long, positive_score long")
    w = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    near = near.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= positives)
    near = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rn", "positive_id", "positive_score"))).alias("p"))
    asked = materialize(anchors.join(near, F.col("id") == F.col("anchor_id")).select(
        *anchors.columns, F.transform("p", lambda x: x["positive_id"]).alias("positive_ids"),
        F.transform("p", lambda x: x["positive_score"]).alias("positive_scores")), "negatives-anchors")
    far = _cells(rows, asked, *size).applyInArrow(
        _negatives(negatives, least, most),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    w = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    return far.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine(vectors: DataFrame) -> DataFrame:
    """Hard negatives of every anchor (id divisible by 100) of ``embeddings``; ids divisible by 7 have the next label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = coded(vectors.select("vec_id", moved.alias("label"), "embedding"), "vec_id", "label", "embedding")
    return hard_negatives(rows, rows.where("id % 100 = 0"))


ORACLE = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::DOUBLE) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
  s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 10
"""
