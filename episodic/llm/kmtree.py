"""Approximate nearest neighbours by a hierarchical k-means tree and best-bin-first search.

* The tree is fitted on at most ``SAMPLE`` vectors, chosen by a hash of the id:
  each node splits into ``BRANCH`` clusters until a leaf holds ``LEAF`` sampled
  vectors. Every row is then indexed: it descends to its nearest centre.
* A query walks the tree best bin first: a priority queue holds the nodes met
  so far by inner product with their centre; the best is taken next, a leaf is
  visited, an inner node puts its children into the queue. Leaf visits widen until
  the number at which sampled queries reached ``RECALL`` of their true neighbours
  (calibrated against brute force on the sample), and on until the visited
  leaves hold ``SPARE * k`` rows.
* Leaves and the queries that visit them meet in a grid of blocks of at most about
  ``BLOCK`` rows a side, so neither a hot leaf nor many queries make one large task.
  Each block returns its best ``k`` a query, but none below the query's ``k``-th best of the
  sampled vectors in the visited leaves (these are candidates there, so nothing below can be
  among the best ``k`` found); Spark keeps the best of these.

Edge cases: null, zero and non-finite vectors and rows without an id take no part; nor do vectors whose
length differs from the most common one of the sample; ties go to the smaller id; with no more than ``k``
candidates all are returned; repeated rows are candidates of their own (a row with the query's id is the
query's own), but an id asks once, however many rows it has (with the smallest of its vectors); an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episodic.llm.vectors import matrix, stacked, usable
from episodic.operators.sinks import materialize

SAMPLE, BRANCH, LEAF = 20_000, 8, 256
RECALL, SPARE = 0.96, 4
BLOCK = 8192


@dataclass
class Tree:
    dim: int = 0
    centres: list = field(default_factory=list)      # by node
    children: list = field(default_factory=list)     # node numbers; [] for a leaf
    visits: int = 1
    sample: np.ndarray | None = None
    sample_ids: np.ndarray | None = None
    sample_leaf: np.ndarray | None = None

    def floor(self, q: np.ndarray, own: int, visited: list[int], k: int) -> float:
        """Score of a query's ``k``-th best among the sampled vectors of the visited leaves, itself left out: no candidate
        below it can be among the best ``k`` found there."""
        seen = np.zeros(len(self.centres), bool)
        seen[visited] = True
        s = self.sample[seen[self.sample_leaf] & (self.sample_ids != own)] @ q
        if len(s) < k:
            return -np.inf
        least = -np.partition(-s, k - 1)[k - 1]
        return float(least - 1e-9 * max(1.0, abs(least)))

    def grow(self, x: np.ndarray, rng) -> None:
        todo = [(self._node(x.mean(axis=0)), x)]
        while todo:
            node, part = todo.pop()
            if len(part) <= LEAF:
                continue
            centres, at = _kmeans(part, BRANCH, rng)
            if len(np.unique(at)) < 2:
                continue
            for c in range(len(centres)):
                if (at == c).any():
                    kid = self._node(centres[c])
                    self.children[node].append(kid)
                    todo.append((kid, part[at == c]))

    def _node(self, centre: np.ndarray) -> int:
        self.centres.append(centre)
        self.children.append([])
        return len(self.centres) - 1

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: at every node the nearest centre."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = node
                continue
            c = np.array([self.centres[k] for k in kids])
            near = ((c * c).sum(axis=1)[None, :] - 2 * x[rows] @ c.T).argmin(axis=1)
            todo += [(k, rows[near == i]) for i, k in enumerate(kids) if (near == i).any()]
        return out

    def walk(self, q: np.ndarray):
        """Leaves in best-bin-first order."""
        near = self._table() @ q
        queue = [(-near[0], 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                yield node
            for k in self.children[node]:
                heapq.heappush(queue, (-near[k], k))

    def _table(self) -> np.ndarray:
        if getattr(self, "_m", None) is None:
            self._m = np.array(self.centres)
        return self._m


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    at = np.zeros(len(x), int)
    for i in range(rounds):
        new = ((centres * centres).sum(axis=1)[None, :] - 2 * x @ centres.T).argmin(axis=1)
        if i and (new == at).all():
            break
        at = new
        for c in range(len(centres)):
            if (at == c).any():
                centres[c] = x[at == c].mean(axis=0)
    return centres, at


def best(q: np.ndarray, x: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray):
    """For each query (query number, id, score) of its ``k`` largest inner products from ``floor`` on, ties to smaller ids."""
    out = []
    for i in range(0, len(q), 256):
        s = q[i:i + 256] @ x.T
        s[own[i:i + 256, None] == ids[None, :]] = -np.inf
        if s.shape[1] > k:
            least = -np.partition(-s, k - 1, axis=1)[:, k - 1]
        else:
            least = np.full(len(s), -np.inf)
        for j in range(len(s)):
            c = np.flatnonzero((s[j] >= max(least[j], floor[i + j])) & (s[j] > -np.inf))
            c = c[np.lexsort((ids[c], -s[j][c]))][:k]
            out.append((np.full(len(c), i + j), ids[c], s[j][c]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(c) for c in zip(*out))


def fit(vectors: DataFrame, k: int, sample: int = SAMPLE, recall: float = RECALL) -> Tree:
    """Tree of ``vectors(id, v)``, fitted and calibrated on at most ``sample`` of them."""
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    tree = Tree()
    if not rows:
        return tree
    tree.dim = Counter(len(r["v"]) for r in rows).most_common(1)[0][0]
    rows = [r for r in rows if len(r["v"]) == tree.dim]
    x = np.array([r["v"] for r in rows], np.float64)
    tree.sample, tree.sample_ids = x, np.array([r["id"] for r in rows])
    tree.grow(x, np.random.default_rng(7))
    # equal scores stand for each other, so that repeated vectors do not spoil the measure
    asked = x[:200]
    leaf = tree.sample_leaf = tree.leaves(x)
    need = []
    for i, q in enumerate(asked):
        s = x @ q
        s[i] = -np.inf
        top = np.argsort(-s, kind="stable")[:min(k, len(x) - 1)]
        place = {node: n for n, node in enumerate(tree.walk(q))}
        need.append(sorted(place[n] for n in leaf[top]))
    total = sum(map(len, need))
    reached = np.cumsum(np.bincount([n for per in need for n in per], minlength=1))
    tree.visits = int(np.searchsorted(reached, recall * total)) + 1 if total else len(tree.centres)
    return tree


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, tree: Tree | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of ``vectors(id, v)`` found for each of ``queries(id, v)``."""
    tree = tree or fit(vectors, k)
    out = "query_id long, rank int, vec_id long, score double"
    if not tree.dim:
        return vectors.sparkSession.createDataFrame([], out)
    tree._table()

    def index(batches):
        for batch in batches:
            v = stacked(batch.column("v"))
            ok = np.array([len(a) == tree.dim for a in v], bool)
            m = np.array([a for a in v if len(a) == tree.dim]).reshape(-1, tree.dim)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree.leaves(m)), pa.array(batch.column("id").to_numpy()[ok]), pa.array([r.tobytes() for r in m], pa.binary())],
                ["leaf", "id", "v"])

    points = materialize(vectors.select("id", "v").mapInArrow(index, "leaf long, id long, v binary"), "kmtree-index")
    sizes = {r["leaf"]: r["n"] for r in points.groupBy("leaf").agg(F.count("*").alias("n")).collect()}   # at most the tree's leaves

    def visit(batches):
        for batch in batches:
            rows = []
            ids, vs = batch.column("id").to_numpy(), stacked(batch.column("v"))
            for i, q in zip(ids.tolist(), vs):
                if len(q) != tree.dim:
                    continue
                visited, held = [], 0
                for leaf in tree.walk(q):
                    if len(visited) >= tree.visits and held > SPARE * k:
                        break
                    visited.append(leaf)
                    held += sizes.get(leaf, 0)
                f, raw = tree.floor(q, i, visited, k), q.tobytes()
                rows += [(leaf, i, raw, f) for leaf in visited if sizes.get(leaf)]
            cols = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.float64()))],
                                             ["leaf", "id", "v", "floor"])

    # by a number of its own, as a walk costs far more than its row's bytes tell
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    queries = queries.where(F.size("v") == tree.dim).repartition(n, "id").groupBy("id").agg(F.min("v").alias("v"))
    asked = materialize(queries.select("id", "v").mapInArrow(visit, "leaf long, id long, v binary, floor double"), "kmtree-visits")
    xs = points.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("xs"))
    ys = asked.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("ys"))
    grid = materialize(xs.join(ys, "leaf"), "kmtree-grid")
    p = points.join(grid, "leaf").select("leaf", "id", "v", F.pmod(F.xxhash64("id"), "xs").cast("int").alias("x"),
                                         F.explode(F.expr("sequence(0, ys - 1)")).alias("y"))
    q = asked.join(grid, "leaf").select("leaf", "id", "v", "floor", F.explode(F.expr("sequence(0, xs - 1)")).alias("x"),
                                        F.pmod(F.xxhash64("id"), "ys").cast("int").alias("y"))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        own, ids = a.column("id").to_numpy(), b.column("id").to_numpy()
        if not len(own) or not len(ids):
            n, i, s = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        else:
            n, i, s = best(matrix(a.column("v")), matrix(b.column("v")), own, ids, k, a.column("floor").to_numpy())
        return pa.table({"query_id": own[n], "vec_id": i, "score": s})

    found = (q.groupBy("leaf", "x", "y").cogroup(p.groupBy("leaf", "x", "y"))
             .applyInArrow(meet, "query_id long, vec_id long, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def nearest(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    v = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    v = v.where(usable("v") & F.col("id").isNotNull())
    return search(v, v.where(F.col("id") % every == 0), k)
