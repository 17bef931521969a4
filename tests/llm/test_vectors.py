import itertools

import numpy as np

from episodic.llm import common, kmtree, lattice
from llm.helpers import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(int(i), None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def cosines(x):
    x = np.array(x, np.float32).astype(np.float64)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    return s


# ---------------------------------------------------------------- E8

def test_decode_is_the_nearest_lattice_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)) * 1.5
    got = lattice.decode(x)
    assert ((got * 2) % 1 == 0).all() and (got.sum(axis=1) % 2 == 0).all()
    step = np.concatenate([np.zeros((1, 8)), lattice.neighbours()])
    assert len(step) == 241
    # no neighbour of the point is nearer, and the covering radius is 1
    d = ((x[:, None, :] - got[:, None, :] - step[None]) ** 2).sum(axis=2)
    assert (d.argmin(axis=1) == 0).all() and (d[:, 0] <= 1 + 1e-9).all()


def test_links_counts_components(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK", 16)        # hot cells are cut into a grid
    rng = np.random.default_rng(1)
    x = list(rng.normal(size=(300, 64)))
    hot = rng.normal(size=64)
    x += [hot + rng.normal(size=64) * 0.1 for _ in range(150)]           # a hot group of near copies
    x += [hot * 3] * 20 + [x[0]] * 5                                      # scaled and exact copies
    for k in range(100):                                                  # pairs at cosines from 0.9 up
        a = rng.normal(size=64)
        b = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        c = 0.905 + 0.09 * k / 100
        x += [a, c * a + np.sqrt(1 - c * c) * b]
    s = cosines(x)
    want = s >= 0.9
    odd = [None, [0.0] * 64, [float("nan")] * 64, [1.0] * 63 + [None], [1.0] * 63 + [float("inf")], [], [1.0, 2.0], [2.0, 4.0]]
    df = clashing(table(spark, x + odd))
    out = {r["vec_id"]: r for r in lattice.near_duplicate_vectors(df).collect()}
    assert len(out) == len(x) + len(odd)
    got = np.array([out[i]["n_links"] for i in range(len(x))])
    true = want.sum(axis=1)
    assert (got <= true).all()                       # none below the threshold, none twice
    assert got[300:475].sum() >= 0.99 * true[300:475].sum()
    assert got[480:].sum() >= 0.95 * true[480:].sum()
    assert got[0] == 5
    assert len({out[i]["component_id"] for i in range(300, 470)}) == 1 and out[300]["component_id"] == 300
    for i in range(len(x), len(x) + 6):
        assert (out[i]["n_links"], out[i]["component_id"], out[i]["kept"]) == (0, i, True)
    n = len(x)
    assert out[n + 7]["component_id"] == n + 6 and out[n + 6]["n_links"] == 1
    assert lattice.near_duplicate_vectors(table(spark, [])).count() == 0


def test_components_equal_union_find(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)]
    up = {}

    def root(i):
        up.setdefault(i, i)
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    got = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {i: got.get(i, i) for i in up} == {i: root(i) for i in up}


# ---------------------------------------------------------------- k-means tree

def exact(x, ids, q, k):
    x = np.array(x, np.float32).astype(np.float64)
    s = x @ x[q]
    order = sorted((j for j in range(len(x)) if ids[j] != ids[q]), key=lambda j: (-s[j], ids[j]))
    return [(ids[j], s[j]) for j in order[:k]]


def test_recall_and_order(spark, monkeypatch):
    monkeypatch.setattr(kmtree, "BLOCK", 64)
    monkeypatch.setattr(kmtree, "LEAF", 40)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 64)) * 2
    x = [centres[i % 30] + rng.normal(size=64) for i in range(1500)] + [centres[0]] * 200      # a hot leaf of copies
    ids = list(range(len(x)))
    df = clashing(table(spark, x + [None, [0.0] * 64, [float("nan")] * 64], ids + [1700, 1720, 1740]))
    out = {}
    for r in kmtree.nearest(df).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(out) == [i for i in ids if i % 20 == 0]
    hit = total = 0
    for q, rows in out.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21))
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        want = exact(x, ids, q, 20)
        least = want[-1][1]
        hit += sum(r[2] >= least - 1e-9 for r in rows)
        total += 20
        for _, i, s in rows[:3]:
            assert abs(s - np.float32(x[i]).astype(float) @ np.float32(x[q]).astype(float)) < 1e-9
    assert hit / total >= 0.9


def test_random_vectors_and_few_candidates(spark):
    rng = np.random.default_rng(6)
    x = list(rng.normal(size=(800, 32)))
    got = {}
    for r in kmtree.nearest(table(spark, x)).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    ids = list(range(800))
    hits = [len(got[q] & {i for i, _ in exact(x, ids, q, 20)}) for q in got]
    assert np.mean(hits) / 20 >= 0.9
    few = kmtree.nearest(table(spark, x[:7], [0, 20, 21, 22, 23, 24, 25])).collect()
    assert sorted((r["query_id"], r["rank"]) for r in few) == sorted(itertools.product((0, 20), range(1, 7)))
    assert kmtree.nearest(table(spark, [])).count() == 0
    assert kmtree.nearest(table(spark, [x[0]], [20])).count() == 0
    ties = kmtree.nearest(table(spark, [x[0]] * 30)).where("query_id = 0").orderBy("rank").collect()
    assert [r["vec_id"] for r in ties] == list(range(1, 21))


def test_repeated_query_rows_ask_once(spark):
    x = np.random.default_rng(8).normal(size=(200, 16))
    ids = list(range(200)) + [20, 20] + [40] * 24
    rows = list(x) + [x[20]] * 2 + [x[40]] * 24
    got = {}
    for r in kmtree.nearest(table(spark, rows, ids)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    s = np.array(x, np.float32).astype(np.float64)
    s = s @ s.T
    assert sorted(got) == list(range(0, 200, 20))
    for q in got:
        # every row of another id is a candidate, so a neighbour of n rows comes n times
        want = sorted((-s[q, i], i) for i in ids if i != q)[:20]
        assert [(n, i) for n, i in sorted(got[q])] == [(n + 1, i) for n, (_, i) in enumerate(want)], q
