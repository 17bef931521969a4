import random

import numpy as np
import pyarrow as pa
import pytest

from episodic.llm import minhash
from llm.helpers import SMALL, WORDS, clashing, documents, edge_rows, frame, pandas


def brute(texts):
    """Smallest id of each document's class by comparing all pairs of whole texts."""
    ids = sorted(texts)
    bags = {i: minhash.bag(texts[i]) for i in ids}
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if minhash.overlap(bags[a], bags[b]) >= 0.8:
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: root(i) for i in ids}


def python_shingles(text):
    w = (text or "").lower().split(" ")
    k = min(5, len(w))
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]


def test_overlap_is_weighted_jaccard():
    from collections import Counter
    random.seed(1)
    for _ in range(30):
        a = " ".join(random.choice(WORDS[:4]) for _ in range(40))
        b = a + " " + " ".join(random.choice(WORDS[:4]) for _ in range(20))
        x, y = Counter(python_shingles(a)), Counter(python_shingles(b))
        want = sum((x & y).values()) / sum((x | y).values())
        assert minhash.overlap(minhash.bag(a), minhash.bag(b)) == pytest.approx(want)


def test_block_overlaps_equal_pairs():
    random.seed(6)
    texts = [" ".join(random.choice(WORDS[:5]) for _ in range(random.randint(1, 60))) for _ in range(30)] + ["", "one"]
    got = minhash.overlaps(texts)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert i == j or got[i, j] == pytest.approx(minhash.overlap(minhash.bag(a), minhash.bag(b)))


def test_a_lower_threshold_reaches_the_signature_filter():
    text = " ".join(f"w{i}" for i in range(60))
    texts = [text, " ".join(text.split(" ")[:45] + ["z"] * 10)]
    assert 0.5 < minhash.overlap(minhash.bag(texts[0]), minhash.bag(texts[1])) < 0.64
    sig = np.zeros((2, minhash.REGISTERS), np.uint8)
    sig[1, :int(0.45 * minhash.REGISTERS)] = 1               # an estimate of 0.55
    t = pa.table({"id": [1, 2], "component": [1, 2], "side": [2, 2], "sig": [x.tobytes() for x in sig], "text": texts})
    assert minhash._linked(0.5)(t).to_pylist() == [{"a": 1, "b": 2}]
    assert minhash._hopeful(0.5)(t).num_rows == 2 and minhash._hopeful(0.8)(t).num_rows == 0


def test_bit_map_keeps_every_wanted_row(spark):
    rows = spark.range(5000).selectExpr("id * 977 as id", "'t' as text")
    wanted = rows.where("id % 7 = 0").select("id")
    got = {r["id"] for r in minhash._thinned(rows, wanted).collect()}
    want = {r["id"] for r in wanted.collect()}
    assert want <= got and len(got) < len(want) + 50
    assert minhash._thinned(rows, wanted.where("id < 0")).count() == 0


def test_signatures_are_unbiased_for_multisets():
    rng = np.random.default_rng(3)
    got, want = [], []
    for trial in range(40):
        key = rng.integers(0, 2**63, 60).astype(np.uint64)
        n, k = rng.integers(0, 9, 60), rng.integers(0, 9, 60)
        n[0] = k[1] = 1
        doc = np.concatenate([np.zeros((n > 0).sum(), int), np.ones((k > 0).sum(), int)])
        s = minhash.signatures(doc, np.concatenate([key[n > 0], key[k > 0]]), np.concatenate([n[n > 0], k[k > 0]]), 2, 256)
        got.append((s[0] == s[1]).mean())
        want.append(np.minimum(n, k).sum() / np.maximum(n, k).sum())
    assert abs(np.mean(got) - np.mean(want)) < 0.01
    assert np.abs(np.array(got) - want).max() < 0.16


def test_signature_does_not_depend_on_the_batch():
    key = np.arange(1, 40, dtype=np.uint64)
    one = minhash.signatures(np.zeros(39, int), key, np.full(39, 2), 1)
    two = minhash.signatures(np.concatenate([np.zeros(39, int), np.ones(39, int)]), np.concatenate([key, key]), np.full(78, 2), 2)
    assert (one[0] == two[0]).all() and (one[0] == two[1]).all()


def test_classes_equal_brute_force(spark):
    texts = documents(SMALL).text.to_dict()
    out = pandas(minhash.near_duplicates(spark.read.parquet(f"{SMALL}/documents.parquet")))
    want = brute(texts)
    assert out.class_id.to_dict() == want
    assert (out.kept == (out.class_id == out.index)).all()


def test_hot_groups_chains_and_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)         # open buckets are cut into several blocks
    random.seed(4)
    rows, texts = edge_rows(), {}
    base = [random.choice(WORDS) for _ in range(120)]
    for i in range(100, 130):                        # exact copies
        rows.append((i, " ".join(base), "en", "hot", 1))
    for i in range(200, 260):                        # near copies of one text, all different
        w = list(base)
        w[random.randrange(120)] += "x"
        rows.append((i, " ".join(w), "en", "hot", 1))
    common = [random.choice(WORDS) for _ in range(60)]
    for i in range(300, 340):                        # a shared passage, below the threshold
        rows.append((i, " ".join(common + [random.choice(WORDS) + str(i) for _ in range(20)]), "en", "p", 1))
    chain = [random.choice(WORDS) for _ in range(100)]
    for i in range(400, 412):                        # each text like the next one, the ends unlike
        rows.append((i, " ".join(chain[(i - 400) * 5:] + [f"c{j}" for j in range((i - 400) * 5)]), "en", "c", 1))
    texts = {r[0]: r[1] for r in rows}
    out = minhash.near_duplicates(clashing(frame(spark, rows)))
    assert out.columns[:2] == ["doc_id", "class_id"]
    got = {r["doc_id"]: r["class_id"] for r in out.collect()}
    assert got == brute(texts)
    assert out.count() == len(rows)
    kept = minhash.one_per_class(clashing(frame(spark, rows)))
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == sorted({i for i in texts if got[i] == i})
    assert len(kept.columns) == len(clashing(frame(spark, rows)).columns)


def test_empty_table_and_null_ids(spark):
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    rows = [(None, "one two three four five six", "en", "a", 1), (1, "one two three four five six", "en", "a", 1), (None, None, None, None, None)]
    got = sorted(((r["doc_id"], r["class_id"]) for r in minhash.near_duplicates(frame(spark, rows)).collect()), key=str)
    assert (1, 1) in got and len(got) == 3
    assert minhash.one_per_class(frame(spark, rows)).count() == 3
