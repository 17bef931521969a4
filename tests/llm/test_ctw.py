import math
import re
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest

from episodic.llm import ctw
from llm.helpers import MID, clashing, crc, documents, edge_rows, frame, pandas


def tokens(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall("[^\x20\x09-\x0D]+", low)


def check_base(out, texts, held):
    count, docs = Counter(), 0
    for i, t in texts:
        if not held(i):
            count.update(tokens(t))
            docs += 1
    total, known = sum(count.values()) + docs, len(count) + (docs > 0)
    scale = total + 0.1 * (known + 1)
    rows = defaultdict(list)
    for r in out:
        rows[r["doc_id"]].append(r)
    for i, t in texts:
        r = rows[i].pop()
        w = tokens(t)
        assert r["held_out"] == held(i) and r["n_tokens"] == len(w) + 1 and r["train_tokens"] == total
        assert r["n_known"] == sum(count[x] > 0 for x in w) + (docs > 0)
        want = sum(math.log10((count[x] + 0.1) / scale) for x in w) + math.log10((docs + 0.1) / scale)
        assert r["base_score"] == pytest.approx(want, rel=1e-9)


class PlainTree:
    """The same model, node by node."""

    def __init__(self, train, depth):
        self.depth, self.n = depth, defaultdict(lambda: [0, 0])
        self.kids = defaultdict(set)
        for data in train:
            s = bytes([255] * depth) + data + b"\xff"
            for i in range(depth, len(s)):
                for d in range(depth + 1):
                    ctx = s[i - d:i]
                    for j in range(8):
                        self.n[ctx, (1 << j) | (s[i] >> (8 - j))][(s[i] >> (7 - j)) & 1] += 1
                    if d:
                        self.kids[s[i - d + 1:i]].add(ctx)
        self.weight = lru_cache(maxsize=None)(self._weight)

    def kt(self, node):
        a, b = self.n.get(node, (0, 0))
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def _weight(self, ctx, p):
        if len(ctx) == self.depth:
            return self.kt((ctx, p))
        return math.log(.5) + np.logaddexp(self.kt((ctx, p)), sum(self.weight(k, p) for k in self.kids.get(ctx, ())))

    def log10(self, data):
        s, total = bytes([255] * self.depth) + data + b"\xff", 0.0
        for i in range(self.depth, len(s)):
            for j in range(8):
                p, q = (1 << j) | (s[i] >> (8 - j)), None
                for d in range(self.depth, -1, -1):
                    ctx = s[i - d:i]
                    a, b = self.n.get((ctx, p), (0, 0))
                    one = (b + .5) / (a + b + 1)
                    if q is None:
                        q = one
                    else:
                        stop = math.exp(math.log(.5) + self.kt((ctx, p)) - self.weight(ctx, p))
                        q = stop * one + (1 - stop) * q
                total += math.log10(q if (s[i] >> (7 - j)) & 1 else 1 - q)
        return total


def test_scores_equal_a_plain_tree(spark, monkeypatch):
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 3000)            # several blocks
    docs = documents(MID)
    small = docs[docs.n_chars < 300].head(40)
    rows = [(int(i), t, "en", "a", 1) for i, t in small.text.items()] + [(9001, "été où", "fr", "a", 1), (9002, None, "fr", "a", 1)]
    out = ctw.score_documents(frame(spark, rows).repartition(3)).collect()
    held = lambda i: crc(i) % 10 == 0
    check_base(out, [r[:2] for r in rows], held)
    tree = PlainTree([(t or "").encode() for i, t, *_ in rows if not held(i)], ctw.DEPTH)
    got = {r["doc_id"]: r["score"] for r in out}
    for i, t, *_ in rows[:12] + rows[-2:]:
        assert got[i] == pytest.approx(tree.log10((t or "").encode()), rel=1e-6), i


def test_blocks_read_back_by_several_tasks(spark):
    rows = [(i, f"word{i % 37} and word{i} of text {i * i}", "en", "a", 1) for i in range(1000)]
    whole = pandas(ctw.score_documents(frame(spark, rows).coalesce(1)))
    conf = {"parquet.block.size": "2048", "spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = pandas(ctw.score_documents(frame(spark, rows).coalesce(1)))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert len(out) == len(rows)
    assert out.score.tolist() == pytest.approx(whole.score.tolist(), rel=1e-6)
    check_base(out.reset_index().to_dict("records"), [r[:2] for r in rows], lambda i: crc(i) % 10 == 0)


def test_held_out_code_length(spark):
    out = pandas(ctw.score_documents(spark.read.parquet(f"{MID}/documents.parquet")))
    held = out[out.held_out]
    bits = -held.score.sum() / math.log10(2) / held.n_bytes.sum()
    assert 1.5 < bits < 2.4
    check_base(out.reset_index().to_dict("records"), list(documents(MID).text.items()), lambda i: crc(i) % 10 == 0)


def test_edge_cases(spark):
    rows = edge_rows()
    out = ctw.score_documents(clashing(frame(spark, rows))).collect()
    assert len(out) == len(rows)
    check_base(out, [r[:2] for r in rows], lambda i: crc(i) % 10 == 0)
    assert ctw.score_documents(frame(spark, [])).count() == 0
    # nothing to learn from: every decision has probability 1/2
    only = next(i for i in range(100) if crc(i) % 10 == 0)
    r = ctw.score_documents(frame(spark, [(only, "abc", "en", "a", 3)])).first()
    assert r["score"] == pytest.approx(-32 * math.log10(2)) and r["n_known"] == 0 and r["train_tokens"] == 0


def test_packed_arrays():
    a = np.sort(np.random.default_rng(0).integers(0, 2**63, 1000).astype(np.uint64))
    assert (ctw.unpack(ctw.pack(a)) == a).all() and len(ctw.unpack(b"")) == 0
    x = np.array([0.5, 3.25, 1e9, 12345.5])
    want = [math.lgamma(v) for v in x]
    assert ctw._lgamma(x) == pytest.approx(want, rel=1e-10)
