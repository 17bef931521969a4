import random
import zlib

import pandas as pd

from episodic.llm import shards
from llm.helpers import MID, clashing, documents, edge_rows, frame, pandas


def plain_best_fit(sizes, capacity):
    room, out = [], []
    for s in sizes:
        fits = [(r, i) for i, r in enumerate(room) if r >= s]
        if fits:
            i = min(fits)[1]
        else:
            i = len(room)
            room.append(max(capacity, s))
        room[i] -= s
        out.append(i)
    return out


def test_best_fit_equals_a_plain_scan(monkeypatch):
    monkeypatch.setattr(shards, "NODE", 4)
    random.seed(1)
    for _ in range(200):
        sizes = sorted((random.randint(1, 60) for _ in range(random.randint(0, 80))), reverse=True)
        assert shards.best_fit(sizes, 50) == plain_best_fit(sizes, 50)


def check(rows, out):
    """rows: (doc_id, text); out: collected rows of shard_documents."""
    assert len(out) == len(rows)
    texts = dict(rows)
    where = {}
    for r in out:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        assert where.setdefault(texts[r["doc_id"]], r["shard"]) == r["shard"]
    slots = {}
    for r in out:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return slots


def test_documents(spark):
    out = shards.shard_documents(spark.read.parquet(f"{MID}/documents.parquet")).collect()
    check(list(documents(MID).text.items()), out)
    per = pd.DataFrame([r.asDict() for r in out]).groupby("shard")["size"].sum()
    assert sorted(per.index) == list(range(16))
    assert per.max() / per.min() < 1.02


def test_hot_group_is_numbered_in_parts(spark):
    rows = [(i, "same text here", "en", "a", 1) for i in range(500)] + [(1000 + i, f"text {i} " + "x" * (i % 50), "en", "a", 1) for i in range(1000)]
    out = shards.place(frame(spark, rows), 4, rows_per_task=50)
    got = out.collect()
    assert len({r["shard"] for r in got if r["doc_id"] < 500}) == 1
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_fixed_capacity_uses_few_shards(spark):
    rows = [(i, "x" * (50 + i % 97) + str(i), "en", "a", 1) for i in range(2000)]
    out = pandas(shards.place(frame(spark, rows), None, capacity=20_000))
    total = out["size"].sum()
    per = out.groupby("shard")["size"].sum()
    assert per.max() <= 20_000 and len(per) <= total / 20_000 * 1.1 + 1


def test_edge_cases(spark):
    rows = edge_rows()
    check([r[:2] for r in rows], shards.shard_documents(clashing(frame(spark, rows))).collect())
    assert shards.shard_documents(frame(spark, [])).count() == 0
