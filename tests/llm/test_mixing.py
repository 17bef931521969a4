import re

import pytest

from episodic.llm import mixing
from llm.helpers import MID, clashing, documents, edge_rows, frame, pandas


def targets(sizes):
    """Shares by weight, capped at twice a source's words, the excess shared again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, open_, budget = {}, list(names), 1.5 * sum(sizes.values())
    while open_:
        level = budget / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        for s in over or open_:
            out[s] = 2.0 * sizes[s] if over else level * weight[s]
        if not over:
            break
        for s in over:
            budget -= 2 * sizes[s]
            open_.remove(s)
    return out


def test_documents(spark):
    docs = documents(MID)
    out = pandas(mixing.mix_documents(spark.read.parquet(f"{MID}/documents.parquet")))
    size = docs.text.map(lambda t: len(re.findall("[^\x20\x09-\x0D]+", t)))
    assert (out["size"] == size).all()
    per = size.groupby(docs.source).sum().to_dict()
    want = targets(per)
    assert (out.source_size == docs.source.map(per)).all()
    for i in out.index:
        assert out.target[i] == pytest.approx(want[docs.source[i]], rel=1e-12)
    assert (out.taken <= 2 * out["size"]).all()
    taken, most = out.taken.groupby(docs.source).sum(), size.groupby(docs.source).max()
    for s, t in want.items():
        assert abs(taken[s] - t) <= most[s] / 2 + 1
    again = pandas(mixing.mix_documents(spark.read.parquet(f"{MID}/documents.parquet").repartition(7)))
    assert (again.taken == out.taken).all()


def test_epochs_come_before_the_fraction(spark):
    rows = [(i, "w " * 10, "en", "big" if i < 900 else "small", 1) for i in range(1000)]
    out = pandas(mixing.mix_documents(frame(spark, rows)))
    for s, g in out.groupby("source"):
        assert set(g.copies) <= {int(g.target.iloc[0] // g.source_size.iloc[0]), int(g.target.iloc[0] // g.source_size.iloc[0]) + 1}
    assert abs(out.taken.sum() - 15000) <= 20


def test_better_documents_come_earlier(spark):
    # of sources of one size and different weights some are taken in part
    better = [(i, ("word " if i % 2 else "w ") * 20, "en", f"s{i % 3}", 1) for i in range(6000)]
    out = pandas(mixing.mix_documents(frame(spark, better)))
    partly = [g for _, g in out.groupby("source") if g.copies.nunique() > 1]
    assert partly
    for g in partly:
        once_more = g[g.copies == g.copies.max()]
        assert (once_more.index % 2 == 1).mean() > 0.55


def test_chosen_documents_equal_a_sort_of_all_keys(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    out = pandas(mixing.mix_documents(docs))
    rows = [r.asDict() for r in mixing.drawn(docs.select("doc_id", "source", "text"), "").collect()]
    want = {}
    per = {}
    for r in rows:
        per.setdefault(r["source"], []).append(r)
    goal = targets({s: sum(r["size"] for r in g) for s, g in per.items()})
    for s, g in per.items():
        size = sum(r["size"] for r in g)
        epochs = int(goal[s] // size)
        rest, run = goal[s] - epochs * size, 0
        for r in sorted(g, key=lambda r: (r["key"], r["tie"], r["size"])):
            # the document at the edge is taken if the sum comes nearer to the target with it
            take = r["size"] and run + r["size"] / 2 <= rest
            want[r["doc_id"]] = epochs + bool(take)
            run += r["size"]
    assert out.copies.to_dict() == want


def test_edge_cases(spark):
    rows = edge_rows()
    out = mixing.mix_documents(clashing(frame(spark, rows)))
    got = out.collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["size"] for r in got}[2] == 0
    assert mixing.mix_documents(frame(spark, [])).count() == 0
    alone = mixing.mix_documents(frame(spark, [(1, "", "en", "a", 0), (2, None, "en", "a", 0)])).collect()
    assert [r["taken"] for r in alone] == [0, 0] and [r["target"] for r in alone] == [0.0, 0.0]


def test_stage_repeats_whole_documents(spark):
    docs = clashing(spark.read.parquet(f"{MID}/documents.parquet"))
    out, plan = mixing.mixed(docs), pandas(mixing.mix_documents(docs))
    assert out.columns == docs.columns
    copies = out.groupBy("doc_id").count().toPandas().set_index("doc_id")["count"]
    assert copies.to_dict() == plan.copies[plan.copies > 0].to_dict()


def test_a_target_that_ends_among_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TURNS", 16)
    rows = [(1, "w " * 10, "en", "a", 1)] * 300 + [(None, "word " * 10, "en", "b", 1)] * 200 + [(7, "word " * 3, "en", "c", 1)] * 100
    rows += [(1000 + i, "word " * 10, "en", "abc"[i % 3], 1) for i in range(30)]
    docs = clashing(frame(spark, rows)).repartition(5)
    out = mixing.mix_documents(docs).toPandas()
    assert len(out) == len(rows)
    want = targets(out.groupby("source")["size"].sum().to_dict())
    for s, g in out.groupby("source"):
        assert abs(g.taken.sum() - want[s]) <= g["size"].max() / 2 + 1, s
        assert g.copies.max() - g.copies.min() <= 1 and (g.taken <= 2 * g["size"]).all()
    stage = mixing.mixed(docs)
    assert stage.columns == docs.columns
    assert stage.groupBy("source").count().toPandas().set_index("source")["count"].to_dict() == out.groupby("source").copies.sum().to_dict()
