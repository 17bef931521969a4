import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodic.llm import langid
from llm.helpers import MID, clashing, crc, documents, edge_rows, frame, pandas


def test_held_out_accuracy_and_calibration(spark):
    out = pandas(langid.label_documents(spark.read.parquet(f"{MID}/documents.parquet")))
    truth = documents(MID).lang
    held = out.held_out
    assert list(held) == [crc(i) % 3 == 1 for i in out.index]
    assert (out.lang_pred == truth)[held].mean() >= 0.98
    assert out.score.between(0, 1).all()
    right = (out.lang_pred == truth)[held]
    assert abs(out.score[held].mean() - right.mean()) < 0.05


def test_edge_cases(spark):
    rows = edge_rows() + [(i, "le la les des une est dans pour que", "fr", "a", 9) for i in range(100, 130)] \
        + [(i, "the and that with from this have which", "en", "a", 9) for i in range(200, 230)]
    out = pandas(langid.label_documents(clashing(frame(spark, rows))))
    assert len(out) == len(rows)
    for i in (2, 3, 6, 7):
        assert out.loc[i].lang_pred == "und" and out.loc[i].score == 0
    assert set(out.lang_pred.loc[100:129]) == {"fr"} and set(out.lang_pred.loc[200:229]) == {"en"}
    empty = langid.label_documents(frame(spark, []))
    assert empty.count() == 0
    nothing = pandas(langid.label_documents(frame(spark, [(1, "some text", None, "a", 9)])))
    assert nothing.loc[1].lang_pred == "und"


def test_language_is_not_an_input(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet").where("doc_id < 400")
    model = langid.fit(docs.where(~langid.held_out()), max_train=200)
    assert len(model.langs) == 4
    text = docs.first()["text"]
    assert model.one(text) == model.one(text) and model.one("?!") == ("und", 0.0)
    # a text longer than one slice is summed over its slices
    assert model.one(text * 400)[0] == model.one(text)[0]


def test_stage_keeps_clean_documents(spark):
    docs = clashing(frame(spark, edge_rows() + [(i, "the and that with from this have which are", "en", "a", 9) for i in range(100, 140)]
                          + [(i, "le la les des une est dans pour que", "fr", "a", 9) for i in range(200, 240)]))
    kept = langid.keep_known_languages(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids.isdisjoint({2, 3, 6, 7}) and {1, 4, 5, 100, 239} <= ids


def test_stage_without_labels_rejects_only_documents_without_a_letter(spark):
    docs = clashing(frame(spark, [(*r[:2], None, *r[3:]) for r in edge_rows()]))
    kept = langid.keep_known_languages(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5, 5, 8]


# ---------------------------------------------------------------- against plain loops

M = 0xFFFFFFFF


def plain_counts(text):
    """Cells of the 1- to 3-grams of a text, counted one by one; None without a letter."""
    if not any(c.isalpha() for c in text):
        return None
    runs, last = [], None
    for c in text.lower():
        c = c if c.isalpha() else " "
        if c != " " or last != " ":
            runs.append(c)
        last = c
    signs = [" ", *runs, " "]
    out = {}
    shift = 32 - int(math.log2(langid.DIMS))
    cp = [ord(c) for c in signs]
    for n in (1, 2, 3):
        for i in range(len(cp) - n + 1):
            h = cp[i] * 0x9E3779B1 & M
            for j, m in ((1, 0x85EBCA77), (2, 0xC2B2AE3D)):
                if j < n:
                    h = ((h ^ h >> (15 if j == 1 else 13)) * m + (cp[i + j] * 0x9E3779B1 & M)) & M
            cell = (h * 0x27D4EB2F & M) >> shift
            out[cell] = out.get(cell, 0) + 1
    return out


def test_counts_equal_a_plain_loop():
    for text in ("The cat, the CAT!", "  a  ", "é1è2ç", "one--two  three\n4 five", "x" * 50 + " " + "yz " * 30, "Größe ßtraße"):
        got = langid.gram_counts(text)
        assert {int(i): int(got[i]) for i in np.flatnonzero(got)} == plain_counts(text)
    assert langid.gram_counts("12 !?") is None is plain_counts("12 !?")


def test_fit_equals_plain_ftrl(spark):
    words = {"en": "the and that with from this have which", "fr": "le la les des une est dans pour", "de": "der die und ist nicht mit"}
    rows = [(i, " ".join(words[lang].split()[(i + j) % 6] for j in range(3 + i % 4)), lang, "a", 0)
            for i, lang in enumerate(["en", "fr", "de", "en"] * 15)]
    docs = frame(spark, rows)
    model = langid.fit(docs, max_train=1000, epochs=2)
    h = {r["doc_id"]: r["h"] for r in docs.select("doc_id", F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 40)).alias("h")).collect()}
    texts = sorted((h[i], lang, text) for i, text, lang, *_ in rows)
    counts = [plain_counts(t) for _, _, t in texts]
    df = {}
    for c in counts:
        for cell in c:
            df[cell] = df.get(cell, 0) + 1
    langs = sorted(words)
    data = []
    for (_, lang, _), c in zip(texts, counts):
        x = {cell: math.log1p(n) * (math.log((1 + len(rows)) / (1 + df[cell])) + 1) for cell, n in c.items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        data.append(({**{cell: v / norm for cell, v in x.items()}, "bias": 1.0}, langs.index(lang)))
    z, n = {}, {}

    def weight(cell, k):
        zi = z.get((cell, k), 0.0)
        return 0.0 if abs(zi) <= 0.02 else -(zi - math.copysign(0.02, zi)) / ((1.0 + math.sqrt(n.get((cell, k), 0.0))) / 0.5 + 0.02)

    for _ in range(2):
        for x, y in (d for i, d in enumerate(data) if i % 4):
            w = {(c, k): weight(c, k) for c in x for k in range(3)}
            score = [sum(x[c] * w[c, k] for c in x) for k in range(3)]
            e = [math.exp(s - max(score)) for s in score]
            for c in x:
                for k in range(3):
                    g = x[c] * (e[k] / sum(e) - (k == y))
                    was = n.get((c, k), 0.0)
                    step = (math.sqrt(was + g * g) - math.sqrt(was)) / 0.5
                    z[c, k] = z.get((c, k), 0.0) + g - step * w[c, k]
                    n[c, k] = was + g * g
    assert model.langs == langs
    want = np.array([[weight(c, k) for k in range(3)] for c in range(langid.DIMS)])
    assert np.allclose(model.weights, want, atol=1e-9) and np.abs(want).sum() > 0 and (want == 0).mean() > 0.5
    assert model.bias == pytest.approx([weight("bias", k) for k in range(3)], abs=1e-9)
