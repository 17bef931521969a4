"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

* Features: character 1-, 2- and 3-grams of the lower-cased letters of the whole
  text (every run of other characters counts as one space), hashed to ``DIMS``
  cells; weight ``log(1 + count) * idf``, scaled to length one.
* Document frequencies are counted over *all* training documents (one row per
  cell and task, summed by Spark, so at most ``DIMS`` rows reach the driver).
* The weights are fitted by follow-the-regularised-leader (FTRL-proximal) with
  an elastic net (``l1``, ``l2``) on a bounded sample of labelled documents:
  at most ``max_train`` rows, chosen by a hash of the id, in equal shares per
  language. A quarter of it is set aside to fit the softmax temperature.
* ``predict`` sees the text alone.

Edge cases: a null text, or one without a letter, is ``und`` with score 0;
repeated rows are each scored; an empty table gives an empty result; with no
labelled document nothing is learned and every text is ``und``; the pipeline stage
then rejects only documents without a letter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodic.llm.common import crc_of_id, released, slices

DIMS = 1 << 15
SLICE = 1 << 19          # characters handled at once; a longer text is summed slice by slice
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of one text, or None if it has no letter."""
    if not text:
        return None
    total, letter = None, _letters()
    for i in range(0, len(text), SLICE):
        low = text[i:i + SLICE].lower()
        cp = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
        ok = letter[cp]
        if not ok.any():
            continue
        cp = np.where(ok, cp, np.uint32(32))
        keep = np.empty(len(cp), bool)
        keep[0] = True
        np.logical_or(ok[1:], ok[:-1], out=keep[1:])
        cp = np.concatenate([[32], cp[keep], [32]]).astype(np.uint32)
        a = cp * np.uint32(0x9E3779B1)
        b = (a[:-1] ^ (a[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + a[1:]
        c = (b[:-1] ^ (b[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE3D) + a[2:]
        shift = np.uint32(32 - DIMS.bit_length() + 1)
        n = sum(np.bincount((x * np.uint32(0x27D4EB2F)) >> shift, minlength=DIMS) for x in (a, b, c))
        total = n if total is None else total + n
    return total


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray      # DIMS x languages
    bias: np.ndarray
    temperature: float

    def features(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        idx = np.flatnonzero(counts)
        x = np.log1p(counts[idx]) * self.idf[idx]
        return idx, x / max(np.sqrt((x * x).sum()), 1e-12)

    def one(self, text: str | None) -> tuple[str, float]:
        counts = gram_counts(text)
        if counts is None or not self.langs:
            return "und", 0.0
        idx, x = self.features(counts)
        p = _softmax((x @ self.weights[idx] + self.bias) / self.temperature)
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts (column ``text``) each cell occurs, and how many texts there are."""

    def count(batches):
        df, n = np.zeros(DIMS + 1, np.int64), 0
        for batch in batches:
            for v in batch.column(0):
                c = gram_counts(v.as_py())
                n += 1
                if c is not None:
                    df[:DIMS] += c > 0
        df[DIMS] = n
        idx = np.flatnonzero(df)
        import pyarrow as pa
        yield pa.RecordBatch.from_arrays([pa.array(idx, pa.int32()), pa.array(df[idx], pa.int64())], ["cell", "n"])

    total = np.zeros(DIMS + 1, np.int64)
    for r in texts.select("text").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        total[r["cell"]] = r["n"]
    return total[:DIMS], int(total[DIMS])


def _sample(train: DataFrame, max_train: int) -> list:
    """At most ``max_train`` labelled rows as (lang, cells, counts); features are made on the executors."""
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n"))
             .orderBy(F.desc("n"), "lang").limit(max_train).collect()}
    if not sizes:
        return []
    share = max_train / len(sizes)
    h = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 40))
    cut = F.lit(0).cast("long")
    for lang, n in sizes.items():
        cut = F.when(F.col("lang") == lang, F.lit(int((1 << 40) * min(1.0, share / n)))).otherwise(cut)
    picked = train.withColumn("h", h).where(F.col("h") < cut)

    def featurise(batches):
        import pyarrow as pa
        for batch in batches:
            out = []
            for lang, hh, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                c = gram_counts(text)
                if c is not None:
                    idx = np.flatnonzero(c)
                    out.append((lang, hh, idx.astype(np.int32).tobytes(), c[idx].astype(np.int32).tobytes()))
            cols = list(zip(*out)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())],
                                             ["lang", "h", "cells", "counts"])

    return (picked.select("lang", "h", "text").mapInArrow(featurise, "lang string, h long, cells binary, counts binary")
            .orderBy("h", "lang", "cells").limit(max_train).collect())


def fit(labelled: DataFrame, max_train: int = 2000, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0,
        l1: float = 0.02, l2: float = 0.02) -> Model:
    """Learn from ``labelled(doc_id, text, lang)``; rows with a null lang take no part.

    ``max_train`` bounds the rows whose features reach the driver.
    """
    train = labelled.select("doc_id", "text", "lang").where("lang is not null and text is not null")
    df, n = document_frequencies(train)
    idf = np.log((1 + n) / (1 + df)) + 1
    rows = _sample(train, max_train)
    langs = sorted({r["lang"] for r in rows})
    k = len(langs)
    model = Model(langs, idf, np.zeros((DIMS, k)), np.zeros(k), 1.0)
    if k < 2:
        return model
    data = []
    for r in rows:
        counts = np.zeros(DIMS, np.int64)
        counts[np.frombuffer(r["cells"], np.int32)] = np.frombuffer(r["counts"], np.int32)
        idx, x = model.features(counts)
        data.append((np.append(idx, DIMS), np.append(x, 1.0), langs.index(r["lang"])))
    held, seen = data[::4], [d for i, d in enumerate(data) if i % 4]
    z, g2 = np.zeros((DIMS + 1, k)), np.zeros((DIMS + 1, k))

    def weights(idx):
        zi, ni = z[idx], g2[idx]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for _ in range(epochs):
        for idx, x, y in seen or data:
            w = weights(idx)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            step = (np.sqrt(g2[idx] + g * g) - np.sqrt(g2[idx])) / alpha
            z[idx] += g - step * w
            g2[idx] += g * g
    full = weights(slice(None))
    model.weights, model.bias = full[:DIMS], full[DIMS]
    if held:
        logits = np.array([x[:-1] @ model.weights[idx[:-1]] + model.bias for idx, x, _ in held])
        y = np.array([d[2] for d in held])

        def nll(t):
            return -np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-300)).mean()

        grid = np.exp(np.linspace(np.log(0.05), np.log(20), 120))
        model.temperature = float(min(grid, key=nll))
    return model


def predict(model: Model, text: Column) -> Column:
    """struct(lang, score) of every text: the learned language and its calibrated probability."""

    @F.pandas_udf("lang string, score double")
    def label(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.one(t) for t in s], columns=["lang", "score"])

    return label(text)


def held_out(c: str = "doc_id") -> Column:
    return crc_of_id(c) % 3 == 1


def label_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document (learned from those not held out)."""
    d = docs.select("doc_id", "text", "lang")
    model = fit(d.where(~held_out()))
    return (d.select("doc_id", held_out().alias("held_out"), predict(model, F.col("text")).alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score")))


def keep_known_languages(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Pipeline stage: documents whose language is recognised (not ``und``, calibrated probability at least ``min_score``).

    Where nothing was learned no language can be told, and every document with a letter stays.
    """
    model = fit(docs.select("doc_id", "text", "lang").where(~held_out()))

    def stays(text: str | None) -> bool:
        if not model.langs:
            return gram_counts(text) is not None
        lang, score = model.one(text)
        return lang != "und" and score >= min_score

    def keep(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array([stays(t.as_py()) for t in part.column("text")], pa.bool_()))

    # whole rows pass through: no column of the caller's is added, renamed or dropped
    return docs.mapInArrow(released(keep), docs.schema)
