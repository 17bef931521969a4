import numpy as np
import pytest

from episodic.llm import bpe, tokenfiles
from llm.helpers import SMALL, clashing, documents, edge_rows, frame, pandas


def test_counts_equal_the_encoder(spark):
    out = pandas(tokenfiles.count_tokens(spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3)))
    got = bpe.tokenizer().encode_many(documents().text.tolist(), special_as_text=True)
    assert out.n_tokens.tolist() == [len(a) // 4 for a, _ in got]


@pytest.mark.parametrize("block", [1, 2, 7, 64])
def test_scan_equals_a_plain_pass(spark, block):
    rng = np.random.default_rng(block)
    files, rows = {}, []
    for f in range(4):
        ids = rng.integers(0, 6, rng.integers(0, 300)).astype("<u2")
        if f == 1:
            ids[:] = 5                                   # separators only
        if f == 2:
            ids = np.where(ids == 5, 0, ids).astype("<u2")   # none at all
        files[f] = ids
        rows += [(f, i // block, ids[i:i + block].tobytes()) for i in range(0, len(ids), block)]
    df = spark.createDataFrame(rows, "file long, block long, tokens binary").repartition(5)
    got = {(r["file"], r["ordinal"]): (r["start"], r["n_tokens"], r["ended"]) for r in tokenfiles.scan(df, separator=5).collect()}
    want = {}
    for f, ids in files.items():
        start = n = 0
        for i, x in enumerate(ids):
            if x == 5:
                want[f, n] = (start, i - start, True)
                start, n = i + 1, n + 1
        if start < len(ids):
            want[f, n] = (start, len(ids) - start, False)
    assert got == want


def test_documents_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(tokenfiles, "BLOCK", 16)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 30")
    out = pandas(tokenfiles.count_tokens(docs))
    want = [len(a) // 4 for a, _ in bpe.tokenizer().encode_many(documents().text.tolist()[:30], special_as_text=True)]
    assert out.n_tokens.tolist() == want


def test_edge_cases(spark):
    rows = edge_rows() + [(90, "a <|endoftext|> b", "en", "a", 3)]
    out = tokenfiles.count_tokens(clashing(frame(spark, rows))).collect()
    assert len(out) == len(rows)
    got = {r["doc_id"]: r["n_tokens"] for r in out}
    for i, text, *_ in rows:
        assert got[i] == len(bpe.tokenizer().encode(text, special_as_text=True)[0]) // 4
    assert got[2] == got[3] == 0
    assert tokenfiles.count_tokens(frame(spark, [])).count() == 0
