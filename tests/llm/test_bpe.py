import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from episodic.llm import bpe
from llm.helpers import clashing, documents, edge_rows, frame, pandas


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def check(library, texts, got):
    for t, (ids, back) in zip(texts, got):
        want = library.encode(t, add_special_tokens=False).ids
        assert list(np.frombuffer(ids, "<u4")) == want, repr(t)
        assert back == library.decode(want, skip_special_tokens=False), repr(t)


def test_equals_the_library_on_documents_and_mixed_signs(library):
    random.seed(5)
    odd = ["'s", "'S", "'ll", "\n", "\x1c", "\x85", " ", "　", "<|endoftext|>", "<|startoftext|>", "Σ", "İ", "ß", "é",
           "①", "½", "٣", "ΑΣ", "՘", "꟎", "\U00010d50", "\U0001246f", "​", "tion" * 9]
    texts = ["".join(random.choice(odd) if random.random() < .2 else chr(random.choice([random.randint(32, 126), random.randint(160, 0x2fff)]))
                     for _ in range(random.randint(0, 50))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 3000 + "é" * 200, "x" * 48, "x" * 49, "tionthe" * 7, ""]
    texts += documents().text.tolist()
    check(library, texts, bpe.tokenizer().encode_many(texts))


def test_every_single_sign(library):
    signs = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = ["a" + "b".join(map(chr, signs[i:i + 64])) for i in range(0, len(signs), 64)]
    check(library, texts, bpe.tokenizer().encode_many(texts))


def test_long_words_merge_alike():
    t = bpe.tokenizer()
    random.seed(2)
    for _ in range(50):
        word = "".join(random.choice("theinganro") for _ in range(random.randint(2, bpe.SHORT)))
        raw = np.frombuffer(word.encode(), np.uint8)
        ids = t.byte[raw][None, :].copy()
        ids[0, -1] = t.last[raw[-1]]
        a, n = t.merge(ids.copy(), np.array([len(raw)]))
        assert a[0, :n[0]].tolist() == t.merge_long(ids[0].tolist())


def test_cache_does_not_change_results(monkeypatch):
    texts = documents().text.tolist()[:40]
    want = bpe.tokenizer().encode_many(texts)
    monkeypatch.setattr(bpe, "CACHE", 10)
    monkeypatch.setattr(bpe, "GROUP", 2000)
    assert bpe.tokenizer().encode_many(texts) == want


def test_special_strings_as_text():
    assert len(bpe.tokenizer().encode("a <|endoftext|> b")[0]) == 12
    assert b"\xff\xc0" not in bpe.tokenizer().encode("a <|endoftext|> b", special_as_text=True)[0]


def test_documents_and_edge_cases(spark, library):
    rows = edge_rows()
    out = pandas(bpe.encode_documents(clashing(frame(spark, rows))))
    assert len(out) == len(rows)
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        r = out.loc[[i]].iloc[0]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_documents(frame(spark, [])).count() == 0


def test_round_trip_columns(spark):
    df = frame(spark, [(1, "Hello  world", "en", "a", 1), (2, None, "en", "a", 1)]).select("doc_id", bpe.encode("text").alias("ids"))
    got = {r["doc_id"]: r["t"] for r in df.select("doc_id", bpe.decode("ids").alias("t")).collect()}
    assert got == {1: "hello</w> world</w>", 2: ""}
