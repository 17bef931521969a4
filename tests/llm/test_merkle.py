import zlib
from hashlib import sha256

import pytest

from episodic.llm import merkle
from llm.helpers import clashing, edge_rows, frame

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row):
    doc_id, text, lang, source, n_chars = row
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def steps(tree, i):
    out = []
    for level in tree[:-1]:
        run = level[i // 16 * 16:i // 16 * 16 + 16]
        out.append((i % 16, run[:i % 16] + run[i % 16 + 1:]))
        i //= 16
    return out


def plain(rows):
    """The whole manifest in one process: every row's result, in any order."""
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = levels([leaf_of(r) for r in groups[s]])
    top, out = levels([trees[s][-1][0] for s in names]), []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            path = steps(trees[s], i) + steps(top, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf_of((r[0], r[1].translate(UPPER) if hit and r[1] is not None else r[1], *r[2:]))
            for place, others in path:
                node = digest("".join(others[:place]) + node + "".join(others[place:]))
            out.append((r[0], trees[s][0][i], trees[s][-1][0], top[-1][0], digest("".join("".join(o) for _, o in path)), node, node == top[-1][0]))
    return sorted(out, key=str)


def got(df):
    cols = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=str)


def manifest(df, part):
    from pyspark.sql import functions as F
    leaf = merkle.leaf(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")))
    return merkle.manifest(df, "source", "doc_id", leaf, leaf, part)


def test_edge_rows(spark):
    rows = edge_rows() + [(None, "An Id That Is Null", "en", "a", 1), (None, None, None, None, None), (10, "Upper Case", "en", "é", 3)]
    assert got(merkle.manifest_documents(clashing(frame(spark, rows)))) == plain(rows)


def test_empty_table(spark):
    assert merkle.manifest_documents(frame(spark, [])).collect() == []


@pytest.mark.parametrize("hot", [1, 17, 257, 1500, 4113])
def test_butterfly_over_many_partitions(spark, hot):
    # sixteen leaves a partition: up to 258 partitions of the hot source, in short last runs and lanes without partition
    rows = [(i, f"Text {i % 300}", "en", "hot", i) for i in range(hot)] + [(10_000 + i, "x", "en", f"s{i % 20}", 0) for i in range(50)]
    rows += [(3, "same", "en", "many", 1)] * 40                              # one repeated row over several partitions
    want = {(r[0], r[4], r[1]) for r in plain(rows)}
    out = manifest(frame(spark, rows), 16).collect()
    assert {(r["doc_id"], r["proof_sha256"], r["leaf"]) for r in out} == want and len(out) == len(rows)
    assert all(r["folded_root"] == r["root"] for r in out)


def test_more_groups_than_a_partition(spark):
    rows = [(i, f"T{i}", None, f"s{i % 300:03}", i) for i in range(600)]
    want = {(r[0], r[4]) for r in plain(rows)}
    assert {(r["doc_id"], r["proof_sha256"]) for r in manifest(frame(spark, rows), 16).collect()} == want
