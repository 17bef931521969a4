import numpy as np

from episodic.llm import negatives
from llm.helpers import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, positives=5, count=10, least=30, most=90):
    """Every pair of (id, label, integer components) scored."""
    one = {}
    for i, label, q in rows:
        one[i] = min(one.get(i, (label, q)), (label, q))
    out = []
    for a, (la, qa) in one.items():
        if a % 100:
            continue
        score = [(-sum(x * y for x, y in zip(qa, q)), b, label) for b, (label, q) in one.items() if b != a and len(q) == len(qa)]
        score.sort()
        for ps, p, _ in [x for x in score if x[2] == la][:positives]:
            band = [x for x in score if x[2] != la and least * -ps <= 100 * -x[0] <= most * -ps][:count]
            out += [(a, p, r + 1, n, -ps, -s) for r, (s, n, _) in enumerate(band)]
    return sorted(out)


def integers(v):
    return tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)


def moved(i, label):
    return (label + 1) % 10 if i % 7 == 0 else label


def got(df):
    cols = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_intervals_hold_every_score_and_prune():
    rng = np.random.default_rng(3)
    for dim in (64, 10, 100):
        v = np.floor(256 * rng.normal(size=(500, dim)) / np.sqrt(dim))
        v[0], v[1], v[2] = 0, 1, v[3]
        codes, kept = negatives.encode(v)
        q = np.concatenate([v[:20], np.zeros((1, dim)), np.ones((1, dim))])
        lo, hi = negatives.intervals(codes, kept, q)
        exact = q @ v.T
        assert (lo <= exact).all() and (exact <= hi).all()
        # a width of about a quarter of the product of the lengths: most of a range of scores is decided
        width = (hi - lo)[3:20, 3:] / (np.linalg.norm(q[3:20], axis=1)[:, None] * np.linalg.norm(v[3:], axis=1))
        assert np.median(width) < 0.35


def test_against_every_pair_in_many_cells(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(10, 16))
    rows = []
    for i in range(3000):
        label = int(rng.integers(0, 10)) if i % 3 else 4                    # a third of all rows has one label
        v = centre[label] * 0.5 + rng.normal(size=16)
        rows.append((i, [float(x) for x in v / np.linalg.norm(v)], label))
    rows += [(5000 + i, rows[100][1], rows[100][2] if i % 2 else 9) for i in range(60)]      # ties
    df = spark.createDataFrame(rows, SCHEMA)
    coded = negatives.coded(df, "vec_id", "label", "embedding")
    want = plain([(i, label, integers(v)) for i, v, label in rows], 5, 10)
    assert len(want) > 1000
    assert got(negatives.hard_negatives(coded, coded.where("id % 100 = 0"), row_block=400, anchor_block=10)) == want


def test_odd_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=8)], i % 3) for i in range(0, 400, 10)]
    good = [(i, moved(i, label), integers(v)) for i, v, label in rows]
    odd = [(None, rows[0][1], 0), (1, None, 0), (2, [], 0), (3, [1.0] * 7 + [None], 0), (4, [1.0] * 7 + [float("nan")], 1),
           (5, [float("inf")] * 8, 1), (6, rows[0][1], None), (8, [3e9] * 8, 1)]
    more = [(500, [0.0] * 8, 1), (200, rows[20][1], 2), (200, rows[20][1], 2),                   # a zero vector, a repeated anchor
            (600, [1.0, 2.0], 1), (601, [1.0, 1.0], 1), (603, [0.5, 0.5], 2), (700, [1.0] * 3, 1)]
    want = plain(good + [(i, moved(i, label), integers(v)) for i, v, label in more])
    assert got(negatives.mine(clashing(spark.createDataFrame(rows + odd + more, SCHEMA)))) == want
    assert any(r[0] == 600 for r in want)


def test_empty_table(spark):
    assert negatives.mine(spark.createDataFrame([], SCHEMA)).collect() == []
