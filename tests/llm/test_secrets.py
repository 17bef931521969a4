import hashlib
import random
import re
import string

from episodic.llm import secrets
from llm.helpers import MID, clashing, documents, edge_rows, frame, pandas

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain(text):
    """Base spans straight from the contract's patterns."""
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(found)


def credentials(n, seed):
    random.seed(seed)
    keys = ["AKIA" + "".join(random.choice(string.ascii_uppercase + string.digits) for _ in range(16)) for _ in range(n)]
    return keys, ["ghp-" + "".join(random.choice(string.ascii_letters + string.digits) for _ in range(36)) for _ in range(n)]


def test_base_spans_equal_the_patterns(spark):
    out = pandas(secrets.scan_documents(spark.read.parquet(f"{MID}/documents.parquet")))
    for i, t in documents(MID).text.items():
        want = plain(t)
        r = out.loc[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(w[1] == k for w in want) for k in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{e}" for a, _, k, e in want).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("format")] == [f"{k}:{a}:{e}" for a, _, k, e in want]


def test_odd_base_cases():
    for t in ["PassWord: 'abcdef' tokenapi_key=123456", "token=abc token=abcdef", "ſecret=abcdefgh", "AKIA" * 9, "x" + "a" * 24 + "g" + "0" * 23,
              "é token = \"" + "f" * 40 + "\" end", "secret:secret:secret=abcdefg", "apikey  ==abcdefgh", "token = \n abcdefgh"]:
        assert [(a, e, secrets.KINDS[k]) for a, k, e in secrets.base_spans(t)] == [(a, e, k) for a, _, k, e in plain(t)], t


def test_automata_find_bare_credentials_and_leave_words_alone(spark):
    keys, tokens = credentials(120, 1)
    rows = [(i, f"some words password = {t} and {k} end", "en", "a", 1) for i, (k, t) in enumerate(zip(keys, tokens))]
    rows += [(1000 + i, f"order 47375380{i:04}5923 of internationalisation unquestionablyverylong2024-01-{i:02}", "en", "a", 1) for i in range(90)]
    model = secrets.infer(frame(spark, rows).select("text"))
    _, fresh = credentials(100, 2)
    found = sum(any(k == 3 for _, k, _ in model.spans(f"bare {t} here")) for t in fresh)
    assert found >= 90
    assert not any(model.spans(r[1]) for r in rows if r[0] >= 1000)
    assert model.spans("a plain sentence about counterrevolutionaries and antidisestablishmentarianism") == []


def test_credentials_behind_names_and_paths_and_short_ones(spark):
    keys, tokens = credentials(120, 1)
    random.seed(5)
    short = ["".join(random.choice(string.digits + "GHJKMNPQRSTUVWXYZ") for _ in range(12)) for _ in range(240)]
    rows = [(i, f"some words password = {t} and secret = {p} and {k} end", "en", "a", 1) for i, (k, t, p) in enumerate(zip(keys, tokens, short))]
    rows += [(1000 + i, f"order 47375380{i:04}5923 of /usr/share/doc{i}/readme.txt at internationalisation a_name=value{i} of 2024-01-{i:02}", "en", "a", 1)
             for i in range(90)]
    model = secrets.infer(frame(spark, rows).select("text"))
    _, fresh = credentials(50, 2)
    for around in ("auth={}", "client_key={}", "https://host.example/path/{}/rest", "https://host.example/q?client.id=7&auth={}.", "{}.", "{}=="):
        text = [around.format(t) for t in fresh]
        found = [any(k == 3 and a <= x.index(t) and e >= x.index(t) + len(t) for a, k, e in model.spans(x)) for x, t in zip(text, fresh)]
        assert sum(found) >= 45, around
    assert sum(any(k == 3 for _, k, _ in model.spans(f"bare {p} here")) for p in short[120:]) >= 100
    assert not any(model.spans(r[1]) for r in rows if r[0] >= 1000)
    # beside a base span in the same run
    x = f"{fresh[0]}/{keys[0]}"
    assert [k for _, k, _ in model.spans(x)] == [3, 1]


def test_parts_of_a_run_equal_every_pair(spark):
    keys, tokens = credentials(60, 1)
    rows = [(i, f"password = {t} and {k} of words/and_names={i}.txt", "en", "a", 1) for i, (k, t) in enumerate(zip(keys, tokens))]
    model = secrets.infer(frame(spark, rows).select("text"))
    random.seed(6)
    for n in range(200):
        run = "".join(random.choice(["/", "=", ".", "-", "_", "+", "name", "x", random.choice(tokens), random.choice(tokens)[:9]]) for _ in range(6))
        marks = secrets.PARTS
        starts = [p for p in range(len(run)) if p == 0 or (run[p - 1] in marks and run[p] not in marks)]
        ends = [p for p in range(1, len(run) + 1) if p == len(run) or (run[p - 1] not in marks and run[p] in marks)]
        want = [(s, e) for s in starts for e in ends if e - s >= 6 and model.is_secret(run[s:e])]
        got = model.parts(run)
        assert all(p in want for p in got) and bool(got) == bool(want), run
        assert all(a[1] <= b[0] for a, b in zip(got, got[1:]))
    # a long run: the same parts as without the pruning of starts, and not pair by pair
    run = "/".join(["name", tokens[0], "x", "ab.cd=ef"] * 6)
    assert model.parts(run) and {run[s:e] for s, e in model.parts(run)} <= {run[s:e] for s in range(len(run)) for e in range(s, len(run) + 1)
                                                                         if model.is_secret(run[s:e])}
    assert sum(t in run[s:e] for s, e in model.parts(run) for t in tokens[:1]) >= 1
    model.parts("/".join(str(i) + "ab" for i in range(5000)))


def test_merging_gives_a_small_loop_and_a_distribution():
    random.seed(3)
    values = ["".join(random.choice("0123456789") for _ in range(random.randint(10, 30))) for _ in range(200)]
    a = secrets.Automaton(values)
    assert len(a.red) < 30
    assert a.bits("1234567890123") / 14 > a.bits("zzzzzzzzzzzzz") / 14 + 3


def test_edge_cases_and_redaction(spark):
    secret = "token = \"" + "0a" * 20 + "\""
    rows = edge_rows() + [(50, f"x {secret} y", "en", "a", 5), (51, None, None, None, None)]
    out = pandas(secrets.scan_documents(clashing(frame(spark, rows))))
    assert len(out) == len(rows) and out.loc[50].n_assign == 1 and out.loc[50].n_hex == 1 and out.loc[2].spans == ""
    assert out.loc[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert secrets.scan_documents(frame(spark, [])).count() == 0
    docs = clashing(frame(spark, rows))
    clean = secrets.without_secrets(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    got = {r["doc_id"]: r for r in clean.collect()}
    assert got[50]["text"] == "x [secret]\" y" and got[50]["n_chars"] == len(got[50]["text"])
    assert got[1]["text"] == rows[0][1] and got[2]["text"] is None and got[51]["n_chars"] is None


def test_training_values_are_the_smallest_hashes_however_the_rows_lie(spark):
    import xxhash
    rows = [(i, f"password = p{i:05}x{i * 7919 % 1000} and word{i % 50}s some longer-token-number-{i % 333}", "en", "a", 1) for i in range(3000)]
    rows += [(9000, "secret=" + "q" * 5000, "en", "a", 1)]
    told = set()
    for r in rows:
        told |= secrets.values(r[1])

    def key(v):
        h = xxhash.xxh64_intdigest(v.encode(), 42)
        return (h - (1 << 64) if h >> 63 else h, v)
    want = [sorted((v for k, v in told if k == kind and len(v) <= 4096), key=key)[:40] for kind in range(5)]
    kept = secrets.Smallest(40)
    for k, v in sorted(told):
        if len(v) <= 4096:
            kept.add(k, v)
    assert [sorted(((v) for k, v, _ in kept.rows() if k == kind), key=key) for kind in range(5)] == want
    got = []
    original = secrets.Automaton
    try:
        secrets.Automaton = lambda values, *a: got.append(list(values)) or original(values, *a)
        secrets.infer(frame(spark, rows).repartition(7).select("text"), 40)
    finally:
        secrets.Automaton = original
    assert got == [[v for i, v in enumerate(want[0]) if i % 5], *want[3:]]
