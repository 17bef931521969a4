"""Secret scan: fixed patterns, and automata inferred from the credentials they find.

* Base spans: three patterns (fixed values of the contract) over the whole text.
* Grammar inference: the values of the base spans are labelled credentials. At
  most ``MAX_TRAIN`` distinct values per kind (of up to ``MAX_VALUE`` signs), chosen by hash, build a prefix
  tree over character classes; states whose stop and next-class frequencies are
  statistically compatible (Hoeffding bound, recursively) are merged in
  red-blue order, which gives one probabilistic automaton per kind. A further
  automaton is inferred in the same way from at most ``MAX_TRAIN`` tokens that
  are not credentials, one for tokens of ``LONG`` signs or more and one for shorter ones.
* Every run of ``MIN_TOKEN`` or more credential characters outside the base spans is
  scored as a whole and, where that is no credential, from each start (its own, and
  behind each of ``/ . = + _ -``) to each end (its own, and before each of these
  signs), so that a name, a path or punctuation around a credential does not hide it:
  the log-likelihood per sign under each kind's automaton. A part becomes a span of
  kind ``format`` if it reaches that kind's threshold (the lowest tenth of the
  training values set aside, less a margin) and beats the automaton of other
  tokens of its length by ``MARGIN`` bits in all; of overlapping parts the longest is taken.
  Long runs are not scored pair by pair: starts that reach one state of the automata at
  one place go on without those another one beats, and a start ends where no end behind
  can lift it to the threshold.

Positions are code points, ends exclusive. Edge cases: null and empty texts have
no spans; repeated rows are each scanned; with no credential in the table no
automaton is inferred and only base spans are returned; long texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodic.llm.common import released, slices

# The contract's patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "format")

MIN_TOKEN = 6             # as the contract's shortest value
LONG = 16
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_TOKEN)
PARTS = frozenset("/.=+_-")
MAX_TRAIN = 400
MAX_VALUE = 4096           # signs of a value that trains
STRIDE = 64                # signs between two places where the starts of a long run are looked over
ALPHA = 0.05
MARGIN = 10.0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base spans, by start and then kind."""
    if not text:
        return []
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


# ---------------------------------------------------------------- automata

_CLASS = {c: "h" for c in "abcdef"} | {c: "l" for c in "ghijklmnopqrstuvwxyz"} | {c: "H" for c in "ABCDEF"} \
    | {c: "U" for c in "GHIJKLMNOPQRSTUVWXYZ"} | {c: "d" for c in "0123456789"}
#: Each sign to one of its class: what the automata say of a run depends on the classes alone.
_LIKE = str.maketrans({c: {"h": "a", "l": "g", "H": "A", "U": "G", "d": "0"}[k] for c, k in _CLASS.items()})
_SIZE = {"h": 6, "l": 20, "H": 6, "U": 20, "d": 10}


def classes(value: str) -> list[str]:
    """The value's signs as classes; other signs stand for themselves."""
    return [_CLASS.get(c, c) for c in value]


@dataclass
class State:
    count: int = 0
    stop: int = 0
    next: dict = field(default_factory=dict)       # class -> [state number, count]


class Automaton:
    """Probabilistic automaton inferred from values by merging states of their prefix tree."""

    def __init__(self, values: list[str], alpha: float = ALPHA):
        self.states = [State()]
        for v in values:
            s = 0
            self.states[0].count += 1
            for c in classes(v):
                edge = self.states[s].next.get(c)
                if edge is None:
                    self.states.append(State())
                    edge = self.states[s].next[c] = [len(self.states) - 1, 0]
                edge[1] += 1
                s = edge[0]
                self.states[s].count += 1
            self.states[s].stop += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge()
        self._steps: dict = {}

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            p, q = self.states[a], self.states[b]
            if not p.count or not q.count:
                continue
            if self._differ(p.stop, p.count, q.stop, q.count):
                return False
            for c in p.next.keys() | q.next.keys():
                x, y = p.next.get(c), q.next.get(c)
                if self._differ(x[1] if x else 0, p.count, y[1] if y else 0, q.count):
                    return False
                if x and y:
                    todo.append((x[0], y[0]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds the tree below state b to state a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            p, q = self.states[a], self.states[b]
            p.count += q.count
            p.stop += q.stop
            for c, (s, n) in q.next.items():
                if c in p.next:
                    p.next[c][1] += n
                    todo.append((p.next[c][0], s))
                else:
                    p.next[c] = [s, n]

    def _merge(self) -> None:
        red, number = [0], {0}
        while True:
            # the most frequent state just beyond the red ones
            blue = max(((self.states[e[0]].count, -e[0], r, c) for r in red for c, e in self.states[r].next.items()
                        if e[0] not in number), default=None)
            if blue is None:
                break
            b, r, c = -blue[1], blue[2], blue[3]
            into = next((a for a in red if self.compatible(a, b)), None)
            if into is None:
                red.append(b)
                number.add(b)
            else:
                self.states[r].next[c][0] = into
                self._fold(into, b)
        self.red = red

    def step(self, s: int, sign: str) -> tuple[float, int]:
        """Bits of a sign in a state and the next state (unseen steps get a small share and stay)."""
        got = self._steps.get((s, sign))
        if got is None:
            c = _CLASS.get(sign, sign)
            st, width = self.states[s], math.log2(_SIZE.get(c, 1))
            edge = st.next.get(c)
            got = self._steps[s, sign] = ((math.log2(0.5 / (st.count + 1) / 32) - width, s) if edge is None else
                                          (math.log2((edge[1] + 0.5) / (st.count + 1)) - width, edge[0]))
        return got

    def end(self, s: int) -> float:
        return math.log2((self.states[s].stop + 0.5) / (self.states[s].count + 1))

    def reach(self, run: str, least: float) -> list[dict[int, float]]:
        """At every STRIDE-th place and for each state: the most by which the rest of a run, up to any of its ends, exceeds ``least`` a sign."""
        place = {s: i for i, s in enumerate(self.red)}
        ends = np.array([self.end(s) for s in self.red]) - least
        signs = {}
        for c in set(run):
            steps = [self.step(s, c) for s in self.red]
            signs[c] = np.array([b for b, _ in steps]) - least, np.array([place[s] for _, s in steps])
        out, most = [], ends
        for p in range(len(run) - 1, -1, -1):        # most: behind sign p
            if p < len(run) - 1 and run[p] not in PARTS and run[p + 1] in PARTS:
                most = np.maximum(most, ends)
            if p % STRIDE == STRIDE - 1:
                out.append(dict(zip(self.red, most.tolist())))
            gain, to = signs[run[p]]
            most = gain + most[to]
        return out[::-1]

    def bits(self, value: str) -> float:
        """Base-2 log-likelihood of a value."""
        s, total = 0, 0.0
        for c in value:
            b, s = self.step(s, c)
            total += b
        return total + self.end(s)


class Flat:
    """Stands for other tokens where none was seen: six bits a sign."""

    def step(self, s: int, sign: str) -> tuple[float, int]:
        return -6.0, 0

    def end(self, s: int) -> float:
        return -6.0

    def bits(self, value: str) -> float:
        return -6.0 * (len(value) + 1)


def _front(rows: list) -> list:
    """The (excess, lead, start) rows that no other row beats in both."""
    out = []
    for r in sorted(rows, key=lambda r: (-r[0], -r[1], r[2])):
        if not out or r[1] > out[-1][1]:
            out.append(r)
    return out


@dataclass
class Model:
    kinds: list[tuple[Automaton, float]]       # and the threshold in bits a sign
    other: Automaton | None                    # of tokens of LONG or more
    short: Automaton | None = None             # of shorter ones

    def __post_init__(self):
        self._long, self._short = self.other or Flat(), self.short or Flat()
        self._known = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_known"} | {"_known": None}

    def is_secret(self, value: str) -> bool:
        n = len(value) + 1
        for automaton, least in self.kinds:
            b = automaton.bits(value)
            if b / n >= least and b - (self._long if len(value) >= LONG else self._short).bits(value) >= MARGIN:
                return True
        return False

    def parts(self, run: str) -> list[tuple[int, int]]:
        """(start, end) of the credentials in a run of credential characters, by start."""
        if len(run) < MIN_TOKEN:
            return []
        if self.is_secret(run):
            return [(0, len(run))]
        if PARTS.isdisjoint(run):
            return []
        found: set[tuple[int, int]] = set()
        for automaton, least in self.kinds:
            self._parts(run, automaton, least, found)
        taken: list[tuple[int, int]] = []
        free = bytearray(len(run))
        for s, e in sorted(found, key=lambda p: (p[0] - p[1], p)):
            if not (free[s] or free[e - 1]):         # a longer part covers neither end, so it lies outside
                taken.append((s, e))
                free[s:e] = b"\1" * (e - s)
        return sorted(taken)

    def _parts(self, run: str, automaton: Automaton, least: float, found: set) -> None:
        new: list[list] = []                         # of fewer than LONG signs: start, states, excess, lead over short, over long
        old: dict[tuple[int, int], list] = {}        # states -> (excess, lead, start)
        short, long, last = self._short, self._long, len(run) - 1
        reach = automaton.reach(run, least) if len(run) > 4 * STRIDE else None
        for p, c in enumerate(run):
            if p == 0 or (run[p - 1] in PARTS and c not in PARTS):
                new.append([p, 0, 0, 0, 0.0, 0.0, 0.0])
            go: dict[tuple[int, int], list] = {}
            for (a, o), rows in old.items():
                x, a = automaton.step(a, c)
                y, o = long.step(o, c)
                go.setdefault((a, o), []).extend((r[0] + x - least, r[1] + x - y, r[2]) for r in rows)
            for r in new:
                x, r[1] = automaton.step(r[1], c)
                y, r[2] = short.step(r[2], c)
                z, r[3] = long.step(r[3], c)
                r[4] += x - least
                r[5] += x - y
                r[6] += x - z
            if new and p + 1 - new[0][0] == LONG:
                r = new.pop(0)
                go.setdefault((r[1], r[3]), []).append((r[4], r[6], r[0]))
            if reach and p % STRIDE == STRIDE - 1:
                most = reach[p // STRIDE]
                go = {k: rows for k, rows in ((k, [r for r in rows if r[0] + most[k[0]] > -1e-6]) for k, rows in go.items()) if rows}
            old = {k: rows if len(rows) == 1 else _front(rows) for k, rows in go.items()}
            if p == last or (c not in PARTS and run[p + 1] in PARTS):
                for (a, o), rows in old.items():
                    x, y = automaton.end(a), long.end(o)
                    found.update((s, p + 1) for excess, lead, s in rows if excess + x - least >= 0 and lead + x - y >= MARGIN)
                for s, a, o, _, excess, lead, _ in new:
                    x = automaton.end(a)
                    if p + 1 - s >= MIN_TOKEN and excess + x - least >= 0 and lead + x - short.end(o) >= MARGIN:
                        found.add((s, p + 1))

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        found = base_spans(text)
        if not text or not self.kinds:
            return found
        if self._known is None:                      # words of like classes come again and again
            self._known = lru_cache(1 << 16)(self.parts)
        more, at = [], 0
        for s, e in [*sorted((s, e) for s, _, e in found), (len(text), len(text))]:
            if s - at >= MIN_TOKEN:                  # between base spans
                like = text[at:s].translate(_LIKE)
                some = {r: p for r in set(TOKEN.findall(like)) if (p := self._known(r) if len(r) <= 64 else self.parts(r))}
                if some:
                    more += [(at + m.start() + x, 3, at + m.start() + y) for m in TOKEN.finditer(like) for x, y in some.get(m.group(), ())]
            at = max(at, e)
        return sorted(found + more)


def values(text: str) -> set[tuple[int, str]]:
    """(kind, value) a text has to train with: its credentials, and its other tokens (kind 3: long, 4: short)."""
    spans = base_spans(text)
    out = {(kind, ASSIGN.match(text, a).group(2) if kind == 0 else text[a:e]) for a, kind, e in spans}
    for m in TOKEN.finditer(text):
        if not any(a < m.end() and e > m.start() for a, _, e in spans):
            out.add((3 if m.end() - m.start() >= LONG else 4, m.group()))
    return out


class Smallest:
    """The ``n`` values of smallest hash of each kind, whatever order and however often they come."""

    def __init__(self, n: int):
        self.n, self.held, self.bound = n, [{} for _ in range(5)], [None] * 5

    def add(self, kind: int, value: str) -> None:
        held = self.held[kind]
        if value in held:
            return
        # the signed 64-bit hash of Spark's xxhash64
        h = xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"), 42)
        key = (h - (1 << 64) if h >> 63 else h, value)
        if self.bound[kind] is not None and key > self.bound[kind]:
            return
        held[value] = key
        if len(held) >= 2 * self.n:
            self.cut(kind)

    def cut(self, kind: int) -> None:
        keep = sorted(self.held[kind].values())[:self.n]
        self.held[kind] = {v: (h, v) for h, v in keep}
        if len(keep) == self.n:
            self.bound[kind] = keep[-1]

    def rows(self) -> list[tuple[int, str, int]]:
        for kind in range(5):
            self.cut(kind)
        return [(kind, v, h) for kind, held in enumerate(self.held) for v, (h, _) in held.items()]


def infer(docs: DataFrame, max_train: int = MAX_TRAIN, longest: int = MAX_VALUE) -> Model:
    """Automata from the labelled credentials of ``docs(text)``; at most ``max_train`` values per kind reach the driver.

    The values of smallest hash train. Each task keeps that many of each kind, so a task sends a bounded number of rows
    whatever it reads; values of more than ``longest`` signs do not train (they are scored like any other)."""

    def found(batches):
        least = Smallest(max_train)
        for batch in batches:
            for text in batch.column("text"):
                text = text.as_py()
                if text:
                    for kind, value in values(text):
                        if len(value) <= longest:
                            least.add(kind, value)
        rows = least.rows()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64()))],
                                         ["kind", "value", "h"])

    rows = docs.select("text").mapInArrow(released(found), "kind int, value string, h long").distinct()
    # first within shares of the hashes, then over what these leave: no task holds all rows of a kind
    for part in (["kind", F.pmod("h", F.lit(256))], ["kind"]):
        rank = F.row_number().over(Window.partitionBy(*part).orderBy("h", "value"))
        rows = rows.withColumn("r", rank).where(F.col("r") <= max_train).drop("r")
    per_kind: list[list[str]] = [[], [], [], [], []]
    for r in rows.orderBy("kind", "h", "value").collect():
        per_kind[r["kind"]].append(r["value"])
    kinds = []
    for vs in per_kind[:3]:
        seen, held = (vs, vs) if len(vs) < 10 else ([v for i, v in enumerate(vs) if i % 5], vs[::5])
        if seen:
            a = Automaton(seen)
            scores = sorted(a.bits(v) / (len(v) + 1) for v in held)
            kinds.append((a, scores[len(scores) // 10] - 0.25))
    return Model(kinds, *(Automaton(vs) if vs else None for vs in per_kind[3:]))


def digest(model: Model, text: Column) -> Column:
    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def run(s: pd.Series) -> pd.DataFrame:
        out = []
        for text in s:
            spans = model.spans(text)
            told = [(k, f"{KINDS[k]}:{a}:{e}") for a, k, e in spans]
            n = [sum(k == i for k, _ in told) for i in range(3)]
            base = ",".join(x for k, x in told if k < 3)
            out.append((*n, hashlib.sha256(base.encode()).hexdigest(), ",".join(x for _, x in told)))
        return pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run(text)


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    model = infer(docs.select("text"))
    return docs.select("doc_id", digest(model, F.col("text")).alias("s")).select("doc_id", "s.*")


def redact(model: Model, text: str | None) -> str | None:
    """The text with every run of overlapping spans replaced by ``[secret]``."""
    spans = model.spans(text)
    if not spans:
        return text
    out, at, end = [], 0, -1
    for a, _, e in spans:
        if a > end or end < 0:
            if end >= 0:
                at = end
            out += [text[at:a], "[secret]"]
            end = e
        end = max(end, e)
    return "".join(out) + text[end:]


def without_secrets(docs: DataFrame) -> DataFrame:
    """Pipeline stage: secrets are blotted out of every text (``n_chars`` follows); no document is dropped, columns unchanged."""
    model = infer(docs.select("text"))

    def clean(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                old = part.column("text").to_pylist()
                new = [redact(model, t) for t in old]
                at = part.schema.get_field_index("text")
                part = part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type))
                at = part.schema.get_field_index("n_chars")
                if at >= 0:
                    kind = part.schema.field(at)
                    size = pa.array([len(b) if a != b else None for a, b in zip(old, new)], pa.int64()).cast(kind.type)
                    part = part.set_column(at, kind, pc.coalesce(size, part.column(at)))
                yield part

    # whole rows pass through: no column of the caller's is added, renamed or dropped
    return docs.mapInArrow(released(clean), docs.schema)
