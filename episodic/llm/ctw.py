"""Language-model scores of whole texts: context-tree weighting over bytes, and an add-tenth word baseline.

Model. A text is its UTF-8 bytes and one end sign (0xFF, which UTF-8 never
uses); the ``DEPTH`` bytes before a sign are its context (0xFF before the
start). A byte is eight binary decisions; each decision node keeps, for the
contexts of length 0..DEPTH, how often 0 and 1 followed in training. Each node's
Krichevsky-Trofimov estimate is mixed with its deeper contexts by context-tree
weighting (``Pw = 1/2 Pkt + 1/2 prod Pw(children)``); after training the weights
are frozen, so a sign's probability depends on its context and itself alone.

Plan. Nothing learned is broadcast but the nodes of context length 0 and 1
(at most 256 * 255 of them). Documents are cut into blocks of about
``BLOCK_BYTES``; a block asks once for each distinct word and each distinct
(context, byte) in it. The requests are packed arrays, one for each block and
key range: the counts of a key meet in one task, the tree is built below each
two-byte context, and the answers go back to the block, which scores its
documents. A block whose stored rows are read back by several tasks asks once
for each run of its rows; a run is named by its first row. A very frequent key costs one request a block, not one an occurrence.
What is shuffled grows with the corpus; no count is capped.

Edge cases: null and empty texts consist of the end sign (one token) alone; a
null id counts as the empty text for the fold (held out); repeated rows are each
scored and counted; with no training document every decision has probability
1/2; an empty table gives an empty result. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodic.llm.common import crc_of_id, mix64, slices, stored, word_hashes
from episodic.operators.sinks import materialize

DEPTH = 5
BLOCK_BYTES = 32 << 20
RANGE_BYTES = 16 << 20   # bytes of text whose distinct keys one task looks after
PIECE = 1 << 20          # bytes of text turned into arrays at once
SMOOTH = 0.1             # fixed value of the contract's baseline
_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ---------------------------------------------------------------- packed arrays

def planes(a: np.ndarray) -> bytes:
    """Byte planes of an array: like bytes lie together, so the shuffle's compression finds them."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""


def unplanes(b: bytes, dtype) -> np.ndarray:
    w = np.dtype(dtype).itemsize
    return np.frombuffer(b, np.uint8).reshape(w, len(b) // w).T.copy().view(dtype).ravel()


def pack(keys: np.ndarray) -> bytes:
    return planes(np.diff(keys, prepend=keys.dtype.type(0)))


def unpack(b: bytes) -> np.ndarray:
    return np.cumsum(unplanes(b, _U), dtype=_U)


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of (keys, counts) parts and their summed counts."""
    if not parts:
        return np.empty(0, _U), np.empty(0, np.int64)
    keys, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


# ---------------------------------------------------------------- texts as arrays

def signs(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, start, length) of the texts of a batch, each between DEPTH signs 0xFF and an end sign 0xFF."""
    col = batch.column("text").cast(pa.large_binary())
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    valid = np.ones(len(col), bool) if not col.null_count else col.is_valid().to_numpy(zero_copy_only=False)
    n = np.where(valid, np.diff(off), 0)
    start = np.cumsum(n + DEPTH + 1) - n - 1
    out = np.full(int((n + DEPTH + 1).sum()), 0xFF, np.uint8)
    for s, k, o in zip(start, n, off[:-1]):
        out[s:s + k] = data[o:o + k]
    return out, start, n


def grams(buf: np.ndarray) -> np.ndarray:
    """For each sign from the DEPTH-th on: its context, newest byte first, and itself, as one number."""
    n = len(buf) - DEPTH
    code = buf[DEPTH:].astype(_U)
    for d in range(DEPTH):
        code |= buf[DEPTH - 1 - d:DEPTH - 1 - d + n].astype(_U) << _U(8 * (DEPTH - d))
    return code


def owner(start: np.ndarray, n: np.ndarray, total: int) -> np.ndarray:
    """Document number of each sign of ``grams(buf)``, -1 for the signs before a start."""
    own = np.full(total, -1, np.int32)
    for i, (s, k) in enumerate(zip(start, n)):
        own[s - DEPTH:s - DEPTH + k + 1] = i
    return own


def words(buf: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document number) of every lower-cased word."""
    w, at = word_hashes(np.where(buf == 0xFF, 0x20, _LOWER[buf]).astype(np.uint8))
    return w, np.searchsorted(start, at, side="right") - 1


# ---------------------------------------------------------------- passes over the texts

def _blocks(batches):
    """The documents with a block number (runs of a task's rows of about BLOCK_BYTES) and their place among the task's rows."""
    part, seq, held, rows = TaskContext.get().partitionId(), 0, 0, 0
    for batch in batches:
        size = np.array([64 + (v.as_buffer().size if v.is_valid else 0) for v in batch.column("text")], np.int64)
        run = held + np.cumsum(size)
        block = np.array(seq + run // BLOCK_BYTES, np.int64)
        if len(run):
            held = int(run[-1])
        place = np.arange(rows, rows + batch.num_rows, dtype=np.int64)
        rows += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(block | (part << 32)), pa.array(place), pa.array(size), *batch.columns],
                                         ["block", "place", "bytes", *batch.schema.names])


class Keys:
    """The distinct words and grams of a block with their training counts, gathered piece by piece."""

    def __init__(self):
        self.parts = [], []
        self.held = 0

    def add(self, piece) -> None:
        train = ~piece.column("held_out").to_numpy(zero_copy_only=False)
        buf, start, n = signs(piece)
        w, doc = words(buf, start)
        own = owner(start, n, len(buf) - DEPTH)
        ok = own >= 0
        for part, keys, seen in ((self.parts[0], w, train[doc]), (self.parts[1], grams(buf)[ok], train[own[ok]])):
            part.append(np.unique(keys[seen], return_counts=True))
            rest = np.unique(keys[~seen])
            part.append((rest, np.zeros(len(rest), np.int64)))
        self.held += 1
        if self.held % 8 == 0:
            self._merge()

    def _merge(self) -> None:
        for part in self.parts:
            part[:] = [summed(part)]

    def by_range(self, kind: int, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys and counts sorted by (range, key), and where each range begins. The same text gives the same arrays."""
        self._merge()
        keys, n = self.parts[kind][0]
        at = range_of(kind, keys, ranges)
        order = np.argsort(at, kind="stable")
        return keys[order], n[order], np.searchsorted(at[order], np.arange(ranges + 1, dtype=_U))


def range_of(kind: int, keys: np.ndarray, ranges: int) -> np.ndarray:
    return (keys if kind == 0 else mix64(keys)) % _U(ranges)


def _requests(ranges: int):
    def flush(block, first, keys):
        for kind in (0, 1):
            k, n, edge = keys.by_range(kind, ranges)
            rows = [(kind, r, block, first, pack(k[a:b]), planes(n[a:b])) for r, (a, b) in enumerate(zip(edge, edge[1:])) if b > a]
            cols = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                ["kind", "range", "block", "first", "keys", "n"])

    def run(batches):
        now, first, after, keys = None, 0, 0, Keys()
        for batch in batches:
            block, place = batch.column("block").to_numpy(), batch.column("place").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero((np.diff(block) != 0) | (np.diff(place) != 1)) + 1, [len(block)]])
            for lo, hi in zip(cuts, cuts[1:]):
                if hi <= lo:
                    continue
                if block[lo] != now or place[lo] != after:
                    if now is not None:
                        yield from flush(now, first, keys)
                    now, first, keys = block[lo], place[lo], Keys()
                after = place[hi - 1] + 1
                for piece in slices(batch.slice(lo, hi - lo), "text", PIECE):
                    keys.add(piece)
        if now is not None:
            yield from flush(now, first, keys)

    return run


def _word_counts(t: pa.Table) -> pa.Table:
    """All requests of a key range: each run of a block gets its words' training counts; block -1 gets the number of known words and their sum."""
    keys = [unpack(b) for b in t.column("keys").to_pylist()]
    n = [unplanes(b, np.int64) for b in t.column("n").to_pylist()]
    u, c = summed(list(zip(keys, n)))
    rows = [(b, f, r, planes(c[np.searchsorted(u, k)].astype(np.float64)), 0, 0)
            for b, f, r, k in zip(*(t.column(x).to_pylist() for x in ("block", "first", "range")), keys)]
    rows.append((-1, -1, -1, b"", int((c > 0).sum()), int(c.sum())))
    return pa.table(dict(zip(("block", "first", "range", "vals", "known", "total"), map(list, zip(*rows)))),
                    schema=pa.schema([("block", pa.int64()), ("first", pa.int64()), ("range", pa.int32()), ("vals", pa.binary()),
                                      ("known", pa.int64()), ("total", pa.int64())]))


def _gram_counts(t: pa.Table) -> pa.Table:
    u, c = summed([(unpack(k), unplanes(n, np.int64)) for k, n in zip(t.column("keys").to_pylist(), t.column("n").to_pylist())])
    return pa.table({"code": u.view(np.int64), "n": c})


# ---------------------------------------------------------------- the tree

def _lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma for x >= 1/2: eight steps up, then Stirling's series."""
    low = np.zeros_like(x)
    for k in range(8):
        low += np.log(x + k)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5) - 1 / (1680 * z ** 7) - low


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return _lgamma(n0 + 0.5) + _lgamma(n1 + 0.5) - _lgamma(n0 + n1 + 1.0) - math.log(math.pi)


class Level:
    """The nodes of one context length for one bit: sorted keys, counts, log Pkt, log Pw and the weight of stopping here."""

    def __init__(self, key, n0, n1, below=None):
        self.key, self.n0, self.n1 = key, n0, n1
        self.kt = log_kt(n0, n1)
        self.w = self.kt if below is None else np.logaddexp(self.kt, below) + math.log(0.5)
        self.stop = None if below is None else np.exp(np.minimum(self.kt + math.log(0.5) - self.w, 0.0))

    def ones(self) -> np.ndarray:
        """KT estimate that a 1 follows."""
        return (self.n1 + 0.5) / (self.n0 + self.n1 + 1.0)


def _level(context: np.ndarray, prefix: np.ndarray, n0, n1, below=None) -> tuple[Level, np.ndarray]:
    """Groups rows by (context, bit prefix); returns the level and each row's node."""
    u, inv = np.unique((context << _U(8)) | prefix, return_inverse=True)
    inv = inv.ravel()
    add = lambda v: np.bincount(inv, weights=v, minlength=len(u))
    return Level(u, add(n0), add(n1), None if below is None else add(below)), inv


def subtree(code: np.ndarray, n: np.ndarray, bit: int, least: int) -> list[tuple[Level, np.ndarray]]:
    """Levels DEPTH..least for one bit of the signs; with each, the node of every gram."""
    x = code & _U(0xFF)
    prefix = (_U(1) << _U(bit)) | (x >> _U(8 - bit))
    one = ((x >> _U(7 - bit)) & _U(1)).astype(bool)
    out: list[tuple[Level, np.ndarray]] = []
    ctx, pre, n0, n1, below, node = code >> _U(8), prefix, np.where(one, 0, n).astype(float), np.where(one, n, 0).astype(float), None, None
    for d in range(DEPTH, least - 1, -1):
        lev, inv = _level(ctx, pre, n0, n1, below)
        node = inv if node is None else inv[node]
        out.append((lev, node))
        ctx, pre, n0, n1, below = (lev.key >> _U(8)) >> _U(8), lev.key & _U(0xFF), lev.n0, lev.n1, lev.w
    return out


def _grams_of(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    code = t.column("code").to_numpy().view(_U)
    order = np.argsort(code)
    return code[order], t.column("n").to_numpy()[order]


def _top(t: pa.Table) -> pa.Table:
    """What the two-byte contexts pass up: counts and log Pw for each (newest byte, bit prefix)."""
    code, n = _grams_of(t)
    out = []
    for bit in range(8):
        lev = subtree(code, n, bit, 2)[-1][0]
        up, _ = _level((lev.key >> _U(8)) >> _U(8), lev.key & _U(0xFF), lev.n0, lev.n1, lev.w)
        # log Pw of the children adds up; the level's own weight is set once all groups are summed
        inv = np.searchsorted(up.key, ((lev.key >> _U(16)) << _U(8)) | (lev.key & _U(0xFF)))
        out.append((up.key, up.n0, up.n1, np.bincount(inv, weights=lev.w, minlength=len(up.key))))
    k, n0, n1, w = (np.concatenate(c) for c in zip(*out))
    return pa.table({"node": k.view(np.int64), "n0": n0, "n1": n1, "w": w})


def roots(rows) -> tuple[np.ndarray, ...]:
    """Dense arrays of the levels 1 and 0 from the summed (node, n0, n1, w): stop and KT by (newest byte, prefix) and by prefix."""
    n0, n1, w = (np.zeros((256, 256)) for _ in range(3))
    for r in rows:
        i, j = divmod(r["node"], 256)
        n0[i, j], n1[i, j], w[i, j] = r["n0"], r["n1"], r["w"]
    one = Level(None, n0, n1, w)
    zero = Level(None, n0.sum(axis=0), n1.sum(axis=0), one.w.sum(axis=0))
    return one.stop, one.ones(), zero.stop, zero.ones()


def _predictions(top):
    stop1, kt1, stop0, kt0 = top

    def run(t: pa.Table) -> pa.Table:
        code, n = _grams_of(t)
        total = np.zeros(len(code))
        newest, x = (code >> _U(8 * DEPTH)).astype(np.int64), (code & _U(0xFF)).astype(np.int64)
        for bit in range(8):
            q = None
            for lev, node in subtree(code, n, bit, 2):
                kt = lev.ones()[node]
                q = kt if q is None else lev.stop[node] * kt + (1 - lev.stop[node]) * q
            pre = (1 << bit) | (x >> (8 - bit))
            s = stop1[newest, pre]
            q = s * kt1[newest, pre] + (1 - s) * q
            q = stop0[pre] * kt0[pre] + (1 - stop0[pre]) * q
            total += np.log10(np.where((x >> (7 - bit)) & 1, q, 1 - q))
        return pa.table({"code": code.view(np.int64), "p": total})

    return run


def _answers(requests: pa.Table, model: pa.Table) -> pa.Table:
    code, p = model.column("code").to_numpy().view(_U), model.column("p").to_numpy()
    order = np.argsort(code)
    code, p = code[order], p[order].astype(np.float32)
    vals = [planes(p[np.searchsorted(code, unpack(k))]) for k in requests.column("keys").to_pylist()]
    return pa.table({"block": requests.column("block"), "first": requests.column("first"), "range": requests.column("range"),
                     "vals": pa.array(vals, pa.binary())})


class Lookup:
    """Values by key: a table of slots answers most keys by one read, binary search the rest."""

    def __init__(self, keys: np.ndarray, vals: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.vals = keys[order], vals[order]
        self.bits = max(10, int(2 * len(keys) + 1).bit_length())
        self.slot = np.zeros(1 << self.bits, np.int32)
        self.slot[self._at(self.keys)] = np.arange(len(keys), dtype=np.int32)

    def _at(self, k: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((k * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.bits)).astype(np.int64)

    def __call__(self, k: np.ndarray) -> np.ndarray:
        i = self.slot[self._at(k)]
        miss = np.flatnonzero(self.keys[i] != k)
        i[miss] = np.searchsorted(self.keys, k[miss])
        return self.vals[i]


def _scores(train_words: int, train_docs: int, known: int, ranges: int):
    total = train_words + train_docs
    vocabulary = known + (train_docs > 0)
    base = SMOOTH + 0.0
    scale = total + SMOOTH * (vocabulary + 1)
    end = math.log10((train_docs + base) / scale)

    def score(docs: pa.Table, got: dict[int, dict[int, bytes]]):
        pieces = [p for batch in docs.to_batches() for p in slices(batch, "text", PIECE)]
        keys = Keys()                            # as in the requests, so that the answers need not repeat them
        for p in pieces:
            keys.add(p)
        look = []
        for k, dtype in ((0, np.float64), (1, np.float32)):
            vals = [unplanes(got[k][r], dtype) for r in sorted(got[k])]
            look.append(Lookup(keys.by_range(k, ranges)[0], np.concatenate(vals) if vals else np.empty(0)))
            got[k].clear()
        del keys
        for piece in pieces:
            buf, start, n = signs(piece)
            rows = len(start)
            w, doc = words(buf, start)
            c = look[0](w) if len(w) else np.empty(0)
            own = owner(start, n, len(buf) - DEPTH)
            ok = own >= 0
            p = look[1](grams(buf)[ok])
            yield pa.table({
                "doc_id": piece.column("doc_id"), "held_out": piece.column("held_out"),
                "n_tokens": np.bincount(doc, minlength=rows) + 1,
                "n_known": np.bincount(doc, weights=c > 0, minlength=rows).astype(np.int64) + int(train_docs > 0),
                "train_tokens": np.full(rows, total),
                "base_score": np.bincount(doc, weights=np.log10((c + base) / scale), minlength=rows) + end,
                "score": np.bincount(own[ok], weights=p, minlength=rows),
                "n_bytes": n})

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        if docs.num_rows:
            got: dict[int, dict[int, dict[int, bytes]]] = {}    # by the first row of the run that asked
            for f, k, r, v in zip(*(answers.column(c).to_pylist() for c in ("first", "kind", "range", "vals"))):
                got.setdefault(f, {0: {}, 1: {}})[k][r] = v
            firsts = sorted(got)
            if len(firsts) == 1:
                out.extend(score(docs, got.pop(firsts[0])))
            else:
                run_of = np.searchsorted(firsts, docs.column("place").to_numpy(), side="right") - 1
                for i, f in enumerate(firsts):
                    out.extend(score(docs.filter(pa.array(run_of == i)), got.pop(f)))
        return pa.concat_tables(out) if out else pa.table({f.name: pa.array([], f.type) for f in OUT})

    return run


OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                 ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64())])
_OUT_DDL = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
            "score double, n_bytes long")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text, then its bytes.

    ``score`` is the context-tree model's log10 probability of the whole text and its end; ``-score / log10(2) / n_bytes``
    is the code length per byte. Learned from the documents that are not held out.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("held_out", crc_of_id() % 10 == 0)
    blocks = stored(rows.mapInArrow(_blocks, "block long, place long, bytes long, doc_id long, text string, held_out boolean"), "ctw-blocks")
    size, train_docs = blocks.agg(F.sum("bytes"), F.sum((~F.col("held_out")).cast("long"))).first()
    ranges = max(16, math.ceil((size or 0) / RANGE_BYTES))
    asked = stored(blocks.select("block", "place", "text", "held_out").mapInArrow(
        _requests(ranges), "kind int, range int, block long, first long, keys binary, n binary"), "ctw-requests")

    counted = stored(asked.where("kind = 0").groupBy("range").applyInArrow(
        _word_counts, "block long, first long, range int, vals binary, known long, total long"), "ctw-words")
    known, train_words = counted.agg(F.sum("known"), F.sum("total")).first()

    counts = materialize(asked.where("kind = 1").groupBy("range").applyInArrow(_gram_counts, "code long, n long"), "ctw-grams")
    tree = counts.withColumn("g", F.pmod(F.xxhash64(F.shiftright("code", 8 * (DEPTH - 1))), F.lit(ranges))).groupBy("g")
    top = (tree.applyInArrow(_top, "node long, n0 double, n1 double, w double")
           .groupBy("node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("w").alias("w")))
    predict = _predictions(roots(top.collect()))
    model = tree.applyInArrow(predict, "code long, p double")
    # the range of a gram is the one its requests went to
    wanted = asked.where("kind = 1").select("range", "block", "first", "keys")
    model = model.mapInArrow(_with_range(ranges), "range int, code long, p double")
    gram_answers = wanted.groupBy("range").cogroup(model.groupBy("range")).applyInArrow(
        _answers, "block long, first long, range int, vals binary")
    answers = (counted.where("block >= 0").select("block", "first", F.lit(0).alias("kind"), "range", "vals")
               .unionByName(gram_answers.select("block", "first", F.lit(1).alias("kind"), "range", "vals")))
    return (blocks.select("block", "place", "doc_id", "held_out", "text").groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(_scores(int(train_words or 0), int(train_docs or 0), int(known or 0), ranges), _OUT_DDL))


def _with_range(ranges: int):
    def run(batches):
        for b in batches:
            r = range_of(1, b.column("code").to_numpy().view(_U), ranges).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(r), *b.columns], ["range", *b.schema.names])

    return run
