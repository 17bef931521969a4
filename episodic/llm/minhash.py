"""Near-duplicate documents by BagMinHash signatures, banding and exact multiset overlap.

A document is the multiset of its five-word shingles (lower case; a text of
fewer words is one shingle). Signature: for every shingle and weight level a
Poisson process over time; the levels are the counts 1, 2, 3, ..., held as a
hierarchy of intervals (0,1], (1,2], (2,4], (4,8], ... of which only those
below the shingle's count are opened. Each point of a process carries a time,
a level inside its interval and one of ``REGISTERS`` registers; it counts if
its level is at most the shingle's count. A register keeps its earliest point,
so two signatures agree in a register with a probability that is exactly the
weighted Jaccard similarity. Points are drawn in rising time and a process
stops once it is later than every register's minimum, which leaves about one
draw per shingle of a long text.

Plan: equal texts collapse to their smallest id first; ``BANDS`` bands of
``ROWS`` registers give buckets; every member is compared with its bucket's
smallest id, and links (overlap >= ``threshold``, on the whole texts) give a
first set of components. Members of one bucket that are still in different
components are compared with each other in blocks of signatures, and the pairs
whose signatures could still reach the threshold are verified as well: no
bucket is capped, and near copies of one text never become all pairs.

Edge cases: a null text and a text without words are alone in their class;
repeated rows share a class; a null id takes no part in a link (its row is
returned with a null class); an empty table gives an empty result. An id is
taken to name one text: where several texts have it, the signature of the least
fingerprint proposes its links and the least text decides them. A text of any
length is held whole by the tasks that sign and compare it. No column but the id
and the text is read, so other names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from episodic.llm.common import components, mix64, released, slices, word_hashes
from episodic.operators.sinks import materialize

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 6
REGISTERS = BANDS * ROWS
SLACK = 0.16             # a signature estimate this far below the threshold (over 4 standard errors) rules a pair out
BLOCK = 512              # members of a bucket on each side of a comparison
BLOCK_BYTES = 8 << 20    # and their texts, about
BITS = 1 << 24           # of the map that thins out texts before they are shuffled: 2 MB at any size of input
_U = np.uint64


def shingles(text: str | None) -> np.ndarray:
    """64-bit hashes of the shingles of a text, in order, with repeats."""
    if not text:
        return np.empty(0, _U)
    w, _ = word_hashes(np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8))
    if not len(w):
        return w
    k = min(SHINGLE, len(w))
    n = len(w) - k + 1
    h = np.full(n, k, _U)
    with np.errstate(over="ignore"):
        for i in range(k):
            h = h * _U(0xD6E8FEB86659FD93) + w[i:n + i]
    return mix64(h)


def bags(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """All texts at once: document number, shingle, count; and a 128-bit fingerprint of each document's shingle sequence."""
    doc, key, count, prints = [], [], [], [b""] * len(texts)
    for i, t in enumerate(texts):
        s = shingles(t)
        if not len(s):
            continue
        at = mix64(s ^ (np.arange(len(s), dtype=_U) << _U(20)))
        prints[i] = np.array([at.sum(dtype=_U), mix64(at).sum(dtype=_U)]).tobytes()
        u, c = np.unique(s, return_counts=True)
        doc.append(np.full(len(u), i))
        key.append(u)
        count.append(c)
    if not doc:
        return np.empty(0, np.int64), np.empty(0, _U), np.empty(0, np.int64), prints
    return np.concatenate(doc), np.concatenate(key), np.concatenate(count), prints


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> _U(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(doc: np.ndarray, key: np.ndarray, count: np.ndarray, docs: int, m: int = REGISTERS) -> np.ndarray:
    """BagMinHash: for each document the ``m`` registers' winning points as 64-bit numbers (0: no shingle)."""
    best = np.full(docs * m, np.inf)
    won = np.zeros(docs * m, _U)
    latest = np.full(docs, np.inf)          # of each document's registers
    level, lo, width = 0, 0, 1
    while True:
        live = np.flatnonzero(count > lo)
        if not len(live):
            break
        # one process per (shingle, interval); its state is the hash of its last point
        d, w = doc[live], count[live]
        state = mix64(key[live] ^ mix64(np.array([level + 1], _U)))
        time = np.zeros(len(live))
        while len(d):
            state = mix64(state)
            time = time - np.log(_uniform(state)) / width
            go = time < latest[d]
            d, w, state, time = d[go], w[go], state[go], time[go]
            spot = mix64(state ^ _U(0xA5A5A5A5A5A5A5A5))
            reg = ((spot >> _U(32)) % _U(m)).astype(np.int64)
            inside = lo + 1 + ((spot & _U(0xFFFFFFFF)) % _U(width)).astype(np.int64) <= w if width > 1 else np.ones(len(d), bool)
            at, t, s = (d * m + reg)[inside], time[inside], spot[inside]
            np.minimum.at(best, at, t)
            first = best[at] == t
            won[at[first]] = s[first]
            if len(d):
                some = d[np.flatnonzero(np.diff(d, prepend=-1))]
                latest[some] = best.reshape(docs, m)[some].max(axis=1)
        level, lo, width = level + 1, lo + width, max(1, lo + width)
    return won.reshape(docs, m)


def _sign(batches):
    for batch in batches:
        for part in slices(batch, "text", 2 << 20, overhead=2048):
            texts = part.column("text").to_pylist()
            doc, key, count, prints = bags(texts)
            sig = signatures(doc, key, count, len(texts))
            some = np.zeros(len(texts), bool)
            some[doc] = True
            bands = np.zeros((len(texts), BANDS), _U)
            with np.errstate(over="ignore"):
                for r in range(ROWS):
                    bands = mix64(bands + sig[:, r::ROWS])
            bands ^= np.arange(BANDS, dtype=_U) * _U(0x9E3779B97F4A7C15)
            flat = pa.array(np.ascontiguousarray(bands).view(np.int64).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS), flat)
            short = (sig & _U(0xFF)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(prints, pa.binary()), pa.array(some), lists,
                 pa.array([x.tobytes() for x in short], pa.binary()),
                 pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())], ["id", "fp", "some", "bands", "sig", "size"])


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingles(text), return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two shingle multisets."""
    (u, n), (v, k) = a, b
    if not len(u) or not len(v):
        return 0.0
    _, i, j = np.intersect1d(u, v, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], k[j]).sum())
    return both / (int(n.sum()) + int(k.sum()) - both)


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose whole texts overlap by the threshold; texts(id, text) holds each id once."""
    j = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
         .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b"))

    def check(batches):
        for batch in batches:
            a, b, ta, tb = (batch.column(c).to_pylist() for c in ("a", "b", "ta", "tb"))
            first: dict[int, tuple] = {}             # a bucket's smallest member comes in many pairs
            ok = []
            for i, x, y in zip(a, ta, tb):
                if i not in first:
                    if len(first) >= 64:
                        first.clear()
                    first[i] = bag(x)
                ok.append(overlap(first[i], bag(y)) >= threshold)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, k in zip(a, ok) if k], pa.int64()),
                                              pa.array([x for x, k in zip(b, ok) if k], pa.int64())], ["a", "b"])

    return j.select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long")


def _pairs(sig: np.ndarray, comp: np.ndarray, side: np.ndarray, threshold: float) -> np.ndarray:
    """Which members (rows) may be linked with which (columns): in different components, on sides that meet, and with
    signatures that could reach the threshold. ``side``: 0 and 1 are compared with each other, 2 among themselves."""
    out = np.zeros((len(sig), len(sig)), bool)
    right = np.flatnonzero(side != 0)
    for i in np.flatnonzero(side != 1):
        est = (sig[right] == sig[i]).mean(axis=1)
        out[i, right] = (est >= threshold - SLACK) & (comp[right] != comp[i])
    return out


def _members(t: pa.Table) -> tuple[np.ndarray, ...]:
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(t.num_rows, REGISTERS)
    return sig, t.column("component").to_numpy(), t.column("side").to_numpy()


def _hopeful(threshold: float):
    def run(t: pa.Table) -> pa.Table:
        """The members of a group that may be linked with some other one; pairs never leave the task."""
        may = _pairs(*_members(t), threshold)
        return t.filter(pa.array(may.any(axis=0) | may.any(axis=1)))

    return run


def overlaps(texts: list[str]) -> np.ndarray:
    """Weighted Jaccard similarities of all pairs of a block of texts (the diagonal means nothing).

    A shingle that occurs n times becomes n signs of its own, so the overlap of multisets is that of sets: a product of
    0/1 matrices, summed over runs of columns, of which only those of two texts or more matter.
    """
    row, sign, size = [], [], np.zeros(len(texts))
    for i, text in enumerate(texts):
        u, n = bag(text)
        size[i] = n.sum()
        at = np.repeat(np.arange(len(u)), n)
        turn = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        sign.append(mix64(u[at] ^ mix64(turn.astype(_U))))
        row.append(np.full(len(at), i))
    rows = np.concatenate(row)
    _, inv, n = np.unique(np.concatenate(sign), return_inverse=True, return_counts=True)
    shared = n[inv] > 1
    rows, col = rows[shared], (np.cumsum(n > 1) - 1)[inv[shared]]
    order = np.argsort(col, kind="stable")
    rows, col = rows[order], col[order]
    both = np.zeros((len(texts), len(texts)))
    wide = 4096
    cuts = np.searchsorted(col, np.arange(0, (col[-1] if len(col) else -1) + wide + 1, wide))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        m = np.zeros((len(texts), wide), np.float32)
        m[rows[a:b], col[a:b] - k * wide] = 1
        both += m @ m.T
    union = size[:, None] + size[None, :] - both
    return np.divide(both, union, out=np.zeros_like(both), where=union > 0)


def _linked(threshold: float):
    def run(t: pa.Table) -> pa.Table:
        """Links of a group's members, as one (id, smallest id reached) each."""
        ids = t.column("id").to_numpy()
        a, b = np.nonzero((overlaps(t.column("text").to_pylist()) >= threshold) & _pairs(*_members(t), threshold))
        low = ids.copy()
        while True:
            was = low.copy()
            np.minimum.at(low, a, low[b])
            np.minimum.at(low, b, low[a])
            if (was == low).all():
                break
        some = np.flatnonzero(low != ids)
        return pa.table({"a": low[some], "b": ids[some]})

    return run


def _thinned(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose id may be in ``wanted(id)``: a test against a bit map of ``BITS`` bits, without a shuffle.

    The map has at most BITS / 32768 parts of 4 KB, so it may be broadcast at any size of input; where most bits are set
    it lets most rows pass, and the join that follows still decides.
    """
    h = F.pmod(F.xxhash64("id"), F.lit(BITS))
    bits = wanted.select(h.alias("h")).groupBy(F.floor(F.col("h") / 32768).alias("part")).agg(
        F.bitmap_construct_agg(F.expr("bitmap_bit_position(h)")).alias("bits"))
    p = F.expr("bitmap_bit_position(_h)")
    byte = F.conv(F.hex(F.expr("substring(bits, cast(bitmap_bit_position(_h) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    probed = rows.withColumn("_h", h).join(F.broadcast(bits), F.floor(F.col("_h") / 32768) == F.col("part"))
    return probed.where((F.call_function("shiftright", byte, (p % 8).cast("int")).bitwiseAND(1)) == 1).select(*rows.columns)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, class_id) of every row: class_id is the smallest id of its class of near duplicates."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = materialize(rows.mapInArrow(released(_sign), "id long, fp binary, some boolean, bands array<long>, sig binary, size long"), "bagminhash")
    heads = signed.where("some and id is not null").groupBy("fp").agg(F.min("id").alias("rep"))
    member = signed.select("id", "fp", "some").join(heads, "fp", "left").select(
        "id", F.when(F.col("some"), F.col("rep")).otherwise(F.col("id")).alias("rep"))
    # one row per distinct text; an id may come on several rows, and where their texts differ the least fingerprint stands for it
    distinct = (signed.where("some").join(heads.withColumnRenamed("rep", "id"), ["fp", "id"])
                .groupBy("id").agg(F.min(F.struct("fp", "bands", "sig", "size")).alias("s")).select("id", "s.bands", "s.sig", "s.size"))
    buckets = materialize(distinct.select("id", F.explode("bands").alias("bucket")), "bagminhash-buckets")
    stars = buckets.groupBy("bucket").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z")
    shared = buckets.join(stars.select("bucket", "a"), "bucket")
    pairs = materialize(shared.where("id <> a").select("a", F.col("id").alias("b")).distinct(), "bagminhash-stars")
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    texts = materialize(_thinned(rows, wanted).join(wanted, "id").groupBy("id").agg(F.min("text").alias("text")), "bagminhash-texts")
    links = materialize(_verified(pairs, texts, threshold), "bagminhash-links")
    comp = components(links, "bagminhash-first")

    # buckets that still hold several components: members outside that of the bucket's smallest id ("odd")
    # meet each other and the rest, block by block
    placed = shared.select("id", "bucket").join(comp, "id", "left").select(
        "id", "bucket", F.coalesce("component", "id").alias("component"))
    mains = (placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                          F.min_by("component", "id").alias("main")).where("lo < hi").select("bucket", "main"))
    todo = placed.join(mains, "bucket").withColumn("odd", F.col("component") != F.col("main"))
    todo = materialize(todo.join(distinct.select("id", "size"), "id"), "bagminhash-open")
    def blocks(side):
        """A side is cut by members and by bytes: a task holds the whole texts of one block of each side."""
        share = F.greatest(F.sum(side.cast("int")) / BLOCK, F.sum(F.when(side, F.col("size"))) / BLOCK_BYTES)
        return F.ceil(share).cast("int")

    sizes = todo.groupBy("bucket").agg(blocks(F.col("odd")).alias("odd_blocks"), blocks(~F.col("odd")).alias("main_blocks"))
    todo = todo.join(sizes, "bucket").withColumn("block", F.pmod(
        F.xxhash64("id"), F.when(F.col("odd"), F.col("odd_blocks")).otherwise(F.col("main_blocks"))).cast("int"))
    odd = todo.where("odd")
    own = odd.withColumn("other", F.explode(F.expr("sequence(0, odd_blocks - 1)"))).select(
        "bucket", "id", "component", F.lit(False).alias("rest"), F.least("block", "other").alias("x"),
        F.greatest("block", "other").alias("y"),
        F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"))
    rest = odd.withColumn("y", F.explode(F.expr("sequence(0, main_blocks - 1)"))).select(
        "bucket", "id", "component", F.lit(True).alias("rest"), F.col("block").alias("x"), "y", F.lit(0).alias("side"))
    main = todo.where("not odd").withColumn("x", F.explode(F.expr("sequence(0, odd_blocks - 1)"))).select(
        "bucket", "id", "component", F.lit(True).alias("rest"), "x", F.col("block").alias("y"), F.lit(1).alias("side"))
    todo = own.unionByName(rest).unionByName(main)
    sigs = distinct.select("id", "sig")
    group = ["bucket", "rest", "x", "y"]
    columns = [*group, "id", "component", "side", "sig"]
    met = todo.join(sigs, "id").select(*columns)
    hopeful = materialize(met.groupBy(*group).applyInArrow(_hopeful(threshold), met.schema), "bagminhash-rest")
    links2 = hopeful.join(texts, "id").groupBy(*group).applyInArrow(_linked(threshold), "a long, b long")
    comp = components(links.unionByName(materialize(links2, "bagminhash-links2")), "bagminhash-last")
    return (member.join(comp.withColumnRenamed("id", "rep"), "rep", "left")
            .select("id", F.coalesce("component", "rep").alias("class_id")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, kept of every document (kept: it is the smallest id of its class)."""
    return classes(docs).select(F.col("id").alias("doc_id"), "class_id", (F.col("id") == F.col("class_id")).alias("kept"))


def one_per_class(docs: DataFrame) -> DataFrame:
    """Pipeline stage: one document of each class stays, the one of the smallest id; columns unchanged.

    Rows of one id and one text stay once: of rows that differ in other columns the least by these (in the table's order,
    nulls first). Rows without an id cannot be told apart and stay. Any further column is allowed, whatever its name.
    """
    dropped = classes(docs).where("id <> class_id").select("id").distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(F.col("doc_id").alias("id"), whole)
    left = rows.where("id is not null").join(dropped, "id", "left_anti")
    # maps have no order
    others = [F.to_json(F.struct(c.alias("m"))) if isinstance(t, MapType) else c for c, t in (
        (F.col(f"row.`{f.name}`"), f.dataType) for f in docs.schema.fields if f.name not in ("doc_id", "text"))]
    first = F.row_number().over(Window.partitionBy("id", "row.text").orderBy(*others, F.lit(0)))
    left = left.withColumn("first", first).where("first = 1").drop("first")
    return left.unionByName(rows.where("id is null")).select("row.*")
