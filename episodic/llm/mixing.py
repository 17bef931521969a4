"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

* Targets: the sources in code-point order (null last) weigh 5, 2, 1 in turn and
  share ``share`` of all words. A target stops at ``cap`` times its source's
  words and the excess is shared again by weight: the fixed point is
  ``min(cap * size, level * weight)``, found in one pass over the sources sorted
  by ``cap * size / weight`` (one row per source).
* Selection: each document draws the exponential key ``-ln(u) / quality`` with
  ``u`` from a hash of its id, so reruns agree. Complete epochs of a source come
  first (every document that many times); the rest of the target takes documents
  by rising key until their words reach it, the last one only if that comes
  nearer to the target.
* The running sum over a source, which may hold a third of all rows, is split:
  keys fall into ``CHUNKS`` fixed ranges per source, whose word sums are added up
  in a small table; only the range in which the target ends is sorted. The result
  is one cut key per source, so the documents themselves are never shuffled.

Edge cases: a null text has size 0; a null source is a source of its own, last;
documents of size 0 are taken with no words; repeated rows share a key and are
taken in turn (where the target ends among them, as many of them as come nearest to
it, numbered by chunks); an empty table gives an empty result. No document exceeds ``cap``
times its size, since no target exceeds ``cap`` times its source's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episodic.llm.common import WORD
from episodic.operators.sinks import materialize
from episodic.operators.windows import row_numbers

WEIGHTS = (5, 2, 1)
CHUNKS = 4096
TURNS = 4096             # repeated rows numbered in one go


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column, size: Column) -> Column:
    """Quality weight of a document: 1 for a plausible mean word length (3 to 12 characters), else 1/4."""
    mean = F.length(text) / F.greatest(size, F.lit(1))
    return F.when(mean.between(3, 12), F.lit(1.0)).otherwise(F.lit(0.25))


def exponential_key(weight: Column, *identity: str) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(F.lit("mix"), *identity), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(u) / weight


def source_targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """``sizes(source, source_size)`` with the double ``target`` of each source (one row per source)."""
    every = Window.partitionBy()
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    s = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1))
    s = s.withColumn("limit", cap * F.col("source_size"))
    # sources full at the final level are a prefix in this order
    order = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("budget", share * F.sum("source_size").over(every))
         .withColumn("level", (F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
                     / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))))
    # the first source whose limit is not reached at its level fixes the level of all that follow
    final = F.min(F.when(F.col("limit") >= F.col("level") * F.col("w"), F.struct(F.col("limit") / F.col("w"), "level"))
                  ).over(every)["level"]
    return (s.withColumn("final", final)
            .select("source", "source_size",
                    F.when(F.col("final").isNull(), F.col("limit"))
                    .otherwise(F.least("limit", F.col("final") * F.col("w"))).alias("target")))


def drawn(docs: DataFrame, prefix: str) -> DataFrame:
    """``docs`` with each document's size, exponential key, tie breaker and key range (columns named with ``prefix``)."""
    d = docs.withColumn(f"{prefix}size", word_count(F.col("text")))
    d = d.withColumn(f"{prefix}key", exponential_key(quality(F.col("text"), F.col(f"{prefix}size")), "doc_id"))
    return (d.withColumn(f"{prefix}tie", F.xxhash64("doc_id", "text", "source"))
            .withColumn(f"{prefix}chunk", F.floor((1 - F.exp(-F.col(f"{prefix}key"))) * CHUNKS).cast("int")))


def plan(docs: DataFrame, share: float = 1.5, cap: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(light rows with size and key, cut per source).

    light: doc_id, source, size, key, tie, chunk. cuts: source, source_size, target, epochs, c, cut_key, cut_tie, cut_take,
    cut_rows: a document is taken ``epochs`` times, and once more if (key, tie) lies before the cut or it is among the
    first ``cut_take`` of the ``cut_rows`` rows at the cut.
    """
    light = drawn(docs.select("doc_id", "source", "text"), "").drop("text")
    light = materialize(light, "mix-light")
    sums = light.groupBy("source", "chunk").agg(F.sum("size").alias("words"))
    sums = materialize(sums, "mix-chunks")
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), share, cap)
    targets = targets.withColumn("epochs", F.when(F.col("source_size") > 0,
                                                  F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int"))
    targets = targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    targets = materialize(targets, "mix-targets")
    run = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    ends = (sums.withColumn("upto", F.sum("words").over(run))
            .join(targets.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
            .where((F.col("upto") >= F.col("rest")) & (F.col("rest") > 0))
            .groupBy("source", "rest").agg(F.min(F.struct("chunk", F.col("upto") - F.col("words"))).alias("e"))
            .select(F.col("source").alias("s"), "rest", F.col("e.chunk").alias("c"), F.col("e.col2").alias("before")))
    edge = light.join(ends, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
    edge = edge.groupBy("source", "key", "tie", "size", "before", "rest").agg(F.count("*").alias("rows"))
    by_key = Window.partitionBy("source").orderBy("key", "tie", "size").rowsBetween(Window.unboundedPreceding, 0)
    words = F.col("size") * F.col("rows")
    edge = edge.withColumn("left", F.col("rest") - (F.col("before") + F.sum(words).over(by_key) - words))
    # the document at the edge is taken if that leaves the sum nearer to the target: the n-th of a group if n - 1/2 of them fit
    edge = edge.withColumn("take", F.when(F.col("size") > 0, F.least("rows", F.floor(F.col("left") / F.col("size") + 0.5)))
                           .when(F.col("left") >= 0, F.col("rows")).otherwise(F.lit(0))).where("take > 0")
    cut = (edge.groupBy("source").agg(F.max(F.struct("key", "tie", "size", "take", "rows")).alias("m"))
           .select(F.col("source").alias("s"), F.col("m.key").alias("cut_key"), F.col("m.tie").alias("cut_tie"),
                   F.col("m.take").alias("cut_take"), F.col("m.rows").alias("cut_rows")))
    ends = ends.select("s", "c")
    cuts = (targets.select("source", "source_size", "target", "epochs")
            .join(ends, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
            .join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"))
    return light, materialize(cuts, "mix-cuts")


def copies(prefix: str) -> Column:
    """How often a drawn document joined to its source's cut is taken: the epochs, and once more before the cut or in turn at it."""
    key, tie, chunk = (F.col(f"{prefix}{c}") for c in ("key", "tie", "chunk"))
    edge, cut_key, cut_tie, epochs = (F.col(f"__cut_{c}") for c in ("c", "cut_key", "cut_tie", "epochs"))
    within = cut_key.isNotNull() & ((key < cut_key) | ((key == cut_key) & (tie <= cut_tie)))
    within = within & (F.col("__cut_turn") <= F.col("__cut_cut_take"))
    part = F.when(edge.isNull(), 0).when((chunk < edge) | ((chunk == edge) & within), 1).otherwise(0)
    return epochs + part


def _with_cuts(rows: DataFrame, cuts: DataFrame, prefix: str) -> DataFrame:
    """Drawn ``rows`` with their source's cut and their turn: 0, or the number of a row of which only some repetitions are taken."""
    some = cuts.where("cut_take < cut_rows").isEmpty()
    cuts = cuts.select(*[F.col(c).alias(f"__cut_{c}") for c in cuts.columns])
    rows = rows.join(cuts, rows["source"].eqNullSafe(cuts["__cut_source"])).withColumn("__cut_turn", F.lit(0).cast("long"))
    if some:
        return rows
    at_cut = F.coalesce((F.col(f"{prefix}key") == F.col("__cut_cut_key")) & (F.col(f"{prefix}tie") == F.col("__cut_cut_tie"))
                        & (F.col("__cut_cut_take") < F.col("__cut_cut_rows")), F.lit(False))
    group = materialize(rows.where(at_cut).withColumn("__cut_row", F.monotonically_increasing_id()), "mix-edge")
    turns = row_numbers(group.select(F.col("__cut_source").alias("s"), F.col("__cut_row").alias("r")), ["s"], ["r"], "turn",
                        chunk=F.floor(F.col("r") / TURNS))
    turns = turns.select(F.col("r").alias("__cut_r"), F.col("turn").alias("__cut_n"))
    group = group.join(turns, F.col("__cut_row") == F.col("__cut_r")).withColumn("__cut_turn", F.col("__cut_n"))
    return rows.where(~at_cut).unionByName(group.select(*rows.columns))


def mix_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document, then its source and the copies taken."""
    light, cuts = plan(docs)
    return (_with_cuts(light, cuts, "")
            .select("doc_id", "size", F.col("__cut_source_size").alias("source_size"), F.col("__cut_target").alias("target"),
                    (F.col("size") * copies("")).cast("long").alias("taken"), "source", copies("").cast("int").alias("copies")))


def mixed(docs: DataFrame) -> DataFrame:
    """Pipeline stage: every document as many times as the mix takes it, columns unchanged."""
    _, cuts = plan(docs)
    # the caller's row travels as one column, so that none of its names meets one of those used here
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    drawn_rows = drawn(docs.select(whole, "doc_id", "source", "text"), "").drop("text")
    rows = _with_cuts(drawn_rows, cuts, "").withColumn("n", copies("")).where("n > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")
