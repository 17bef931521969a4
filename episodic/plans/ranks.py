"""Window and interval queries.

Stand-ins: ``orders`` per customer are activations/episodes, their
``lineitem`` rows are sessions. ``(l_orderkey, l_linenumber)`` is not unique,
so every ranking over lines carries the full tie-break ``LINE_ORDER``.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from episodic.operators.intervals import asof_join, containing_join, with_next
from episodic.operators.sinks import materialize
from episodic.operators.windows import first_rows, row_numbers, running_total, shifted
from episodic.plans.episodes import group_lvt, k1_sql
from episodic.plans.registry import register, ts

LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
LINE_ORDER_SQL = ", ".join(LINE_ORDER)
FAR_END = "9999-12-31 00:00:00"


def _lines_with_customer(t):
    o = t.orders.select(F.col("o_orderkey").alias("lo_orderkey"), F.col("o_custkey").alias("cust"))
    return t.lineitem.select("l_orderkey", "l_shipdate", "l_quantity") \
        .join(o, F.col("l_orderkey") == F.col("lo_orderkey")).drop("lo_orderkey")


@register("next_episode", "F1,D5", """
WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderdate,
         LEAD(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_orderdate
  FROM orders
), l AS (
  SELECT o.o_custkey AS cust, l.l_shipdate, l.l_quantity FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
)
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.next_orderdate, COUNT(l.l_shipdate) AS n_lines,
       COALESCE(SUM(l.l_quantity), 0) AS qty
FROM o LEFT JOIN l ON l.cust = o.o_custkey AND l.l_shipdate >= o.o_orderdate
     AND (o.next_orderdate IS NULL OR l.l_shipdate < o.next_orderdate)
GROUP BY o.o_orderkey, o.o_custkey, o.o_orderdate, o.next_orderdate
""")
def q_next_episode(spark, t):
    """Lines a customer shipped in [this order date, next order date); the last interval is open."""
    o = with_next(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey",
                  ["o_orderdate", "o_orderkey"], "o_orderdate", "next_orderdate",
                  chunk=F.date_trunc("year", "o_orderdate"))
    # stored: the fill and the list of its chunks read the lines, which are joined to their orders once
    lines = materialize(_lines_with_customer(t).drop("l_orderkey"), "next_episode_lines")
    # the last interval is open: no point lies beyond the far end
    iv = o.withColumn("_end", F.coalesce("next_orderdate", ts(FAR_END)))
    # half-open [start, next): the strict upper bound is checked in the ON clause
    half_open = F.col("next_orderdate").isNull() | (F.col("l_shipdate") < F.col("next_orderdate"))
    # a customer's orders tile its time line: each line belongs to the latest order dated at or before it
    per_order = asof_join(iv.select("o_orderkey", "o_custkey", "o_orderdate", "next_orderdate", "_end"),
                          lines, [("o_custkey", "cust")], "o_orderdate", "_end", "l_shipdate",
                          tie=["o_orderkey"], chunk_unit="year") \
        .filter(half_open).groupBy(F.col("o_orderkey").alias("_ok")) \
        .agg(F.count("l_shipdate").alias("n_lines"), F.sum("l_quantity").alias("qty"))
    res = iv.join(per_order, iv["o_orderkey"] == per_order["_ok"], "left") \
        .withColumn("n_lines", F.coalesce("n_lines", F.lit(0)))
    return res.select("o_orderkey", "o_custkey", "o_orderdate", "next_orderdate",
                      F.col("n_lines").cast("bigint").alias("n_lines"),
                      F.coalesce("qty", F.lit(0.0)).alias("qty"))


@register("first_after", "D9,D10", f"""
SELECT o_orderkey, o_orderdate, l_shipdate AS first_shipdate, l_linenumber AS first_linenumber,
       l_partkey AS first_partkey
FROM (
  SELECT o.o_orderkey, o.o_orderdate, l.*,
         ROW_NUMBER() OVER (PARTITION BY o.o_orderkey ORDER BY {LINE_ORDER_SQL}) AS rn
  FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_shipdate > o.o_orderdate
) x WHERE rn = 1
""")
def q_first_after(spark, t):
    """First line of each order shipped after the order date (left: orders without one keep nulls)."""
    o = t.orders.select("o_orderkey", "o_orderdate")
    cand = t.lineitem.join(o, (F.col("l_orderkey") == F.col("o_orderkey"))
                           & (F.col("l_shipdate") > F.col("o_orderdate")))
    first = cand.groupBy("o_orderkey").agg(F.min(F.struct(*LINE_ORDER)).alias("m"))
    return o.join(first, "o_orderkey", "left").select(
        "o_orderkey", "o_orderdate", F.col("m.l_shipdate").alias("first_shipdate"),
        F.col("m.l_linenumber").alias("first_linenumber"), F.col("m.l_partkey").alias("first_partkey"))


@register("lead_after_filter", "F2", """
SELECT o_orderkey, o_custkey, o_orderdate,
       LEAD(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_orderdate
FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-12-31 00:00:00'
""")
def q_lead_after_filter(spark, t):
    """The filter comes first: a next start outside the range is invisible to LEAD."""
    o = t.orders.filter(F.col("o_orderdate").between(ts("1996-01-01 00:00:00"), ts("1996-12-31 00:00:00"))) \
        .select("o_orderkey", "o_custkey", "o_orderdate")
    return with_next(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderdate", "next_orderdate",
                     chunk=F.date_trunc("month", "o_orderdate"))


def stage_label(rn, done):
    """Ordered CASE ladder (first match wins)."""
    return (F.when((rn == 1) & (done == 1), "1st-done")
            .when(rn == 1, "1st-open")
            .when((rn == 2) & (done == 2), "2nd-both-done")
            .when((rn == 2) & (done == 1), "2nd-one-done")
            .when(rn == 2, "2nd-none-done")
            .when((rn == 3) & (done == 3), "3rd-all-done")
            .when(rn == 3, "3rd")
            .when((rn == 4) & (done >= 3), "4th-mostly-done")
            .otherwise("4th"))


_STAGE_SQL = """CASE WHEN rn = 1 AND done_cnt = 1 THEN '1st-done' WHEN rn = 1 THEN '1st-open'
  WHEN rn = 2 AND done_cnt = 2 THEN '2nd-both-done' WHEN rn = 2 AND done_cnt = 1 THEN '2nd-one-done'
  WHEN rn = 2 THEN '2nd-none-done' WHEN rn = 3 AND done_cnt = 3 THEN '3rd-all-done' WHEN rn = 3 THEN '3rd'
  WHEN rn = 4 AND done_cnt >= 3 THEN '4th-mostly-done' ELSE '4th' END"""


@register("session_stage", "F4,F5,I1", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, rn, done_cnt, {_STAGE_SQL} AS stage
FROM (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS BIGINT) AS rn,
         CAST(SUM(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END)
              OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS BIGINT) AS done_cnt
  FROM lineitem) x
WHERE rn <= 4
""")
def q_session_stage(spark, t):
    """First four sessions per order, running count of finished ones, stage label.

    The running count only looks backwards, so it is computed after the
    top-4 cut (which Spark applies partially before the shuffle)."""
    first4 = first_rows(t.lineitem, ["l_orderkey"], LINE_ORDER, 4, rank_col="rn")
    w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    done = F.sum(F.when(F.col("l_returnflag") == "N", 1).otherwise(0)).over(w).cast("bigint")
    res = first4.withColumn("done_cnt", done)
    return res.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "rn", "done_cnt",
                      stage_label(F.col("rn"), F.col("done_cnt")).alias("stage"))


@register("tied_running_sum", "F6", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
       SUM(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate) AS qty_running,
       CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS BIGINT) AS rn
FROM lineitem
""")
def q_tied_running_sum(spark, t):
    """RANGE frame on a tied order: peers share the running sum; the rank gets a full tie-break."""
    # an order has a few lines by nature: plain windows; the sum is exact (decimal)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
                           "l_extendedprice")
    li = running_total(li, ["l_orderkey"], ["l_shipdate"], F.col("l_quantity").cast("decimal(18,2)"), "qty_running")
    li = row_numbers(li, ["l_orderkey"], LINE_ORDER, "rn").withColumn("qty_running", F.col("qty_running").cast("double"))
    return li.drop("l_extendedprice")


@register("consecutive_zero", "F3,K20,E6,D20,I19", """
WITH e AS (
  SELECT user_id, ts, event_type,
         LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_type
  FROM events
), hits AS (
  SELECT DISTINCT user_id FROM e
  WHERE event_type = 'error' AND prev_type = 'error' AND CAST(ts AS DATE) = DATE '2024-01-15'
)
SELECT h.user_id, c.c_name AS student_name, n.n_name AS student_nation
FROM hits h LEFT JOIN customer c ON c.c_custkey = h.user_id
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def q_consecutive_zero(spark, t):
    """Two zero-minute sessions in a row, the second one on the given day."""
    e = shifted(t.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"],
                "event_type", "prev_type", direction=-1, chunk=F.date_trunc("day", "ts"))
    day = F.lit("2024-01-15").cast("date")
    hits = e.filter((F.col("event_type") == "error") & (F.col("prev_type") == "error")
                    & (F.to_date("ts") == day)).select("user_id").distinct()
    c = t.customer.select(F.col("c_custkey"), F.col("c_name").alias("student_name"), "c_nationkey")
    n = t.nation.select(F.col("n_nationkey"), F.col("n_name").alias("student_nation"))
    return hits.join(c, hits["user_id"] == c["c_custkey"], "left") \
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left") \
        .select("user_id", "student_name", "student_nation")


@register("first_cohort_dense_rank", "F8,K23", """
SELECT o_orderkey, o_custkey, o_orderdate FROM (
  SELECT *, DENSE_RANK() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE)) AS dr FROM orders) x
WHERE dr = 1
""")
def q_first_cohort_dense_rank(spark, t):
    """All orders tied on a customer's first order day (dense_rank = 1)."""
    w = Window.partitionBy("o_custkey").orderBy(F.to_date("o_orderdate"))
    return t.orders.withColumn("dr", F.dense_rank().over(w)).filter(F.col("dr") == 1) \
        .select("o_orderkey", "o_custkey", "o_orderdate")


@register("first_n_per_key", "F11", """
SELECT user_id, event_id, ts, rn FROM (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS rn FROM events) x
WHERE rn <= 3
""")
def q_first_n_per_key(spark, t):
    """First three submissions per lecture by time."""
    return first_rows(t.events.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"], 3,
                      rank_col="rn")


@register("rank_as_cumcount", "F12,F14,I4", """
WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderdate,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS done_ts,
         CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) + INTERVAL 30 DAY END AS end_date
  FROM orders
)
SELECT o_orderkey, o_custkey, done_ts, CAST(end_date AS DATE) AS end_date,
       CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY done_ts ASC NULLS LAST, o_orderkey) AS BIGINT) AS cum_no,
       CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey
            ORDER BY CAST(o_orderdate AS DATE), COALESCE(CAST(end_date AS DATE), DATE '2100-01-01'), o_orderkey) AS BIGINT) AS episode_no,
       COALESCE(CAST(done_ts AS VARCHAR), 'open') AS done_label
FROM o
""")
def q_rank_as_cumcount(spark, t):
    """groupby.cumcount()+1 with nulls last, and the episode renumbering order."""
    o = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderdate",
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderdate")).alias("done_ts"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("date"))
        .otherwise(F.date_add(F.to_date("o_orderdate"), 30)).alias("end_date"))
    # rows without a date are one chunk of their year, cut further by their own order (the key)
    undated = F.when(F.col("done_ts").isNull(), F.floor(F.col("o_orderkey") / 65536))
    o = row_numbers(o, ["o_custkey"], [F.col("done_ts").asc_nulls_last(), F.col("o_orderkey")], "cum_no",
                    chunk=[F.date_trunc("year", "done_ts"), undated], chunk_nulls_last=True)
    o = row_numbers(o, ["o_custkey"], [F.to_date("o_orderdate"), F.coalesce(
        "end_date", F.lit("2100-01-01").cast("date")), F.col("o_orderkey")], "episode_no",
        chunk=F.date_trunc("year", "o_orderdate"))
    return o.select("o_orderkey", "o_custkey", "done_ts", "end_date", "cum_no", "episode_no",
                    F.coalesce(F.date_format("done_ts", "yyyy-MM-dd HH:mm:ss"), F.lit("open")).alias("done_label"))


@register("point_in_interval", "D11", (k1_sql() + """,
clicks AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click')
SELECT c.event_id, c.user_id, g.group_lecture_vt_no
FROM clicks c JOIN glvt g ON g.lecture_vt_no = c.user_id AND c.ts BETWEEN g.active_timestamp AND g.updated_at
""").replace("\nSELECT * FROM glvt,", ","))
def q_point_in_interval(spark, t):
    """Feedback (clicks) created between an episode's activation and its last update."""
    g = materialize(group_lvt(t.events).select("lecture_vt_no", "group_lecture_vt_no", "seq", "active_timestamp",
                                               "updated_at"), "point_in_interval")
    clicks = t.events.filter(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    m = containing_join(g, clicks, [("lecture_vt_no", "user_id")], "active_timestamp", "updated_at", "ts", tie=["seq"])
    return m.select("event_id", "user_id", "group_lecture_vt_no")
