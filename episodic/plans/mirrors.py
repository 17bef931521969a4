"""Mirror refresh and incremental DML.

Stand-in: ``orders`` as the mirrored source table (key ``o_orderkey``,
watermark ``o_orderdate``); an earlier run's target is the part before a cut.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from episodic.operators.incremental import (high_water_mark, insert_absent, latest_per_key, refresh_mirror,
                                            scan_since, state_changes, upsert)
from episodic.operators.sinks import materialize
from episodic.operators.windows import row_numbers
from episodic.plans.registry import AS_OF_EVENTS, AS_OF_ORDERS, money, register, ts
from episodic.sources.tables import TableSpec

CUT_ORDERS = "1998-01-01 00:00:00"
CUT_EVENTS = "2024-01-20 00:00:00"
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("latest_per_key", "G1,C13,E8", """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
  FROM events) x
WHERE rn = 1
""")
def q_latest_per_key(spark, t):
    """Newest event per (user, type); ties broken by the larger id."""
    ev = t.events.select("user_id", "event_type", "event_id", "ts", "value")
    return latest_per_key(ev, ["user_id", "event_type"],
                          [F.col("ts").desc_nulls_last(), F.col("event_id").desc()])


@register("high_water_scan", "A4,E10", f"""
SELECT * FROM orders
WHERE o_orderdate > (SELECT MAX(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '{CUT_ORDERS}')
""")
def q_high_water_scan(spark, t):
    """Rows of the source newer than the stored target's maximum (strict '>')."""
    target = t.orders.filter(F.col("o_orderdate") < ts(CUT_ORDERS))
    hwm = high_water_mark(target, "o_orderdate", default="2019-01-01 00:00:00")
    return scan_since(t.orders, "o_orderdate", hwm)


@register("range_scan", "A7", """
SELECT * FROM orders
WHERE o_orderkey BETWEEN 1000 AND 500000
  AND o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-12-31 00:00:00'
""")
def q_range_scan(spark, t):
    """Static id and date ranges; a date 'between' ends at midnight of the last day."""
    return t.orders.filter(F.col("o_orderkey").between(1000, 500000)
                           & F.col("o_orderdate").between(ts("1996-01-01 00:00:00"), ts("1996-12-31 00:00:00")))


@register("rolling_scan", "A8", """
SELECT * FROM orders
WHERE o_orderdate >= CAST(CAST(TIMESTAMP '1998-09-01 00:00:00' AS DATE) - INTERVAL 1 DAY AS TIMESTAMP)
""")
def q_rolling_scan(spark, t):
    """Everything since yesterday 00:00 relative to ``as_of``."""
    since = F.date_sub(ts(AS_OF_ORDERS).cast("date"), 1).cast("timestamp_ntz")
    return t.orders.filter(F.col("o_orderdate") >= since)


@register("mirror_refresh", "K26: A1,A2,A5,A9,A13,E10,H6,C1,G1", f"""
WITH old AS (SELECT *, 0 AS batch FROM orders WHERE o_orderdate < TIMESTAMP '{CUT_ORDERS}'),
delta AS (SELECT *, 1 AS batch FROM orders WHERE o_orderdate >= (SELECT MAX(o_orderdate) FROM old)),
u AS (SELECT * FROM old UNION ALL SELECT * FROM delta)
SELECT * EXCLUDE (batch, rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC NULLS LAST, batch DESC) AS rn
  FROM u) x
WHERE rn = 1
""")
def q_mirror_refresh(spark, t):
    """Stored mirror + inclusive delta since its watermark, newest row per key."""
    old = t.orders.filter(F.col("o_orderdate") < ts(CUT_ORDERS))
    hwm = high_water_mark(old, "o_orderdate", default="2019-01-01 00:00:00")
    delta = scan_since(t.orders, "o_orderdate", hwm, inclusive=True)
    both = old.withColumn("batch", F.lit(0)).unionByName(delta.withColumn("batch", F.lit(1)))
    return latest_per_key(both, ["o_orderkey"],
                          [F.col("o_orderdate").desc_nulls_last(), F.col("batch").desc()]).drop("batch")


@register("state_changes", "G4,E8,K25", f"""
WITH stored AS (
  SELECT user_id, event_type AS tutoring_state FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events WHERE ts < TIMESTAMP '{CUT_EVENTS}') x WHERE rn = 1
), cur AS (
  SELECT user_id, event_type AS tutoring_state FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events) x WHERE rn = 1
)
SELECT c.user_id, c.tutoring_state, TIMESTAMP '2024-01-31 00:00:00' AS created_at
FROM cur c LEFT JOIN stored s ON s.user_id = c.user_id
WHERE s.user_id IS NULL OR c.tutoring_state IS DISTINCT FROM s.tutoring_state
""")
def q_state_changes(spark, t):
    """Append-on-change history: emit the current state where it differs from the stored latest."""
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    ev = t.events.select("user_id", "ts", "event_id", F.col("event_type").alias("tutoring_state"))
    stored = latest_per_key(ev.filter(F.col("ts") < ts(CUT_EVENTS)), ["user_id"], order)
    cur = latest_per_key(ev, ["user_id"], order)
    return state_changes(stored.select("user_id", "tutoring_state"),
                         cur.select("user_id", "tutoring_state"), "user_id", "tutoring_state") \
        .withColumn("created_at", ts(AS_OF_EVENTS))


@register("insert_absent", "B10,B16,D16", f"""
SELECT *, 'target' AS origin FROM orders WHERE o_orderdate < TIMESTAMP '{CUT_ORDERS}'
UNION ALL
SELECT s.*, 'source' AS origin FROM orders s
WHERE s.o_orderdate >= TIMESTAMP '1997-07-01 00:00:00'
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = s.o_orderkey
                  AND o.o_orderdate < TIMESTAMP '{CUT_ORDERS}')
""")
def q_insert_absent(spark, t):
    """ON CONFLICT DO NOTHING: source rows whose key the target already has are skipped."""
    target = t.orders.filter(F.col("o_orderdate") < ts(CUT_ORDERS)).withColumn("origin", F.lit("target"))
    source = t.orders.filter(F.col("o_orderdate") >= ts("1997-07-01 00:00:00")) \
        .withColumn("origin", F.lit("source"))
    return insert_absent(target, source, ["o_orderkey"])


@register("upsert_totals", "B8,B17,E1", f"""
WITH old AS (
  SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
         COUNT(*) AS n_orders, MAX(o_orderdate) AS last_order
  FROM orders WHERE o_orderdate < TIMESTAMP '{CUT_ORDERS}' GROUP BY o_custkey
), changed AS (
  SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
         COUNT(*) AS n_orders, MAX(o_orderdate) AS last_order
  FROM orders GROUP BY o_custkey
  HAVING MAX(o_orderdate) >= (SELECT MAX(last_order) FROM old)
)
SELECT * FROM old WHERE o_custkey NOT IN (SELECT o_custkey FROM changed)
UNION ALL SELECT * FROM changed
""")
def q_upsert_totals(spark, t):
    """Merge on key: totals of customers updated since the target's max replace the old rows."""
    def totals(df):
        return df.groupBy("o_custkey").agg(money("o_totalprice").alias("total_price"),
                                           F.count(F.lit(1)).alias("n_orders"),
                                           F.max("o_orderdate").alias("last_order"))
    old = totals(t.orders.filter(F.col("o_orderdate") < ts(CUT_ORDERS)))
    hwm = high_water_mark(old, "last_order")
    changed = totals(t.orders).filter(F.col("last_order") >= F.lit(hwm).cast("timestamp_ntz"))
    return upsert(old, changed, ["o_custkey"])


@register("list_maintenance", "K5,G3,I17,F12", """
WITH old AS (
  SELECT ' ' || CAST(o_orderkey AS VARCHAR) || ' ' AS room_id, o_custkey,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts_text, 0 AS batch
  FROM orders WHERE o_orderdate <= TIMESTAMP '1998-06-30 00:00:00'
), new AS (
  SELECT CAST(o_orderkey AS VARCHAR), o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), 1
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
), u AS (
  SELECT trim(room_id) AS room_id, o_custkey, TRY_CAST(ts_text AS TIMESTAMP) AS tutoring_datetime, batch
  FROM (SELECT * FROM old UNION ALL SELECT * FROM new) x
), last AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY room_id ORDER BY batch DESC) AS rn FROM u) y WHERE rn = 1
)
SELECT room_id, o_custkey, tutoring_datetime,
       ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY tutoring_datetime ASC NULLS LAST, room_id) AS session_no
FROM last
""")
def q_list_maintenance(spark, t):
    """Stored list + new rows, keep the last row per room (new wins), renumber sessions per lecture."""
    fmt = "yyyy-MM-dd HH:mm:ss"
    old = t.orders.filter(F.col("o_orderdate") <= ts("1998-06-30 00:00:00")).select(
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit(" ")).alias("room_id"),
        "o_custkey", F.date_format("o_orderdate", fmt).alias("ts_text"), F.lit(0).alias("batch"))
    new = t.orders.filter(F.col("o_orderdate") >= ts("1998-01-01 00:00:00")).select(
        F.col("o_orderkey").cast("string").alias("room_id"), "o_custkey",
        F.date_format("o_orderdate", fmt).alias("ts_text"), F.lit(1).alias("batch"))
    u = old.unionByName(new).select(
        F.trim("room_id").alias("room_id"), "o_custkey",
        F.try_to_timestamp("ts_text", F.lit(fmt)).cast("timestamp_ntz").alias("tutoring_datetime"), "batch")
    last = latest_per_key(u, ["room_id"], [F.col("batch").desc()], null_keys="keep")
    last = row_numbers(last, ["o_custkey"], [F.col("tutoring_datetime").asc_nulls_last(), F.col("room_id")],
                       "session_no", chunk_nulls_last=True,
                       # unparsable dates are one chunk, cut further by the beginning of the room id
                       chunk=[F.date_trunc("year", "tutoring_datetime"),
                              F.when(F.col("tutoring_datetime").isNull(), F.substring("room_id", 1, 3))])
    return last.select("room_id", "o_custkey", "tutoring_datetime", "session_no")


@register("tagged_append", "B2,B3,B18,H6", """
SELECT o_orderkey, o_custkey, o_orderdate, 'list_a' AS source, CAST(NULL AS VARCHAR) AS o_orderpriority
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderdate, 'list_b' AS source, o_orderpriority
FROM orders WHERE o_orderstatus = 'O'
""")
def q_tagged_append(spark, t):
    """Two list snapshots appended with a source tag; the second adds a column (append_new_columns)."""
    a = t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_orderdate") \
        .withColumn("source", F.lit("list_a"))
    b = t.orders.filter(F.col("o_orderstatus") == "O") \
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority").withColumn("source", F.lit("list_b"))
    return a.unionByName(b, allowMissingColumns=True)


@register("keep_created_at", "I32", """
WITH old AS (
  SELECT c_custkey, TIMESTAMP '2024-01-01 00:00:00' AS created_at FROM customer WHERE c_acctbal < 5000
)
SELECT n.c_custkey, n.c_name, COALESCE(o.created_at, TIMESTAMP '2024-01-31 00:00:00') AS created_at,
       TIMESTAMP '2024-01-31 00:00:00' AS updated_at
FROM customer n LEFT JOIN old o ON o.c_custkey = n.c_custkey
""")
def q_keep_created_at(spark, t):
    """Rows already in the target keep their created_at; new ones get the run time."""
    old = t.customer.filter(F.col("c_acctbal") < 5000) \
        .select("c_custkey", ts("2024-01-01 00:00:00").alias("created_at"))
    new = t.customer.select("c_custkey", "c_name")
    return new.join(old, "c_custkey", "left").select(
        "c_custkey", "c_name", F.coalesce("created_at", ts(AS_OF_EVENTS)).alias("created_at"),
        ts(AS_OF_EVENTS).alias("updated_at"))


@register("mirror_first_run", "A9,A4,K26,G1", """
SELECT * FROM events
""")
def q_mirror_first_run(spark, t):
    """First run of a mirror: the target does not exist yet, so it reads as an empty frame of the
    contract schema, the watermark falls back to its default and the whole source is copied."""
    from episodic.session import scratch_path
    from episodic.sources.files import read_or_empty
    src = t.events
    target = read_or_empty(spark, scratch_path(spark, "events_mirror"), src.schema)
    hwm = high_water_mark(target, "ts", default="1900-01-01 00:00:00")
    delta = scan_since(src, "ts", hwm)
    both = target.withColumn("batch", F.lit(0)).unionByName(delta.withColumn("batch", F.lit(1)))
    return latest_per_key(both, ["event_id"], [F.col("ts").desc_nulls_last(), F.col("batch").desc()]).drop("batch")


_MIRROR_CUT = {"orders": "1997-01-01 00:00:00", "events": "2024-01-15 00:00:00"}
_MIRROR_SPECS = {
    "orders": TableSpec("orders", ("o_orderkey",), watermark="o_orderdate", inclusive=True, deny=("o_totalprice",)),
    "events": TableSpec("events", ("event_id",), watermark="ts", columns=("event_id", "ts", "user_id", "event_type", "value")),
    "customer": TableSpec("customer", ("c_custkey",), deny=("c_name",)),
}


def _spec_mirror(name):
    spec = _MIRROR_SPECS[name]

    def run(spark, t):
        source = getattr(t, name)
        kept = [c for c in (spec.columns or source.columns) if c not in spec.deny]
        old = source.select(*kept)
        if spec.watermark:
            old = old.filter(F.col(spec.watermark) < ts(_MIRROR_CUT[name]))
        # two scheduled runs: the first finds no target, the second the stored one
        empty = spark.createDataFrame([], old.schema)
        stored = materialize(refresh_mirror(old, empty, spec), f"mirror_{name}")
        return refresh_mirror(source, stored, spec)
    return run


for _name, _cols in (("orders", "* EXCLUDE (o_totalprice)"), ("events", "event_id, ts, user_id, event_type, value"),
                     ("customer", "* EXCLUDE (c_name)")):
    register(f"mirror_{_name}", "K26: A3,A4,A5,G1,B1 by TableSpec", f"SELECT {_cols} FROM {_name}")(_spec_mirror(_name))
