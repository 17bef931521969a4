"""Relational building blocks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from episodic.functions.keys import normalise_key
from episodic.operators.quality import quality_report
from episodic.operators.windows import first_rows
from episodic.plans.ranks import LINE_ORDER, LINE_ORDER_SQL
from episodic.plans.registry import AS_OF_EVENTS, AS_OF_ORDERS, money, register, ts
from episodic.sources.tables import TABLES


@register("predicates", "C3-C7,C10,C12", """
SELECT o.o_orderkey,
       o.o_orderpriority IN ('1-URGENT', '2-HIGH') AS in_list,
       o.o_orderstatus NOT IN ('F', 'P') AS not_in_list,
       c.c_name LIKE '%_1' AS like_flag,
       c.c_name NOT LIKE 'Customer#00000000%' AS not_like_flag,
       o.o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-12-31 00:00:00' AS between_flag,
       (CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE o.o_totalprice END) IS NOT NULL AS has_price,
       (CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE o.o_orderpriority END) IS DISTINCT FROM '5-LOW' AS distinct_flag,
       CAST(o.o_orderdate AS DATE) = DATE '1998-08-31' AS yesterday_flag,
       date_sub('day', o.o_orderdate, TIMESTAMP '1998-09-01 00:00:00') >= 3 AS aged_flag
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
""")
def q_predicates(spark, t):
    """Every predicate form of the reference evaluated on each order (as flags, so nothing is dropped)."""
    o, c = t.orders, t.customer.select("c_custkey", "c_name")
    maybe_price = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_totalprice"))
    maybe_prio = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderpriority"))
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        "o_orderkey",
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("in_list"),
        (~F.col("o_orderstatus").isin("F", "P")).alias("not_in_list"),
        F.col("c_name").like("%_1").alias("like_flag"),
        (~F.col("c_name").like("Customer#00000000%")).alias("not_like_flag"),
        F.col("o_orderdate").between(ts("1996-01-01 00:00:00"), ts("1996-12-31 00:00:00")).alias("between_flag"),
        maybe_price.isNotNull().alias("has_price"),
        (~maybe_prio.eqNullSafe(F.lit("5-LOW"))).alias("distinct_flag"),
        (F.to_date("o_orderdate") == F.date_sub(ts(AS_OF_ORDERS).cast("date"), 1)).alias("yesterday_flag"),
        (F.expr("timestampdiff(DAY, o_orderdate, TIMESTAMP_NTZ '1998-09-01 00:00:00')") >= 3).alias("aged_flag"))


@register("join_suite", "D1-D4,D14,D16,D20", """
SELECT o.o_orderkey, c.c_name, cn.n_name AS cust_nation, pn.n_name AS partner_nation, r.r_name AS region
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation cn ON cn.n_nationkey = c.c_nationkey
LEFT JOIN nation pn ON pn.n_nationkey = (c.c_nationkey + 1) % 25 AND pn.n_regionkey = cn.n_regionkey
LEFT JOIN region r ON r.r_regionkey = cn.n_regionkey
WHERE r.r_name <> 'ASIA'
  AND o.o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
  AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')
""")
def q_join_suite(spark, t):
    """Inner, composite-key left, null-rejected left (written inner), semi (IN) and anti (NOT EXISTS) joins,
    with the nation dimension in two roles."""
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    cn = t.nation.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cust_nation"),
                         F.col("n_regionkey").alias("cn_region"))
    pn = t.nation.select(F.col("n_nationkey").alias("pn_key"), F.col("n_name").alias("partner_nation"),
                         F.col("n_regionkey").alias("pn_region"))
    r = t.region.filter(F.col("r_name") != "ASIA").select("r_regionkey", F.col("r_name").alias("region"))
    seg = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(F.col("c_custkey").alias("sk"))
    returned = t.lineitem.filter(F.col("l_returnflag") == "R").select("l_orderkey")
    base = o.join(seg, o["o_custkey"] == seg["sk"], "left_semi") \
        .join(returned, o["o_orderkey"] == returned["l_orderkey"], "left_anti")
    j = base.join(c, base["o_custkey"] == c["c_custkey"]) \
        .join(cn, F.col("c_nationkey") == F.col("cn_key")) \
        .join(pn, (F.col("pn_key") == (F.col("c_nationkey") + 1) % 25) & (F.col("pn_region") == F.col("cn_region")),
              "left") \
        .join(r, F.col("cn_region") == F.col("r_regionkey"), "inner")
    return j.select("o_orderkey", "c_name", "cust_nation", "partner_nation", "region")


@register("residual_joins", "D12,D13", f"""
WITH after AS (
  SELECT * FROM (SELECT o.o_orderkey, l.l_shipdate,
                        ROW_NUMBER() OVER (PARTITION BY o.o_orderkey ORDER BY {LINE_ORDER_SQL}) AS rn
                 FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_shipdate > o.o_orderdate) x
  WHERE rn = 1
), before AS (
  SELECT * FROM (SELECT o.o_orderkey, l.l_shipdate,
                        ROW_NUMBER() OVER (PARTITION BY o.o_orderkey ORDER BY {LINE_ORDER_SQL}) AS rn
                 FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_shipdate <= o.o_orderdate) y
  WHERE rn = 1
)
SELECT o.o_orderkey, COALESCE(a.l_shipdate, b.l_shipdate) AS match_ship,
       CASE WHEN a.l_shipdate IS NOT NULL THEN 'after' WHEN b.l_shipdate IS NOT NULL THEN 'before' ELSE 'none' END AS match_source
FROM orders o
LEFT JOIN after a ON a.o_orderkey = o.o_orderkey
LEFT JOIN before b ON b.o_orderkey = o.o_orderkey AND a.l_shipdate IS NULL
""")
def q_residual_joins(spark, t):
    """A time residual inside the ON clause, and a fallback join taken only when the first one missed."""
    o = t.orders.select("o_orderkey", "o_orderdate")
    li = t.lineitem.select(*LINE_ORDER, "l_orderkey")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    line = F.struct(*LINE_ORDER)
    # one join, both residuals as conditional aggregates (min ignores the nulls of the other side)
    firsts = j.groupBy("o_orderkey").agg(
        F.min(F.when(F.col("l_shipdate") > F.col("o_orderdate"), line)).alias("a"),
        F.min(F.when(F.col("l_shipdate") <= F.col("o_orderdate"), line)).alias("b"))
    x = o.join(firsts, "o_orderkey", "left")
    fallback = F.when(F.col("a").isNull(), F.col("b"))  # the second match only counts when the first missed
    return x.select("o_orderkey", F.coalesce(F.col("a.l_shipdate"), fallback["l_shipdate"]).alias("match_ship"),
                    F.when(F.col("a").isNotNull(), "after").when(fallback.isNotNull(), "before")
                    .otherwise("none").alias("match_source"))


@register("typed_key_join", "D21,D23,D25,I7,I12,I35", """
WITH lst AS (
  SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE '  ' || CAST(c_custkey AS VARCHAR) || ' ' END AS key_text, c_mktsegment
  FROM customer WHERE c_acctbal > 5000 OR c_acctbal < 0
), ids AS (
  SELECT TRY_CAST(trim(key_text) AS BIGINT) AS id, rtrim(key_text) AS shown, c_mktsegment FROM lst WHERE key_text IS NOT NULL
)
SELECT o.o_orderkey, o.o_custkey, ids.shown || '/' || o.o_orderstatus AS tag,
       CASE WHEN ids.c_mktsegment = 'BUILDING' THEN NULL ELSE ids.c_mktsegment END || '-' || o.o_orderpriority AS label
FROM orders o JOIN ids ON ids.id = o.o_custkey
""")
def q_typed_key_join(spark, t):
    """A worklist of text keys (padded, some null) joined to bigint keys: normalise once, drop null keys."""
    lst = t.customer.filter((F.col("c_acctbal") > 5000) | (F.col("c_acctbal") < 0)).select(
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("  "), F.col("c_custkey").cast("string"), F.lit(" "))).alias("key_text"),
        "c_mktsegment")
    ids = lst.filter(F.col("key_text").isNotNull()).select(
        F.expr("try_cast(trim(key_text) AS BIGINT)").alias("id"), F.rtrim("key_text").alias("shown"), "c_mktsegment")
    o = t.orders
    j = o.join(ids, o["o_custkey"] == ids["id"])
    seg = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None)).otherwise(F.col("c_mktsegment"))
    return j.select("o_orderkey", "o_custkey",
                    F.concat("shown", F.lit("/"), "o_orderstatus").alias("tag"),
                    F.concat(seg, F.lit("-"), F.col("o_orderpriority")).alias("label"))


@register("agg_suite", "E1,E2,E3,E12,E13,E15", """
SELECT o_custkey, COUNT(*) AS n_orders,
       CAST(COALESCE(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 END), 0) AS BIGINT) AS n_finished,
       MIN(o_orderkey) AS first_order, MAX(o_orderkey) AS last_order,
       MIN(CASE WHEN o_orderstatus = 'O' THEN o_orderdate END) AS first_open,
       GREATEST(MAX(o_orderdate), TIMESTAMP '1997-01-01 00:00:00') AS last_activity,
       CAST(COUNT(*) FILTER (WHERE TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) IS NULL) AS BIGINT) AS bad_priority,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM orders GROUP BY o_custkey
""")
def q_agg_suite(spark, t):
    """Group aggregates: conditional counts and minima, min/max ids, greatest(), a null audit."""
    return t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.coalesce(F.count_if(F.col("o_orderstatus") == "F"), F.lit(0)).cast("bigint").alias("n_finished"),
        F.min("o_orderkey").alias("first_order"), F.max("o_orderkey").alias("last_order"),
        F.min(F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate"))).alias("first_open"),
        F.greatest(F.max("o_orderdate"), ts("1997-01-01 00:00:00")).alias("last_activity"),
        F.count_if(F.expr("try_cast(substr(o_orderpriority, 1, 1) AS INT)").isNull()).cast("bigint")
        .alias("bad_priority"),
        money("o_totalprice").alias("total_price"))


@register("grand_totals", "E9,E10", """
SELECT COUNT(*) AS source_rows,
       CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS closed_rows,
       CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS open_rows,
       MAX(o_orderdate) AS watermark
FROM orders
""")
def q_grand_totals(spark, t):
    """Several scalar counts of one table in one pass (one row)."""
    return t.orders.agg(F.count(F.lit(1)).alias("source_rows"),
                        F.count_if(F.col("o_orderstatus") == "F").cast("bigint").alias("closed_rows"),
                        F.count_if(F.col("o_orderstatus") == "O").cast("bigint").alias("open_rows"),
                        F.max("o_orderdate").alias("watermark"))


@register("distinct_pairs", "E6,E7", """
SELECT DISTINCT o_custkey, o_orderstatus FROM orders
""")
def q_distinct_pairs(spark, t):
    """GROUP BY without aggregates = distinct rows."""
    return t.orders.select("o_custkey", "o_orderstatus").distinct()


@register("literal_union", "H4,H5,H7", """
SELECT o_orderkey AS id, o_orderdate AS ts, CAST(NULL AS VARCHAR) AS event_type, o_totalprice AS amount, 'orders' AS src
FROM orders
UNION ALL
SELECT event_id, ts, event_type, CAST(NULL AS DOUBLE), 'events' FROM events
UNION ALL
SELECT * FROM (VALUES (CAST(-1 AS BIGINT), CAST(NULL AS TIMESTAMP), 'seed', 0.0, 'literal')) v(id, ts, event_type, amount, src)
""")
def q_literal_union(spark, t):
    """UNION ALL of differently shaped inputs after typed-null padding, plus a literal row."""
    a = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts"),
                        F.lit(None).cast("string").alias("event_type"), F.col("o_totalprice").alias("amount"),
                        F.lit("orders").alias("src"))
    b = t.events.select(F.col("event_id").alias("id"), "ts", "event_type", F.lit(None).cast("double").alias("amount"),
                        F.lit("events").alias("src"))
    lit = spark.range(1).select(F.lit(-1).cast("bigint").alias("id"), F.lit(None).cast("timestamp_ntz").alias("ts"),
                                F.lit("seed").alias("event_type"), F.lit(0.0).alias("amount"),
                                F.lit("literal").alias("src"))
    return a.unionByName(b).unionByName(lit)


@register("scalar_dates", "I5,I18,I20-I23,I36,I37", """
WITH o AS (SELECT o_orderkey, o_orderdate, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, d,
       CAST(date_trunc('week', d) AS DATE) AS week_monday,
       CAST(CAST(date_trunc('week', d) AS DATE) + INTERVAL 6 DAY AS DATE) AS week_sunday,
       CAST(date_trunc('week', CAST(d - INTERVAL 12 MONTH AS DATE)) AS DATE) AS fit_monday,
       GREATEST(CAST(0 AS BIGINT), CAST(floor((DATE '1998-09-01' - d) / 7.0) AS BIGINT)) AS weeks_to_as_of,
       o_orderdate + INTERVAL 9 HOUR AS kst,
       GREATEST(d, CAST(DATE '1998-09-01' - INTERVAL 1 DAY AS DATE)) AS closing_floor,
       LEAST(CAST(d - INTERVAL 1 DAY AS DATE), CAST(CAST(date_trunc('week', d) AS DATE) + INTERVAL 6 DAY AS DATE)) AS closing_cap,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS shown,
       CAST(o_orderkey AS VARCHAR) AS key_text
FROM o
""")
def q_scalar_dates(spark, t):
    """Week arithmetic (Monday start), month shifts, whole weeks, +9 h, greatest/least, formatting."""
    d = F.to_date("o_orderdate")
    monday = F.date_trunc("week", d).cast("date")
    as_of = F.lit("1998-09-01").cast("date")
    return t.orders.select(
        "o_orderkey", d.alias("d"), monday.alias("week_monday"), F.date_add(monday, 6).alias("week_sunday"),
        F.date_trunc("week", F.add_months(d, -12)).cast("date").alias("fit_monday"),
        F.greatest(F.lit(0).cast("bigint"), F.floor(F.datediff(as_of, d) / 7)).alias("weeks_to_as_of"),
        (F.col("o_orderdate") + F.expr("INTERVAL 9 HOURS")).alias("kst"),
        F.greatest(d, F.date_sub(as_of, 1)).alias("closing_floor"),
        F.least(F.date_sub(d, 1), F.date_add(monday, 6)).alias("closing_cap"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("shown"),
        F.col("o_orderkey").cast("string").alias("key_text"))


@register("scalar_misc", "I6,I8,I24,I31,I33", """
SELECT event_id,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       TRY_CAST(event_type AS INTEGER) AS bad_cast,
       CAST(user_id AS VARCHAR) || CAST(event_id AS VARCHAR) AS pair_text,
       LEAST(1.0, GREATEST(0.0, value / 100.0)) AS clamped,
       TIMESTAMP '2024-01-31 00:00:00' AS created_at,
       CASE WHEN event_type = 'purchase' THEN 'active' WHEN event_type = 'error' THEN 'done'
            WHEN event_type IN ('view', 'click') THEN 'in_session' ELSE 'error' END AS active_state
FROM events
""")
def q_scalar_misc(spark, t):
    """try_cast, separator-free concatenation (kept only as a column), clamping, run stamp, CASE fallback."""
    return t.events.select(
        "event_id", F.expr("try_cast(get_json_object(props, '$.k') AS INT)").alias("k"),
        F.expr("try_cast(event_type AS INT)").alias("bad_cast"),
        F.concat(F.col("user_id").cast("string"), F.col("event_id").cast("string")).alias("pair_text"),
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("value") / 100.0)).alias("clamped"),
        ts(AS_OF_EVENTS).alias("created_at"),
        F.when(F.col("event_type") == "purchase", "active").when(F.col("event_type") == "error", "done")
        .when(F.col("event_type").isin("view", "click"), "in_session").otherwise("error").alias("active_state"))


@register("key_normalised_join", "D26", """
WITH a AS (
  SELECT c_custkey, c_name, regexp_replace(regexp_replace(lower(trim('  0' || CAST(c_custkey AS VARCHAR) || ' - ')),
                                           '\\s|-', '', 'g'), '^0+', '') AS k FROM customer
), b AS (
  SELECT o_orderkey, regexp_replace(regexp_replace(lower(trim(CAST(o_custkey AS VARCHAR) || '-')), '\\s|-', '', 'g'),
                                    '^0+', '') AS k FROM orders
)
SELECT b.o_orderkey, a.c_custkey, a.c_name FROM b JOIN a ON a.k = b.k
""")
def q_key_normalised_join(spark, t):
    """Keys typed by hand on both sides: lower, trim, drop blanks and dashes, strip leading zeros."""
    a = t.customer.select("c_custkey", "c_name", normalise_key(
        F.concat(F.lit("  0"), F.col("c_custkey").cast("string"), F.lit(" - "))).alias("ka"))
    b = t.orders.select("o_orderkey", normalise_key(F.concat(F.col("o_custkey").cast("string"), F.lit("-")))
                        .alias("kb"))
    return b.join(a, b["kb"] == a["ka"]).select("o_orderkey", "c_custkey", "c_name")


def _nested(t):
    s1 = F.struct(F.col("o_orderkey").alias("id"),
                  F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("grade")).alias("student"))
    s2 = F.struct((F.col("o_orderkey") + 1).alias("id"),
                  F.struct((F.col("o_custkey") + 1).alias("id"), F.lit("extra").alias("grade")).alias("student"))
    lectures = F.when(F.col("o_orderstatus") == "O", F.array(s1, s2)).otherwise(F.array(s1))
    return t.orders.select("o_orderkey", "o_orderdate", lectures.alias("lectures"))


_NESTED_SQL = """nested AS (
  SELECT o_orderkey, o_orderdate,
         CASE WHEN o_orderstatus = 'O'
              THEN [{'id': o_orderkey, 'student': {'id': o_custkey, 'grade': o_orderpriority}},
                    {'id': o_orderkey + 1, 'student': {'id': o_custkey + 1, 'grade': 'extra'}}]
              ELSE [{'id': o_orderkey, 'student': {'id': o_custkey, 'grade': o_orderpriority}}] END AS lectures
  FROM orders
)"""


@register("nested_access", "I25,A12", "WITH " + _NESTED_SQL + """
SELECT o_orderkey, lectures[1].id AS first_id, lectures[1].student.id AS first_student,
       lectures[1].student.grade AS first_grade, lectures[2].id AS second_id, CAST(len(lectures) AS INTEGER) AS n_lectures
FROM nested
""")
def q_nested_access(spark, t):
    """Array-of-struct access by position and field name; a missing position gives null (get)."""
    n = _nested(t)
    first = F.get(F.col("lectures"), 0)
    return n.select("o_orderkey", first["id"].alias("first_id"), first["student"]["id"].alias("first_student"),
                    first["student"]["grade"].alias("first_grade"),
                    F.get(F.col("lectures"), 1)["id"].alias("second_id"),
                    F.size("lectures").alias("n_lectures"))


@register("nested_distinct", "E7", "WITH " + _NESTED_SQL + """
SELECT DISTINCT lectures[1].student.grade AS grade, lectures[2].student.grade AS second_grade FROM nested
""")
def q_nested_distinct(spark, t):
    """SELECT DISTINCT over nested fields."""
    n = _nested(t)
    return n.select(F.get(F.col("lectures"), 0)["student"]["grade"].alias("grade"),
                    F.get(F.col("lectures"), 1)["student"]["grade"].alias("second_grade")).distinct()


@register("top_recent", "H2,A12", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1000
""")
def q_top_recent(spark, t):
    """The 1,000 most recent rows (full tie-break): a top-k, planned as TakeOrderedAndProject."""
    return t.orders.select("o_orderkey", "o_custkey", "o_orderdate") \
        .orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).limit(1000)


@register("month_end_snapshot", "K28,B22,A2", """
SELECT CAST(o_orderdate AS DATE) AS snapshot_date, o_orderstatus, COUNT(*) AS n_orders
FROM orders WHERE CAST(o_orderdate AS DATE) = last_day(CAST(o_orderdate AS DATE))
GROUP BY 1, 2
""")
def q_month_end_snapshot(spark, t):
    """Counts kept only for days that are the last day of their month."""
    d = F.to_date("o_orderdate")
    return t.orders.filter(d == F.last_day(d)).groupBy(d.alias("snapshot_date"), "o_orderstatus") \
        .agg(F.count(F.lit(1)).alias("n_orders"))


@register("first_match_join", "K4: F12,D2,D22,A6", f"""
WITH fo AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) x
  WHERE rn = 1 AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
), fl AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS rn FROM lineitem) y
  WHERE rn = 1
)
SELECT fo.o_custkey, fo.o_orderkey, fo.o_orderdate, fl.l_linenumber, fl.l_shipdate, s.s_name, c.c_name, n.n_name,
       CAST(fo.rn AS BIGINT) AS session_no
FROM fo JOIN fl ON fl.l_orderkey = fo.o_orderkey
JOIN supplier s ON s.s_suppkey = fl.l_suppkey
LEFT JOIN customer c ON c.c_custkey = fo.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def q_first_match_join(spark, t):
    """First order per customer (ranked over all orders, then date-filtered) x its first line x supplier."""
    fo = first_rows(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], 1, rank_col="session_no") \
        .filter(F.col("o_orderdate") >= ts("1996-01-01 00:00:00"))
    fl = first_rows(t.lineitem, ["l_orderkey"], LINE_ORDER, 1)
    s = t.supplier.select("s_suppkey", "s_name")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    j = fo.join(fl, fo["o_orderkey"] == fl["l_orderkey"]).join(s, F.col("l_suppkey") == s["s_suppkey"]) \
        .join(c, F.col("o_custkey") == c["c_custkey"], "left").join(n, F.col("c_nationkey") == n["n_nationkey"], "left")
    return j.select("o_custkey", "o_orderkey", "o_orderdate", "l_linenumber", "l_shipdate", "s_name", "c_name",
                    "n_name", "session_no")


# (table, key, accepted values); lineitem is checked on the key it should have
QUALITY = [(n, ("l_orderkey", "l_linenumber") if n == "lineitem" else spec.key,
            {"o_orderstatus": ["F", "O", "P"]} if n == "orders" else {}) for n, spec in TABLES.items()]


def _quality_sql() -> str:
    out = []
    for n, key, accepted in QUALITY:
        cols = ", ".join(key)
        out += [f"SELECT '{n}' AS table_name, 'unique({','.join(key)})' AS check_name, "
                f"(SELECT COUNT(*) FROM (SELECT {cols} FROM {n} GROUP BY {cols} HAVING COUNT(*) > 1) x) AS failures",
                f"SELECT '{n}', 'not_null({','.join(key)})', (SELECT COUNT(*) FROM {n} WHERE {' OR '.join(c + ' IS NULL' for c in key)})"]
        out += [f"SELECT '{n}', 'accepted({c})', (SELECT COUNT(*) FROM {n} WHERE {c} IS NULL OR {c} NOT IN "
                f"({', '.join(repr(x) for x in v)}))" for c, v in accepted.items()]
    return "\nUNION ALL ".join(out)


@register("quality_report", "L1-L4", _quality_sql())
def q_quality_report(spark, t):
    """unique / not_null / accepted-values checks of all tables; each row counts the failing keys or rows."""
    return quality_report([(n, getattr(t, n), list(key), accepted) for n, key, accepted in QUALITY])
