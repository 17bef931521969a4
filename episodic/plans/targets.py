"""Written targets: checked commits, run intervals, inserts and reloads by mapping, gated snapshots, matching extracts
(A3, A6, A12, B4-B7, B15, B22, E15, K4, K5, K27, K28, K31, K32, L1-L4 at write).

Stand-in: ``customer`` are users, ``orders`` lectures and their cycles, ``lineitem`` sessions and suggestions,
``supplier`` teachers, ``part`` products, ``nation`` names of terms, ``events`` the history of changes.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from episodic.operators.buckets import BucketTable
from episodic.operators.contracts import Contract, ContractError
from episodic.operators.incremental import upsert
from episodic.operators.ledger import RunLedger, within
from episodic.operators.mapping import Mapping, gated, insert, is_month_end, reload, top_k_left_join
from episodic.operators.sinks import conform, materialize
from episodic.operators.windows import first_rows, row_numbers
from episodic.plans.registry import AS_OF_ORDERS, register, ts
from episodic.session import scratch_path
from episodic.sources.files import read_csv_worklist, write_csv_snapshot

# ---------------------------------------------------------------- checked commit

def weekly_contract() -> Contract:
    return Contract(
        StructType.fromDDL("week_start date, cohort_months int, new_actual int, pause_actual int, source string, closed_at timestamp_ntz"),
        key=("week_start", "cohort_months"), not_null=("new_actual", "pause_actual"),
        checks={"cohort_known": "cohort_months IN (1, 3, 6, 12)", "new_not_negative": "new_actual >= 0"},
        defaults={"new_actual": "0", "pause_actual": "0"})


_WEEKLY_SQL = """
WITH weekly AS (
  SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
         CASE o_custkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 6 ELSE 12 END AS cohort_months,
         CAST(COUNT(*) AS INTEGER) AS new_actual
  FROM orders GROUP BY 1, 2
), second AS (SELECT week_start, cohort_months, new_actual FROM weekly WHERE week_start >= DATE '1997-01-06')"""


@register("checked_commit", "B15,E15,L1-L4 at write: B8", _WEEKLY_SQL + """,
bad AS (
  SELECT week_start, cohort_months, -new_actual AS new_actual FROM second
  UNION ALL SELECT week_start, 2, new_actual FROM second WHERE cohort_months = 1
  UNION ALL SELECT week_start, CAST(NULL AS INTEGER), new_actual FROM second WHERE cohort_months = 3
  UNION ALL SELECT week_start, cohort_months, new_actual FROM second WHERE cohort_months = 6
)
SELECT 'first' AS batch, 'rows' AS rule, (SELECT COUNT(*) FROM weekly WHERE week_start < DATE '1997-01-06') AS failures, TRUE AS published
UNION ALL SELECT 'bad', 'check(cohort_known)', (SELECT COUNT(*) FROM bad WHERE cohort_months NOT IN (1, 3, 6, 12)), FALSE
UNION ALL SELECT 'bad', 'check(new_not_negative)', (SELECT COUNT(*) FROM bad WHERE new_actual < 0), FALSE
UNION ALL SELECT 'bad', 'not_null(cohort_months)', (SELECT COUNT(*) FROM bad WHERE cohort_months IS NULL), FALSE
UNION ALL SELECT 'bad', 'unique(week_start,cohort_months)', (
  SELECT COUNT(*) FROM (SELECT 1 FROM bad GROUP BY week_start, cohort_months HAVING COUNT(*) > 1)), FALSE
UNION ALL SELECT 'readable after bad', 'rows', (SELECT COUNT(*) FROM weekly WHERE week_start < DATE '1997-01-06'), TRUE
UNION ALL SELECT 'second', 'rows', (SELECT COUNT(*) FROM weekly), TRUE
""")
def q_checked_commit(spark, t):
    """Weekly counts written under their contract: the first weeks, a batch that breaks every rule (refused, the old
    version stays readable), and the right batch. Missing columns are added with their defaults."""
    contract = weekly_contract()
    table = BucketTable(spark, scratch_path(spark, "weekly_actuals"), contract.schema, contract.key, 8, contract)
    cohort = F.when(F.col("o_custkey") % 4 == 0, 1).when(F.col("o_custkey") % 4 == 1, 3).when(F.col("o_custkey") % 4 == 2, 6).otherwise(12)
    weekly = materialize(t.orders.groupBy(F.date_trunc("week", "o_orderdate").cast("date").alias("week_start"), cohort.alias("cohort_months")) \
        .agg(F.count(F.lit(1)).cast("int").alias("new_actual")), "weekly")
    cut = F.col("week_start") >= F.lit("1997-01-06").cast("date")
    out = []
    first = table.replace(weekly.filter(~cut), 0)
    out.append(("first", "rows", first.rules["rows"], True))
    second = weekly.filter(cut)
    bad = second.withColumn("new_actual", -F.col("new_actual")) \
        .unionByName(second.filter("cohort_months = 1").withColumn("cohort_months", F.lit(2))) \
        .unionByName(second.filter("cohort_months = 3").withColumn("cohort_months", F.lit(None).cast("int"))) \
        .unionByName(second.filter("cohort_months = 6"))
    try:
        table.merge(bad, 1, lambda stored, new: new)
    except ContractError as e:
        out += [("bad", rule, n, False) for rule, n in e.counts.items() if n and rule != "rows"]
    out.append(("readable after bad", "rows", table.read().count(), True))
    table.merge(second, 1, lambda stored, new: upsert(stored, new, list(contract.key)))
    out.append(("second", "rows", table.read().count(), True))
    return spark.createDataFrame(out, "batch string, rule string, failures bigint, published boolean")


# ---------------------------------------------------------------- run intervals

class SourceLost(RuntimeError):
    pass


@register("interval_scan", "A6: run ledger", """
SELECT *, CASE WHEN o_orderdate < TIMESTAMP '1997-04-01 00:00:00' THEN 1 ELSE 3 END AS run_no FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-03-01 00:00:00' AND o_orderdate < TIMESTAMP '1997-06-01 00:00:00'
""")
def q_interval_scan(spark, t):
    """[end of the last successful run, this run's end), bounds noted in UTC and rendered as Korean time: three runs, of
    which the second fails; the third reads the interval of both, so every row is read once."""
    schema = StructType(t.orders.schema.fields + [*StructType.fromDDL("run_no int").fields])
    table = BucketTable(spark, scratch_path(spark, "interval_rows"), schema, ("o_orderkey",), 8)
    ledger = RunLedger(spark, scratch_path(spark, "ledger"))
    ledger.record("orders", "seed", None, datetime(1997, 2, 28, 15), "success")
    for run_no, end in ((1, datetime(1997, 3, 31, 15)), (2, datetime(1997, 4, 30, 15)), (3, datetime(1997, 5, 31, 15))):
        def read(start, end, run_no=run_no):
            rows = t.orders.filter(within("o_orderdate", start, end, kst=True)).withColumn("run_no", F.lit(run_no))
            if run_no == 2:
                raise SourceLost("the source went away before the commit")
            table.append(rows, run_no, lambda stored, new: new)
        try:
            ledger.run("orders", f"run-{run_no}", end, read)
        except SourceLost:
            pass
    return table.read()


LIST = "lecture_vt_no bigint, teacher_user_no bigint, teacher_name string, student_name string, room_id string, " \
       "tutoring_datetime timestamp_ntz"
_LECTURE_LIST_SQL = """
WITH lvs AS (
  SELECT o.o_custkey AS lecture_vt_no, l.l_orderkey AS cycle_no, l.l_linenumber, l.l_suppkey AS teacher_user_no, s.s_name AS teacher_name,
         l.l_shipdate AS tutoring_datetime, l.l_partkey, l.l_quantity
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
), first_match AS (
  SELECT lecture_vt_no, teacher_user_no FROM (
    SELECT lecture_vt_no, teacher_user_no, ROW_NUMBER() OVER (PARTITION BY lecture_vt_no
      ORDER BY tutoring_datetime, cycle_no, l_linenumber, teacher_user_no, l_partkey, l_quantity) AS rn FROM lvs) WHERE rn = 1
), first_pay AS (
  SELECT o_custkey AS lecture_vt_no FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
  WHERE rn = 1 AND o_orderdate >= TIMESTAMP '1995-01-01 00:00:00'
), found AS (
  SELECT v.lecture_vt_no, v.teacher_user_no, v.teacher_name, c.c_name AS student_name, 'room-' || CAST(v.cycle_no AS VARCHAR) AS room_id,
         v.tutoring_datetime, CASE WHEN v.tutoring_datetime < TIMESTAMP '1997-01-01 00:00:00' THEN 0 ELSE 1 END AS run_no
  FROM lvs v JOIN orders lvc ON lvc.o_orderkey = v.cycle_no JOIN first_match m USING (lecture_vt_no, teacher_user_no)
    JOIN first_pay USING (lecture_vt_no) JOIN supplier t ON t.s_suppkey = v.teacher_user_no AND t.s_acctbal > 0
    LEFT JOIN customer c ON c.c_custkey = v.lecture_vt_no
  WHERE v.tutoring_datetime >= TIMESTAMP '1995-01-01 00:00:00' AND v.tutoring_datetime < TIMESTAMP '1999-01-01 00:00:00'
    AND ((v.tutoring_datetime < TIMESTAMP '1997-01-01 00:00:00') = (lvc.o_orderdate < TIMESTAMP '1997-01-01 00:00:00'))
    AND lvc.o_orderdate >= TIMESTAMP '1995-01-01 00:00:00' AND lvc.o_orderdate < TIMESTAMP '1999-01-01 00:00:00'
), kept AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY room_id ORDER BY run_no DESC, tutoring_datetime DESC, lecture_vt_no DESC,
    teacher_user_no DESC) AS rn FROM found) WHERE rn = 1
)
SELECT lecture_vt_no, teacher_user_no, teacher_name, student_name, room_id, tutoring_datetime,
  CAST(ROW_NUMBER() OVER (PARTITION BY lecture_vt_no ORDER BY tutoring_datetime NULLS LAST, room_id) AS BIGINT) AS rn
FROM kept
"""


@register("first_lecture_list", "K4: A6,F12,D2,D22; K5: A10,G3,I17,F12,B5", _LECTURE_LIST_SQL)
def q_first_lecture_list(spark, t):
    """First-lecture list of two runs: sessions and their cycles of the run's interval (taken from the ledger), of the
    teacher of the lecture's first match, where the first payment (ranked first, then dated) and the teacher qualify; added
    to the stored CSV list, one row per trimmed room (the last written stays), numbered per lecture."""
    o, s = t.orders, t.supplier
    sessions = t.lineitem.select(F.col("l_orderkey").alias("cycle_no"), F.col("l_suppkey").alias("teacher_user_no"),
                                 F.col("l_shipdate").alias("tutoring_datetime"), "l_linenumber")
    cycles = o.select(F.col("o_orderkey").alias("cycle_no"), F.col("o_custkey").alias("lecture_vt_no"))
    # only the first session of a cycle moves on to its lecture; of rows that tie up to the teacher any names the same one
    by_time = ["tutoring_datetime", "cycle_no", "l_linenumber", "teacher_user_no"]
    opening = first_rows(sessions.filter(F.col("cycle_no").isNotNull()), ["cycle_no"], by_time, 1).join(cycles, "cycle_no")
    first_match = first_rows(opening, ["lecture_vt_no"], by_time, 1).select("lecture_vt_no", "teacher_user_no")
    first_pay = first_rows(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], 1) \
        .filter(F.col("o_orderdate") >= ts("1995-01-01 00:00:00")).select(F.col("o_custkey").alias("lecture_vt_no"))
    active = s.filter(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("teacher_user_no"), F.col("s_name").alias("teacher_name"))
    names = t.customer.select(F.col("c_custkey").alias("lecture_vt_no"), F.col("c_name").alias("student_name"))
    # one small row a lecture, stored for both runs: all sessions are ranked once
    firsts = materialize(first_match.join(first_pay, "lecture_vt_no"), "first_lecture_teachers")

    ledger, path = RunLedger(spark, scratch_path(spark, "ledger")), [scratch_path(spark, "first_lecture_list")]
    schema = StructType.fromDDL(LIST)
    empty = spark.createDataFrame([], schema)
    write_csv_snapshot(empty, path[0])
    ledger.record("first_lecture", "seed", None, datetime(1994, 12, 31, 15), "success")

    def extract(start, end):
        lvs = sessions.filter(within("tutoring_datetime", start, end, kst=True)).join(cycles, "cycle_no")
        lvc = o.filter(within("o_orderdate", start, end, kst=True)).select(F.col("o_orderkey").alias("cycle_no"))
        fresh = lvs.join(lvc, "cycle_no").join(firsts, ["lecture_vt_no", "teacher_user_no"]) \
            .join(active, "teacher_user_no").join(names, "lecture_vt_no", "left") \
            .withColumn("room_id", F.concat(F.lit(" room-"), F.col("cycle_no").cast("string")))
        # the stored list comes back as text; unreadable times become null
        stored = read_csv_worklist(spark, path[0]) if path[0] else empty
        stored = conform(stored.withColumn("tutoring_datetime", F.col("tutoring_datetime").cast("string").try_cast("timestamp_ntz")), schema)
        both = stored.withColumn("_run", F.lit(0)).unionByName(conform(fresh, schema).withColumn("_run", F.lit(1)))
        both = both.withColumn("room_id", F.trim("room_id"))
        one = first_rows(both, ["room_id"], [F.col(c).desc() for c in ("_run", "tutoring_datetime", "lecture_vt_no", "teacher_user_no")], 1)
        out = scratch_path(spark, "first_lecture_list")
        write_csv_snapshot(one.drop("_run"), out)
        path[0] = out

    ledger.run("first_lecture", "run-0", datetime(1996, 12, 31, 15), extract)
    ledger.run("first_lecture", "run-1", datetime(1998, 12, 31, 15), extract)
    done = conform(read_csv_worklist(spark, path[0]), schema)
    return row_numbers(done, ["lecture_vt_no"], [F.col("tutoring_datetime").asc_nulls_last(), F.col("room_id")], "rn",
                       chunk=F.date_trunc("year", "tutoring_datetime"), chunk_nulls_last=True)


CYCLES = {"lecture_cycle_no": ("o_orderkey", "bigint"), "lecture_vt_no": ("o_custkey", "bigint"), "cycle_state": ("o_orderstatus", "string"),
          "tutor_price": ("o_totalprice", "double"), "req_datetime": ("o_orderdate", "timestamp_ntz")}


@register("interval_extract", "K27: A7,B1,B5", """
WITH c AS (
  SELECT o_orderkey AS lecture_cycle_no, o_custkey AS lecture_vt_no, o_orderstatus AS cycle_state,
         o_totalprice AS tutor_price, o_orderdate AS req_datetime
  FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-04-01 00:00:00' AND TIMESTAMP '1995-08-31 00:00:00')
SELECT *, 'table' AS written_to FROM c UNION ALL SELECT *, 'csv' FROM c
""")
def q_interval_extract(spark, t):
    """A dated extract with renamed columns (pushed-down range on the scan), written as the mirror table and as its CSV
    snapshot from one scan; both are read back."""
    mapping = Mapping("lecture_vt_cycles", ("lecture_cycle_no",), CYCLES,
                      "o_orderdate BETWEEN TIMESTAMP_NTZ '1995-04-01 00:00:00' AND TIMESTAMP_NTZ '1995-08-31 00:00:00'")
    table = mapping.table(spark, scratch_path(spark, "cycles"), 8)
    reload(table, mapping, t.orders)
    path = scratch_path(spark, "cycles_csv")
    write_csv_snapshot(table.read(), path, columns=list(CYCLES))
    return table.read().withColumn("written_to", F.lit("table")) \
        .unionByName(conform(read_csv_worklist(spark, path), mapping.schema).withColumn("written_to", F.lit("csv")))


# ---------------------------------------------------------------- gated second write

@register("stock_count", "K28: A2,B20,B22", """
WITH days AS (SELECT * FROM (VALUES (DATE '1996-02-28'), (DATE '1996-02-29'), (DATE '1996-03-01')) v(as_of)),
counts AS (
  SELECT as_of, o_orderstatus AS item, COUNT(*) AS n FROM days JOIN orders ON CAST(o_orderdate AS DATE) <= as_of GROUP BY 1, 2)
SELECT 'daily' AS list, as_of, item, n FROM counts WHERE as_of = DATE '1996-03-01'
UNION ALL SELECT 'monthly', as_of, item, n FROM counts WHERE as_of = DATE '1996-02-29'
""")
def q_stock_count(spark, t):
    """Counts of three days: the daily list is replaced every day, the monthly one only on the last day of a month, both
    from one scan of the day."""
    schema = StructType.fromDDL("as_of date, item string, n bigint")
    daily = BucketTable(spark, scratch_path(spark, "stock_daily"), schema, ("item",), 4)
    monthly = BucketTable(spark, scratch_path(spark, "stock_monthly"), schema, ("item",), 4)
    for i, day in enumerate((datetime(1996, 2, 28), datetime(1996, 2, 29), datetime(1996, 3, 1))):
        as_of = F.lit(day.date())
        rows = t.orders.filter(F.col("o_orderdate") < ts(day + timedelta(days=1))) \
            .groupBy(F.col("o_orderstatus").alias("item")).agg(F.count(F.lit(1)).alias("n")).withColumn("as_of", as_of)
        gated(as_of, rows, [(daily, F.lit(True)), (monthly, is_month_end(as_of))], i)
    return daily.read().withColumn("list", F.lit("daily")).unionByName(monthly.read().withColumn("list", F.lit("monthly")))


# ---------------------------------------------------------------- inserts and reloads by mapping

MAPPINGS = {m.target: m for m in (
    Mapping("user", ("user_no",), {
        "user_no": ("c_custkey", "bigint"), "name": ("c_name", "string"), "cash": ("c_acctbal", "double"),
        "term_user_type": ("c_mktsegment", "string"), "school_seq": ("c_nationkey", "int"), "nickname": (None, "string")},
        where="c_custkey >= 45"),
    Mapping("payment", ("payment_no",), {
        "payment_no": ("o_orderkey", "bigint"), "user_no": ("o_custkey", "bigint"), "state": ("o_orderstatus", "string"),
        "lgd_amount": ("o_totalprice", "decimal(18,2)"), "payment_regdate": ("o_orderdate", "timestamp_ntz"), "memo": (None, "string")}),
    Mapping("lecture_video_tutoring", ("lecture_vt_no",), {
        "lecture_vt_no": ("o_orderkey", "bigint"), "student_user_no": ("o_custkey", "bigint"),
        "tutoring_state": ("o_orderstatus", "string"), "update_datetime": ("o_orderdate", "timestamp_ntz")},
        where=f"o_orderdate >= CAST(DATE_SUB(DATE '{AS_OF_ORDERS:%Y-%m-%d}', 30) AS TIMESTAMP_NTZ)"),
    Mapping("lecture_vt_schedules", ("lecture_vt_no", "schedule_no"), {
        "schedule_no": ("l_linenumber", "int"), "follow_no": ("l_suppkey", "bigint"), "lecture_vt_no": ("l_orderkey", "bigint"),
        "schedule_state": ("l_linestatus", "string"), "tutoring_datetime": ("l_shipdate", "timestamp_ntz"),
        "per_done_month": ("l_quantity", "decimal(18,3)")}, where="l_orderkey BETWEEN 20 AND 2500"),
    Mapping("teacher", ("user_no",), {
        "user_no": ("s_suppkey", "bigint"), "hakbun": ("s_name", "string"), "univ_graduate_type": ("s_nationkey", "int"),
        "seoltab_state": (None, "string")}),
    Mapping("tteok_ham", ("tteok_ham_no",), {
        "tteok_ham_no": ("p_partkey", "bigint"), "tteok_ham_title": ("p_name", "string"), "tteok_ham_price": ("p_retailprice", "double")}),
    Mapping("term_taxonomy_name", ("term_taxonomy_id",), {
        "name": ("n_name", "string"), "term_taxonomy_id": ("n_nationkey", "bigint"), "parent": ("n_regionkey", "bigint")}),
    Mapping("lecture_vt_schedules_history", ("history_no",), {
        "history_no": ("event_id", "bigint"), "schedule_no": ("user_id", "bigint"), "change_type": ("event_type", "string"),
        "create_datetime": ("ts", "timestamp_ntz")}, newest=(("ts", "event_id"), 1000)),
)}


def _inserted(spark, t, target: str, source: str):
    """Two inserts of one extract's halves by key; rows of the first stay as they are."""
    m = MAPPINGS[target]
    table = m.table(spark, scratch_path(spark, target), 8)
    df = getattr(t, source)
    key = m.columns[m.key[0]][0]
    insert(table, m, df.filter(F.col(key) % 2 == 0), 0)
    insert(table, m, df.filter(F.col(key) % 2 != 0), 1)
    return table.read()


@register("insert_user", "B6,K32,A3", """
SELECT c_custkey AS user_no, c_name AS name, c_acctbal AS cash, c_mktsegment AS term_user_type,
  CAST(c_nationkey AS INTEGER) AS school_seq, CAST(NULL AS VARCHAR) AS nickname
FROM customer WHERE c_custkey >= 45
""")
def q_insert_user(spark, t):
    """Users from an id on, renamed, with a padded column."""
    return _inserted(spark, t, "user", "customer")


@register("insert_payment", "B6,K32,A3", """
SELECT o_orderkey AS payment_no, o_custkey AS user_no, o_orderstatus AS state, CAST(o_totalprice AS DECIMAL(18,2)) AS lgd_amount,
  o_orderdate AS payment_regdate, CAST(NULL AS VARCHAR) AS memo
FROM orders
""")
def q_insert_payment(spark, t):
    return _inserted(spark, t, "payment", "orders")


@register("insert_schedule", "B6,K32,A3", """
SELECT CAST(l_linenumber AS INTEGER) AS schedule_no, l_suppkey AS follow_no, l_orderkey AS lecture_vt_no, l_linestatus AS schedule_state,
  l_shipdate AS tutoring_datetime, CAST(l_quantity AS DECIMAL(18,3)) AS per_done_month
FROM lineitem WHERE l_orderkey BETWEEN 20 AND 2500
""")
def q_insert_schedule(spark, t):
    """Sessions of an id range."""
    return _inserted(spark, t, "lecture_vt_schedules", "lineitem")


@register("insert_reference_tables", "B6,K32", """
SELECT 'teacher' AS target, CAST(s_suppkey AS VARCHAR) AS key, s_name AS label FROM supplier
UNION ALL SELECT 'tteok_ham', CAST(p_partkey AS VARCHAR), p_name FROM part
UNION ALL SELECT 'term_taxonomy_name', CAST(n_nationkey AS VARCHAR), n_name FROM nation
""")
def q_insert_reference_tables(spark, t):
    """Teachers, products and terms, each inserted into its own target by its mapping."""
    out = None
    for target, source, label in (("teacher", "supplier", "hakbun"), ("tteok_ham", "part", "tteok_ham_title"),
                                  ("term_taxonomy_name", "nation", "name")):
        rows = _inserted(spark, t, target, source).select(
            F.lit(target).alias("target"), F.col(MAPPINGS[target].key[0]).cast("string").alias("key"), F.col(label).alias("label"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("insert_history", "B6,K32,H2", """
SELECT event_id AS history_no, user_id AS schedule_no, event_type AS change_type, ts AS create_datetime
FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000
""")
def q_insert_history(spark, t):
    """The newest 1,000 changes (the extract's own limit)."""
    m = MAPPINGS["lecture_vt_schedules_history"]
    table = m.table(spark, scratch_path(spark, m.target), 8)
    insert(table, m, t.events, 0)
    return table.read()


@register("bulk_reload", "K32: A8,B7", f"""
SELECT o_orderkey AS lecture_vt_no, o_custkey AS student_user_no, o_orderstatus AS tutoring_state, o_orderdate AS update_datetime
FROM orders WHERE o_orderdate >= CAST(DATE '{AS_OF_ORDERS:%Y-%m-%d}' - INTERVAL 30 DAY AS TIMESTAMP)
""")
def q_bulk_reload(spark, t):
    """Delete and reload: the target held the rows of another extract, none of which stays."""
    m = MAPPINGS["lecture_video_tutoring"]
    table = m.table(spark, scratch_path(spark, m.target), 8)
    old = Mapping(m.target, m.key, m.columns, "o_orderdate < TIMESTAMP_NTZ '1996-01-01 00:00:00'")
    insert(table, old, t.orders, 0)
    reload(table, m, t.orders, 1)
    return table.read()


# ---------------------------------------------------------------- matching and contract extracts

_SUGGESTION_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_linenumber"]


@register("suggestion_extract", "K31: D3,H2", """
SELECT o.o_orderkey, o.o_orderdate, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderdate > TIMESTAMP '1996-06-01 00:00:00'
ORDER BY o.o_orderdate DESC, o.o_orderkey DESC, l.l_shipdate ASC NULLS LAST, l.l_partkey ASC NULLS LAST,
         l.l_suppkey ASC NULLS LAST, l.l_extendedprice ASC NULLS LAST, l.l_quantity ASC NULLS LAST, l.l_linenumber ASC NULLS LAST
LIMIT 1000
""")
def q_suggestion_extract(spark, t):
    """Recent matchings with all their suggestions (left join), the newest 1,000 rows with a complete tie-break."""
    o = t.orders.select("o_orderkey", "o_orderdate").filter(F.col("o_orderdate") > ts("1996-06-01 00:00:00"))
    li = t.lineitem.select("l_orderkey", *_SUGGESTION_ORDER)
    j = top_k_left_join(o, li, F.col("o_orderkey") == F.col("l_orderkey"), "o_orderkey", "l_orderkey",
                        [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
                        [F.col(c).asc_nulls_last() for c in _SUGGESTION_ORDER], 1000)
    return j.select("o_orderkey", "o_orderdate", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


def matching_documents(t):
    """Matchings as they arrive: one JSON document each, of nested arrays and objects."""
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    o = t.orders.join(c, F.col("o_custkey") == F.col("c_custkey"))
    student = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("o_orderpriority").alias("grade"))
    lecture = F.struct(F.col("o_orderkey").alias("id"), student.alias("student"))
    return o.select(F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("_id"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderkey") % 7 == 0, F.array().cast("array<struct<id:bigint,student:struct<id:bigint,name:string,grade:string>>>"))
        .otherwise(F.array(lecture)).alias("lectures"),
        F.struct(F.col("c_mktsegment").alias("subject")).alias("option"),
        F.array(F.col("o_custkey") % 5, F.col("o_orderkey") % 3).alias("manager"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("createdat"))).alias("doc"))


MATCHING = ("matching_id bigint, mlvt_status string, lecture_vt_no bigint, student_id bigint, student_name string, "
            "student_grade string, second_lecture bigint, manager_no int, option string, mlvt_created_at timestamp_ntz, "
            "memo string, ms_line int, suggestion_teacher_id bigint, ms_created_at timestamp_ntz")


@register("matching_extract", "K31: A12,B4,D3,H2,I25", """
WITH d AS (
  SELECT o_orderkey AS matching_id, o_orderstatus AS mlvt_status, o_orderkey % 7 <> 0 AS has, o_custkey, c_name, o_orderpriority,
         c_mktsegment, o_orderkey, o_orderdate AS mlvt_created_at
  FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate > TIMESTAMP '1996-06-01 00:00:00')
SELECT matching_id, mlvt_status, CASE WHEN has THEN o_orderkey END AS lecture_vt_no, CASE WHEN has THEN o_custkey END AS student_id,
  CASE WHEN has THEN c_name END AS student_name, CASE WHEN has THEN o_orderpriority END AS student_grade,
  CAST(NULL AS BIGINT) AS second_lecture, CAST(o_custkey % 5 AS INTEGER) AS manager_no, '{"subject":"' || c_mktsegment || '"}' AS option,
  mlvt_created_at, CAST(NULL AS VARCHAR) AS memo, CAST(l_linenumber AS INTEGER) AS ms_line, l_suppkey AS suggestion_teacher_id,
  l_shipdate AS ms_created_at
FROM d LEFT JOIN lineitem ON l_orderkey = matching_id
ORDER BY mlvt_created_at DESC, matching_id DESC, l_shipdate ASC NULLS LAST, l_partkey ASC NULLS LAST, l_suppkey ASC NULLS LAST,
  l_extendedprice ASC NULLS LAST, l_quantity ASC NULLS LAST, l_linenumber ASC NULLS LAST
LIMIT 1000
""")
def q_matching_extract(spark, t):
    """Nested matching documents: parsed as variants, fields taken by name and by place (a place out of range is null),
    dated and cut to the newest before their suggestions join; written through the typed sink, the option as JSON text."""
    v = matching_documents(t).select(F.parse_json("doc").alias("v"))

    def get(path, kind):
        return F.try_variant_get("v", path, kind)

    m = v.select(get("$._id", "bigint").alias("matching_id"), get("$.status", "string").alias("mlvt_status"),
                 get("$.lectures[0].id", "bigint").alias("lecture_vt_no"), get("$.lectures[0].student.id", "bigint").alias("student_id"),
                 get("$.lectures[0].student.name", "string").alias("student_name"),
                 get("$.lectures[0].student.grade", "string").alias("student_grade"),
                 get("$.lectures[1].id", "bigint").alias("second_lecture"), get("$.manager[0]", "int").alias("manager_no"),
                 F.to_json(get("$.option", "variant")).alias("option"),
                 get("$.createdat", "string").try_cast("timestamp_ntz").alias("mlvt_created_at"))
    m = m.filter(F.col("mlvt_created_at") > ts("1996-06-01 00:00:00"))
    li = t.lineitem.select("l_orderkey", *_SUGGESTION_ORDER)
    j = top_k_left_join(m, li, F.col("matching_id") == F.col("l_orderkey"), "matching_id", "l_orderkey",
                        [F.col("mlvt_created_at").desc(), F.col("matching_id").desc()],
                        [F.col(c).asc_nulls_last() for c in _SUGGESTION_ORDER], 1000)
    j = j.withColumnsRenamed({"l_linenumber": "ms_line", "l_suppkey": "suggestion_teacher_id", "l_shipdate": "ms_created_at"})
    # a row has no key of its own: a matching comes once per suggestion
    table = BucketTable(spark, scratch_path(spark, "matching"), StructType.fromDDL(MATCHING), ("matching_id",), 8)
    table.replace(j, 0)
    return table.read()


@register("contract_extract", "K31: D3,A1", """
SELECT s_suppkey AS no, s_name AS user_name, s_nationkey AS contract_no, n_name AS contract_name
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND n_regionkey <> 2
""")
def q_contract_extract(spark, t):
    """Every teacher contract with its name where there is one."""
    n = t.nation.filter(F.col("n_regionkey") != 2).select("n_nationkey", F.col("n_name").alias("contract_name"))
    return t.supplier.join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias("no"), F.col("s_name").alias("user_name"), F.col("s_nationkey").alias("contract_no"), "contract_name")
