"""Operational work lists and letters (K6, K18, K19, K21, K22; D15, D17, B21, A11, C14).

Stand-ins: customers are students/lectures, their orders are payments, a
list kept by hand is the set of customers with ``c_acctbal > 5000`` whose keys
are stored as padded text. ``as_of`` is 1998-09-01, so "yesterday" is 1998-08-31.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from episodic.functions.cleaning import clean_date_text, parse_date_text
from episodic.functions.keys import int_key, text_key
from episodic.operators.buckets import BucketTable
from episodic.operators.sinks import conform, materialize
from episodic.operators.windows import first_rows
from episodic.plans.lifecycle import COHORT_OF_PRIORITY
from episodic.plans.ranks import LINE_ORDER, LINE_ORDER_SQL
from episodic.plans.registry import AS_OF_ORDERS, register, ts
from episodic.session import scratch_path
from episodic.sources.files import read_csv_worklist, write_csv_snapshot

YESTERDAY = "1998-08-31"


def existing_list(t, min_balance: float = 5000):
    """Rows already on the sheet: key as padded text."""
    return t.customer.filter(F.col("c_acctbal") > min_balance).select(
        F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(" ")).alias("row_key"))


def minus_list(df, key_col, t, min_balance: float = 5000):
    """Drop rows whose key (as trimmed text) is already on the list."""
    lst = existing_list(t, min_balance).select(text_key(F.col("row_key")).alias("_lk"))
    return df.join(lst, text_key(df[key_col]) == lst["_lk"], "left_anti")


_LIST_SQL = "(SELECT ' ' || CAST(c_custkey AS VARCHAR) || ' ' AS row_key FROM customer WHERE c_acctbal > 5000)"


@register("worklist_anti", "D17,D14", f"""
SELECT c.c_custkey, c.c_name FROM customer c
WHERE c.c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
  AND NOT EXISTS (SELECT 1 FROM {_LIST_SQL} w WHERE trim(w.row_key) = trim(CAST(c.c_custkey AS VARCHAR)))
""")
def q_worklist_anti(spark, t):
    """Candidates (customers with an open order) not yet on the hand-kept list."""
    c = t.customer.select("c_custkey", "c_name")
    open_o = t.orders.filter(F.col("o_orderstatus") == "O").select("o_custkey")
    cand = c.join(open_o, c["c_custkey"] == open_o["o_custkey"], "left_semi")
    return minus_list(cand, "c_custkey", t)


@register("worklist_backfill", "B21,D21", """
WITH w AS (
  SELECT CASE WHEN c_nationkey = 0 THEN '#N/A' ELSE CAST(c_custkey AS VARCHAR) END AS row_key,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'stopped' ELSE 'active' END AS status,
         CASE WHEN c_acctbal > 8000 THEN 'kept' ELSE '' END AS submitted_at
  FROM customer WHERE c_acctbal > 5000
), lk AS (
  SELECT o_custkey, strftime(MIN(o_orderdate), '%Y-%m-%d %H:%M:%S') AS first_order FROM orders GROUP BY o_custkey
)
SELECT w.row_key, w.status,
       CASE WHEN w.submitted_at = '' AND w.status <> 'stopped' AND w.row_key <> '#N/A'
            THEN COALESCE(lk.first_order, '') ELSE w.submitted_at END AS submitted_at
FROM w LEFT JOIN lk ON lk.o_custkey = TRY_CAST(w.row_key AS BIGINT)
""")
def q_worklist_backfill(spark, t):
    """Fill blank cells of the list from a lookup, only for live rows with a real key."""
    c = t.customer.filter(F.col("c_acctbal") > 5000)
    w = c.select(F.when(F.col("c_nationkey") == 0, F.lit("#N/A")).otherwise(F.col("c_custkey").cast("string"))
                 .alias("row_key"),
                 F.when(F.col("c_mktsegment") == "AUTOMOBILE", "stopped").otherwise("active").alias("status"),
                 F.when(F.col("c_acctbal") > 8000, "kept").otherwise("").alias("submitted_at"))
    lk = t.orders.groupBy("o_custkey").agg(
        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("first_order"))
    j = w.join(lk, F.col("row_key").try_cast("bigint") == lk["o_custkey"], "left")
    fill = (F.col("submitted_at") == "") & (F.col("status") != "stopped") & (F.col("row_key") != "#N/A")
    return j.select("row_key", "status", F.when(fill, F.coalesce("first_order", F.lit("")))
                    .otherwise(F.col("submitted_at")).alias("submitted_at"))


@register("unsubmitted_applications", "K18: C4,D10,C12,D17", f"""
WITH act AS (
  SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS act_date FROM orders
  WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey
), ranked AS (
  SELECT o.o_custkey, o.o_orderkey, o.o_orderdate, o.o_orderstatus,
         ROW_NUMBER() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey) AS rn
  FROM orders o JOIN act a ON a.o_custkey = o.o_custkey AND CAST(o.o_orderdate AS DATE) >= a.act_date
)
SELECT r.o_custkey AS c_custkey, r.o_orderkey, r.o_orderdate
FROM ranked r JOIN customer c ON c.c_custkey = r.o_custkey
WHERE r.rn = 1 AND r.o_orderstatus = 'F'
  AND date_sub('day', r.o_orderdate, TIMESTAMP '1998-09-01 00:00:00') >= 3
  AND c.c_name NOT LIKE '%#0000000__'
  AND NOT EXISTS (SELECT 1 FROM {_LIST_SQL} w WHERE trim(w.row_key) = CAST(r.o_custkey AS VARCHAR))
""")
def q_unsubmitted_applications(spark, t):
    """First payment on/after the (re)activation day, ranked over all states, then kept only if paid
    and at least three whole days old; test accounts and listed rows removed."""
    o = t.orders
    act = o.filter(F.col("o_orderpriority") == "1-URGENT").groupBy(F.col("o_custkey").alias("a_cust")) \
        .agg(F.to_date(F.min("o_orderdate")).alias("act_date"))
    cand = o.join(act, (o["o_custkey"] == act["a_cust"]) & (F.to_date("o_orderdate") >= F.col("act_date")))
    first = first_rows(cand, ["o_custkey"], ["o_orderdate", "o_orderkey"], 1)
    aged = F.expr("timestampdiff(DAY, o_orderdate, TIMESTAMP_NTZ '1998-09-01 00:00:00')") >= 3
    first = first.filter((F.col("o_orderstatus") == "F") & aged)
    real = t.customer.filter(~F.col("c_name").like("%#0000000__")).select("c_custkey")
    res = first.join(real, first["o_custkey"] == real["c_custkey"]).select("c_custkey", "o_orderkey", "o_orderdate")
    return minus_list(res, "c_custkey", t)


@register("first_session_missed", "K19: C10,D1,D20,D17", f"""
WITH fl AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER_SQL}) AS rn FROM lineitem) x
  WHERE rn = 1
)
SELECT fl.l_orderkey, o.o_custkey, c.c_name AS student_name, s.s_name AS teacher_name, fl.l_shipdate, fl.l_returnflag
FROM fl JOIN orders o ON o.o_orderkey = fl.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN supplier s ON s.s_suppkey = fl.l_suppkey
WHERE CAST(fl.l_shipdate AS DATE) = DATE '{YESTERDAY}' AND fl.l_returnflag <> 'N'
  AND NOT EXISTS (SELECT 1 FROM {_LIST_SQL.replace("5000", "9500")} w
                  WHERE trim(w.row_key) = CAST(o.o_custkey AS VARCHAR))
""")
def q_first_session_missed(spark, t):
    """Yesterday's first session of each episode that was not held, with student and teacher names."""
    fl = first_rows(t.lineitem, ["l_orderkey"], LINE_ORDER, 1) \
        .filter((F.to_date("l_shipdate") == F.lit(YESTERDAY).cast("date")) & (F.col("l_returnflag") != "N"))
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", F.col("c_name").alias("student_name"))
    s = t.supplier.select("s_suppkey", F.col("s_name").alias("teacher_name"))
    j = fl.join(o, fl["l_orderkey"] == o["o_orderkey"]).join(c, F.col("o_custkey") == c["c_custkey"]) \
        .join(s, F.col("l_suppkey") == s["s_suppkey"])
    j = j.select("l_orderkey", "o_custkey", "student_name", "teacher_name", "l_shipdate", "l_returnflag")
    return minus_list(j, "o_custkey", t, min_balance=9500)


# Stand-in of the letters: an order is a lecture of its customer, paid for unless of low priority, finished unless open; the
# nation is the grade, contacts are made up from keys, advertising is allowed by customers with a positive balance.
FINISHED = ["F", "P"]
PAID = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
GRADES_OUT = ["NATION_0", "NATION_7", "NATION_13"]
LAST_GRADE = "NATION_20"
_CONTACTS = {"student": "'010-' || CAST(c_custkey AS VARCHAR)", "parent": "'011-' || CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey % 100 AS VARCHAR)"}


def _contact(who: str):
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    return F.concat(F.lit("010-"), key.cast("string")) if who == "student" else \
        F.concat(F.lit("011-"), nation, F.lit("-"), (key % 100).cast("string"))


def _letters(t, who: str, finished: bool, grades_out: list[str]):
    """One row per (student, contact, grade) with its latest change, of paid lectures of real accounts in a wanted grade."""
    state = F.col("o_orderstatus").isin(FINISHED)
    o = t.orders.filter(F.col("o_orderpriority").isin(PAID) & (state if finished else ~state)) \
        .select(F.col("o_custkey").alias("student_user_no"), "o_orderdate")
    c = t.customer.filter(~F.col("c_name").like("%1_")).select("c_custkey", "c_nationkey", _contact(who).alias("phone_number"))
    n = t.nation.filter(~F.col("n_name").isin(grades_out)).select("n_nationkey", F.col("n_name").alias("grade"))
    j = o.join(c, F.col("student_user_no") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("student_user_no", "phone_number", "grade").agg(F.max("o_orderdate").alias("max_done_time"))


def _letters_sql(who: str, finished: bool, grades_out: list[str]) -> str:
    return f"""SELECT o_custkey AS student_user_no, {_CONTACTS[who]} AS phone_number, n_name AS grade, MAX(o_orderdate) AS max_done_time
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  WHERE o_orderpriority IN {tuple(PAID)} AND o_orderstatus {'' if finished else 'NOT '}IN ('F', 'P') AND c_name NOT LIKE '%1_'
    AND n_name NOT IN {tuple(grades_out)} GROUP BY 1, 2, 3"""


def _letter_snapshot(spark, lists):
    """The lists of one run, each tagged with its source, appended to the stored snapshots."""
    schema = StructType.fromDDL("student_user_no bigint, phone_number string, grade string, updated_at timestamp_ntz, source string")
    table = BucketTable(spark, scratch_path(spark, "letters"), schema, ("student_user_no",), 8)
    for i, (source, df) in enumerate(lists):
        table.append(df.withColumn("updated_at", ts(AS_OF_ORDERS)).withColumn("source", F.lit(source)), i, lambda stored, new: new)
    return table.read()


@register("active_letter_list", "K21: D1,C3,C4,E6,I31,B3", f"""
SELECT student_user_no, phone_number, grade, TIMESTAMP '1998-09-01 00:00:00' AS updated_at, 'active_student' AS source
FROM ({_letters_sql('student', False, GRADES_OUT)})
UNION ALL SELECT student_user_no, phone_number, grade, TIMESTAMP '1998-09-01 00:00:00', 'active_parent'
FROM ({_letters_sql('parent', False, GRADES_OUT)})
""")
def q_active_letter_list(spark, t):
    """Students with a paid, unfinished lecture and their parents; one row per (student, contact, grade), both lists tagged and
    appended to the snapshots."""
    return _letter_snapshot(spark, [(f"active_{who}", _letters(t, who, False, GRADES_OUT)) for who in ("student", "parent")])


def _inactive_sql(who: str) -> str:
    out = GRADES_OUT if who == "student" else [*GRADES_OUT, LAST_GRADE]
    cut = " AND max_done_time >= TIMESTAMP '2000-08-01 00:00:00'" if who == "student" else ""
    return f"""SELECT student_user_no, phone_number, grade, TIMESTAMP '1998-09-01 00:00:00' AS updated_at, 'inactive_{who}' AS source
FROM ({_letters_sql(who, True, out)}) l JOIN customer usc ON usc.c_custkey = l.student_user_no AND usc.c_mktsegment <> 'FURNITURE'
  AND usc.c_acctbal > 0
WHERE student_user_no NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus NOT IN ('F', 'P') AND o_custkey IS NOT NULL){cut}"""


@register("inactive_letter_list", "K22: E1,D1,D15,C3,B3", _inactive_sql("student") + "\nUNION ALL\n" + _inactive_sql("parent"))
def q_inactive_letter_list(spark, t):
    """Finished students who take advertising and have no unfinished lecture, and their parents: students since a cut, parents
    without it but without the last grade. NOT IN is written as a null-filtered left anti join (a null in the list would
    otherwise empty the result)."""
    push = t.customer.filter((F.col("c_mktsegment") != "FURNITURE") & (F.col("c_acctbal") > 0)).select(F.col("c_custkey").alias("_user"))
    busy = t.orders.filter(~F.col("o_orderstatus").isin(FINISHED) & F.col("o_custkey").isNotNull()).select(F.col("o_custkey").alias("_busy"))

    def inactive(who):
        df = _letters(t, who, True, GRADES_OUT if who == "student" else [*GRADES_OUT, LAST_GRADE])
        if who == "student":
            df = df.filter(F.col("max_done_time") >= ts("2000-08-01 00:00:00"))
        return df.join(push, F.col("student_user_no") == F.col("_user"), "left_semi") \
            .join(busy, F.col("student_user_no") == F.col("_busy"), "left_anti")
    return _letter_snapshot(spark, [(f"inactive_{who}", inactive(who)) for who in ("student", "parent")])


def _sheet_dates(t):
    """A hand-kept list whose 'added' column mixes three date spellings and junk."""
    d = F.col("o_orderdate")
    raw = (F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(d, "yyyy. MM. dd"))
           .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(d, "yyyy-MM-dd"))
           .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(d, "yyyyMMdd"))
           .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.concat(F.lit(" "), F.date_format(d, "yyyy/MM/dd"),
                                                                        F.lit(" ")))
           .otherwise(F.lit("n/a")))
    return t.orders.select(F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("row_key"),
                           "o_custkey", raw.alias("added"))


_SHEET_SQL = """sheet AS (
  SELECT ' ' || CAST(o_orderkey AS VARCHAR) AS row_key, o_custkey,
         CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y. %m. %d')
              WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d')
              WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%Y%m%d')
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ' ' || strftime(o_orderdate, '%Y/%m/%d') || ' '
              ELSE 'n/a' END AS added
  FROM orders
), cleaned AS (
  SELECT *, translate(regexp_replace(added, '\\s', '', 'g'), './', '--') AS added_clean FROM sheet
), parsed AS (
  SELECT *, CAST(COALESCE(try_strptime(added_clean, '%Y-%m-%d'), try_strptime(added_clean, '%Y%m%d')) AS DATE) AS added_date
  FROM cleaned
)"""


@register("clean_dates", "I15,I16,I17", "WITH " + _SHEET_SQL + """
SELECT trim(row_key) AS row_key, added, added_clean, added_date FROM parsed
""")
def q_clean_dates(spark, t):
    """Three date spellings plus junk: normalise the text, then try two formats."""
    s = _sheet_dates(t)
    return s.select(F.trim("row_key").alias("row_key"), "added", clean_date_text(F.col("added")).alias("added_clean"),
                    parse_date_text(F.col("added")).alias("added_date"))


_PLAN_SQL = """lastpay AS (SELECT o_custkey, MAX(o_orderkey) AS max_payment_no FROM orders GROUP BY o_custkey),
plan AS (
  SELECT trim(p.row_key) AS lecture_vt_no, p.o_custkey AS student_user_no, p.added_date, s.o_orderstatus <> 'F' AS is_new,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 6
            WHEN '4-NOT SPECIFIED' THEN 12 WHEN '5-LOW' THEN 2 END AS fst_months
  FROM parsed p JOIN orders s ON s.o_orderkey = CAST(trim(p.row_key) AS BIGINT)
  JOIN lastpay lp ON lp.o_custkey = p.o_custkey JOIN orders o ON o.o_orderkey = lp.max_payment_no)"""


@register("new_pause_plan_months", "K6: A10,A11,E13,D1,D25,I15,I16,C2,C14,B2", "WITH " + _SHEET_SQL + ", " + _PLAN_SQL + f"""
SELECT 'new_lecture' AS list, lecture_vt_no, student_user_no, added_date AS day, fst_months, CAST(NULL AS VARCHAR) AS grade
FROM plan WHERE is_new AND added_date IN (DATE '{YESTERDAY}' - 1, DATE '{YESTERDAY}')
UNION ALL
SELECT 'pause_lecture', lecture_vt_no, student_user_no, added_date, fst_months, NULL
FROM plan WHERE NOT is_new AND added_date IN (DATE '{YESTERDAY}' - 1, DATE '{YESTERDAY}')
""")
def q_new_pause_plan_months(spark, t):
    """The runs of two days over the lists of new and of paused lectures, kept as CSV: the day's rows (dates in mixed spellings),
    plan months of the lecture's latest payment, reindexed to the log's columns and appended to their tables."""
    sheet = _sheet_dates(t)
    state = t.orders.select(F.col("o_orderkey").cast("string").alias("_key"), "o_orderstatus")
    sheet = materialize(sheet.join(state, F.trim("row_key") == F.col("_key")).drop("_key"), "sheets")
    lastpay = t.orders.groupBy(F.col("o_custkey").alias("lp_cust")).agg(F.max("o_orderkey").alias("max_payment_no"))
    months = None
    for k, v in COHORT_OF_PRIORITY.items():
        c = F.col("o_orderpriority") == k
        months = F.when(c, F.lit(v)) if months is None else months.when(c, F.lit(v))
    paid = materialize(lastpay.join(t.orders, F.col("max_payment_no") == F.col("o_orderkey")).select("lp_cust", months.alias("fst_months")), "plans")
    out = None
    for name, day_col, rows in (("new_lecture", "start_date", sheet.filter("o_orderstatus <> 'F'")),
                                ("pause_lecture", "end_date", sheet.filter("o_orderstatus = 'F'"))):
        path = scratch_path(spark, name)
        write_csv_snapshot(rows.select("row_key", "o_custkey", "added"), path)
        listed = read_csv_worklist(spark, path).withColumn("_day", parse_date_text(F.col("added")))
        schema = StructType.fromDDL(f"lecture_vt_no string, student_user_no bigint, {day_col} date, fst_months int, grade string")
        table = BucketTable(spark, scratch_path(spark, f"{name}_table"), schema, ("lecture_vt_no",), 8)
        for run in (1, 0):
            day = listed.filter(F.col("_day") == F.date_sub(F.lit(YESTERDAY).cast("date"), run))
            day = day.withColumn("_cust", int_key(F.col("o_custkey"))).join(paid, F.col("_cust") == F.col("lp_cust"))
            day = day.withColumnsRenamed({"row_key": "lecture_vt_no", "_cust": "student_user_no", "_day": day_col})
            table.append(conform(day, schema), 1 - run, lambda stored, new: new)
        got = table.read().withColumnRenamed(day_col, "day").withColumn("list", F.lit(name))
        out = got if out is None else out.unionByName(got)
    return out


@register("clean_strings", "I29,I30,I12", """
SELECT c_custkey, trim(replace('  ' || c_name || chr(0) || ' ', chr(0), '')) AS name_clean,
       rtrim(c_mktsegment || '   ') AS segment_clean
FROM customer
""")
def q_clean_strings(spark, t):
    """NUL characters removed and outer blanks stripped in every string column."""
    from episodic.functions.cleaning import map_strings, strip_nul, trim_all
    dirty = t.customer.select("c_custkey",
                              F.concat(F.lit("  "), F.col("c_name"), F.lit("\u0000"), F.lit(" ")).alias("name_clean"),
                              F.concat(F.col("c_mktsegment"), F.lit("   ")).alias("segment_clean"))
    return trim_all(map_strings(dirty, strip_nul))


@register("stringify", "I28", """
WITH v AS (
  SELECT o_orderkey,
         CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN 'nan' ELSE CAST(o_orderkey AS VARCHAR) END AS v1,
         CASE WHEN o_orderpriority = '5-LOW' THEN '<NA>' ELSE o_orderpriority END AS v2,
         CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS v3
  FROM orders
)
SELECT o_orderkey,
       CASE WHEN COALESCE(v1, '') IN ('NaT', 'nan', 'NaN', 'None', '<NA>', 'inf', '-inf') THEN '' ELSE COALESCE(v1, '') END AS s1,
       CASE WHEN COALESCE(v2, '') IN ('NaT', 'nan', 'NaN', 'None', '<NA>', 'inf', '-inf') THEN '' ELSE COALESCE(v2, '') END AS s2,
       CASE WHEN v3 IS NULL THEN '' ELSE 'x' END AS s3
FROM v
""")
def q_stringify(spark, t):
    """Everything as text for a sheet; nulls and null-like tokens become ''."""
    from episodic.functions.cleaning import stringify
    o = t.orders
    v1 = F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string")) \
        .when(F.col("o_orderstatus") == "O", F.lit("nan")).otherwise(F.col("o_orderkey").cast("string"))
    v2 = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("<NA>")).otherwise(F.col("o_orderpriority"))
    v3 = F.when(F.col("o_orderstatus") == "F", F.lit(None).cast("double")).otherwise(F.col("o_totalprice"))
    return o.select("o_orderkey", stringify(v1).alias("s1"), stringify(v2).alias("s2"),
                    F.when(stringify(v3) == "", "").otherwise("x").alias("s3"))
