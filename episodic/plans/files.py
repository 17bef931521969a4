"""File round trips and text lookups."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from episodic.operators.sinks import conform, save_in_schema
from episodic.sources.files import read_csv_worklist, write_csv_snapshot
from episodic.session import scratch_path
from episodic.plans.registry import register

LIST_SCHEMA = StructType([StructField("c_custkey", LongType()), StructField("c_name", StringType()),
                          StructField("c_acctbal", DoubleType()), StructField("c_mktsegment", StringType()),
                          StructField("contact", StringType())])


@register("csv_round_trip", "A10,A11,B5,C2,C14", """
SELECT c_custkey, c_name, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS contact FROM customer
""")
def q_csv_round_trip(spark, t):
    """Snapshot to CSV (published column list, padded text), read back trimmed and typed,
    reindexed to the list contract (missing column -> null, extra dropped)."""
    path = scratch_path(spark, "csv_round_trip")
    snap = t.customer.select("c_custkey", F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("c_name"),
                             "c_acctbal", "c_mktsegment", "c_nationkey")
    write_csv_snapshot(snap, path, columns=["c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey"])
    back = read_csv_worklist(spark, path)
    return conform(back, LIST_SCHEMA)


@register("ticket_latest", "F10,I11", """
SELECT conv_id, prefix, turn, role FROM (
  SELECT conv_id, substr(text, 1, 3) AS prefix, turn, role,
         ROW_NUMBER() OVER (PARTITION BY conv_id, substr(text, 1, 3) ORDER BY turn DESC) AS rn
  FROM conversations) x
WHERE rn = 1
""")
def q_ticket_latest(spark, t):
    """Latest turn per (conversation, 3-character prefix of its text)."""
    c = t.conversations.select("conv_id", F.substring("text", 1, 3).alias("prefix"), "turn", "role")
    w = Window.partitionBy("conv_id", "prefix").orderBy(F.col("turn").desc())
    return c.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") == 1).drop("rn")


@register("worklist_append", "B20,B2,B7,D17", """
SELECT CAST(c_custkey AS VARCHAR) AS row_key, c_name, 'run-0' AS added_by FROM customer WHERE c_acctbal > 5000
UNION ALL
SELECT CAST(c.c_custkey AS VARCHAR), c.c_name, 'run-1' FROM customer c
WHERE c.c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') AND c.c_acctbal <= 5000
""")
def q_worklist_append(spark, t):
    """A list written in full once, then a second run appends only the rows not on it yet."""
    from episodic.operators.worklists import append_list, replace_list
    from episodic.operators.buckets import BucketTable
    schema = StructType([StructField("row_key", StringType()), StructField("c_name", StringType()),
                         StructField("added_by", StringType())])
    table = BucketTable(spark, scratch_path(spark, "worklist"), schema, ("row_key",), buckets=16)
    c = t.customer
    first = c.filter(F.col("c_acctbal") > 5000).select(F.col("c_custkey").cast("string").alias("row_key"),
                                                       "c_name", F.lit("run-0").alias("added_by"))
    replace_list(table, first)
    open_o = t.orders.filter(F.col("o_orderstatus") == "O").select("o_custkey")
    cand = c.join(open_o, c["c_custkey"] == open_o["o_custkey"], "left_semi") \
        .select(F.concat(F.lit(" "), F.col("c_custkey").cast("string")).alias("row_key"), "c_name")
    append_list(table, cand, "run-1")
    return table.read()


DOC_SCHEMA = StructType([StructField("doc_id", StringType()), StructField("status", StringType()),
                         StructField("lectures", StringType()), StructField("memo", StringType()),
                         StructField("itemmonth", LongType()), StructField("matchedat", StringType())])


@register("typed_sink_round_trip", "B4,B15,B1,I29", """
SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, o_orderstatus AS status,
       to_json({'id': o_custkey, 'grade': o_orderpriority}) AS lectures,
       CAST(NULL AS VARCHAR) AS memo, CAST(o_orderkey % 12 + 1 AS BIGINT) AS itemmonth,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS matchedat
FROM orders
""")
def q_typed_sink_round_trip(spark, t):
    """A nested document written through a typed contract: NUL stripped from strings, the struct as
    JSON text, a missing column as a typed null, values cast per column; read back from the table."""
    from episodic.functions.cleaning import map_strings, strip_nul
    from episodic.operators.sinks import read_latest, write_version
    docs = t.orders.select(
        F.col("o_orderkey").cast("string").alias("doc_id"),
        F.concat(F.col("o_orderstatus"), F.lit("\u0000")).alias("status"),
        F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("grade")).alias("lectures"),
        (F.col("o_orderkey") % 12 + 1).cast("int").alias("itemmonth"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("matchedat"))
    docs = map_strings(docs, strip_nul).withColumn("lectures", F.to_json("lectures"))
    root = scratch_path(spark, "matching")
    write_version(conform(docs, DOC_SCHEMA), root, 0)
    return read_latest(spark, root, DOC_SCHEMA)


@register("schema_write", "B19,B1", """
SELECT n_nationkey, n_name, 'public' AS written_to FROM nation
UNION ALL SELECT r_regionkey, r_name, 'kpis' FROM region
""")
def q_schema_write(spark, t):
    """Two tables written under their schema (the default one and a named one) and read back by qualified name."""
    a = save_in_schema(t.nation.select("n_nationkey", "n_name"), "nation_names")
    b = save_in_schema(t.region.select("r_regionkey", "r_name"), "region_names", schema="kpis")
    return spark.table(a).withColumn("written_to", F.lit("public")) \
        .union(spark.table(b).withColumn("written_to", F.lit("kpis")))
