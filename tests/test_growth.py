"""Work that grows with the input: how often a table is read, how often a function of a stream is called, what a plan sorts."""

from datetime import datetime as T
from types import SimpleNamespace

from pyspark.sql import functions as F

from conftest import rows


def counted(df, seen):
    """``df`` whose rows are counted whenever they are read."""
    @F.udf("boolean")
    def see(_):
        seen.add(1)
        return True
    return df.filter(see.asNondeterministic()(F.lit(0)))


def test_first_lecture_list_ranks_sessions_once(spark):
    """The first match is found once for both runs; ties, a repeated order and null keys included."""
    from episodic.plans.targets import q_first_lecture_list
    orders = spark.createDataFrame(
        [(1, 10, T(1995, 2, 1)), (2, 10, T(1997, 2, 1)), (2, 10, T(1997, 2, 1)), (3, 11, T(1995, 3, 1)), (4, None, T(1996, 1, 1)),
         (None, 10, T(1996, 1, 1))], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")
    line = [(1, 7, 1, 5, 2.0, T(1995, 3, 1)), (1, 8, 1, 4, 1.0, T(1995, 3, 1)), (2, 7, 1, 5, 1.0, T(1997, 3, 1)), (2, 7, 2, 5, 1.0, T(1997, 4, 1)),
            (2, 8, 1, 5, 1.0, T(1997, 5, 1)), (3, 9, 1, 5, 1.0, T(1995, 4, 1)), (4, 7, 1, 5, 1.0, T(1996, 4, 1)), (None, 8, 1, 5, 1.0, T(1990, 4, 1)),
            (1, 7, 1, 5, 2.0, T(1995, 3, 1))]
    lineitem = spark.createDataFrame(
        line, "l_orderkey long, l_suppkey long, l_linenumber int, l_partkey long, l_quantity double, l_shipdate timestamp_ntz")
    supplier = spark.createDataFrame([(7, "t7", 1.0), (8, "t8", 1.0), (9, "t9", -1.0)], "s_suppkey long, s_name string, s_acctbal double")
    customer = spark.createDataFrame([(10, "c10")], "c_custkey long, c_name string")
    seen = spark.sparkContext.accumulator(0)
    got = q_first_lecture_list(spark, SimpleNamespace(orders=orders, lineitem=counted(lineitem, seen), supplier=supplier, customer=customer))
    assert rows(got, "lecture_vt_no", "teacher_user_no", "teacher_name", "student_name", "room_id", "tutoring_datetime", "rn") == [
        (10, 7, "t7", "c10", "room-1", T(1995, 3, 1), 1), (10, 7, "t7", "c10", "room-2", T(1997, 4, 1), 2)]
    # one ranking and one read of each run's interval
    assert seen.value == 3 * len(line)


def test_stream_changes_keep_state_by_bucket(spark):
    """More keys than buckets: the state store holds at most one row a bucket, and every key keeps a state of its own, also
    beside a null key and beyond what a double holds."""
    from episodic.session import scratch_path
    from episodic.streaming.jobs import changes, run_once
    root, big, n = scratch_path(spark, "t-buckets"), 2 ** 53, 3000
    schema = spark.createDataFrame([], "k long, ts long, s string").schema
    first = [(big + i, 1, "a" if i % 2 else None) for i in range(n)] + [(None, None, "n")]
    second = [(big + i, 2, "a") for i in range(n)] + [(None, None, "n")]
    for batch in (first, second):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{root}/inbox")
        q = changes(spark, f"{root}/inbox", schema, "k", "s", ["ts"], f"{root}/history", f"{root}/_ckpt")
        run_once(q)
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 1024
    got = spark.read.parquet(f"{root}/history")
    want = [(k, s, 0) for k, _, s in first] + [(big + i, "a", 1) for i in range(0, n, 2)]
    assert rows(got, "k", "s", "batch_id") == sorted(want, key=lambda t: tuple((x is not None, x) for x in t))


def _below(plan, node):
    """Of every ``node`` in a plan's text, the lines below it."""
    lines = plan.splitlines()
    depth = [min((line.find(m) for m in (":- ", "+- ") if m in line), default=0) for line in lines]
    for i, line in enumerate(lines):
        if node in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            yield "\n".join(lines[i + 1:end])


def test_asof_join_sorts_points_for_the_fill_only(spark):
    """The last interval of a chunk is found among the intervals: no aggregate of structs sorts the points."""
    from episodic.operators.intervals import asof_join
    iv = spark.createDataFrame([(1, 5, T(2024, 1, 1), T(2024, 3, 1)), (2, 5, T(2024, 3, 1), T(2025, 1, 1)), (3, None, T(2024, 1, 1), T(2025, 1, 1))],
                               "iid long, ik int, s timestamp_ntz, e timestamp_ntz")
    pts = spark.createDataFrame([(i, 5, T(2024, m, 1)) for i, m in enumerate((1, 2, 3, 7))] + [(9, 6, T(2024, 2, 1)), (8, None, T(2024, 2, 1))],
                                "pid long, pk long, at timestamp_ntz")
    got = asof_join(iv, pts, [("ik", "pk")], "s", "e", "at", tie=["iid"], chunk_unit="month")
    assert got.dtypes == iv.dtypes + pts.dtypes
    assert rows(got, "pid", "iid", "ik", "pk") == [(0, 1, 5, 5), (1, 1, 5, 5), (2, 2, 5, 5), (3, 2, 5, 5)]
    plan = got._jdf.queryExecution().sparkPlan().toString()
    below = list(_below(plan, "SortAggregate"))
    assert below and not any("pid#" in b for b in below)
