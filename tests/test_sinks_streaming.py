"""Sinks (versions, typed contract, work lists), the retrain guard, and streaming re-runs."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from conftest import rows
from episodic.operators.buckets import COMPACT, BucketTable
from episodic.operators.contracts import Contract, ContractError
from episodic.operators.incremental import upsert
from episodic.operators.ledger import NoSuccessfulRun, RunLedger
from episodic.operators.sinks import conform, read_latest, versions, write_version
from episodic.operators.survival import activate_version, should_retrain
from episodic.operators.worklists import append_list, blank_cells, replace_list
from episodic.session import scratch_path
from episodic.streaming.jobs import changes, mirror, run_once

SCHEMA = StructType([StructField("k", LongType()), StructField("v", StringType())])


def test_versions_and_read_latest(spark):
    root = scratch_path(spark, "t-versions")
    assert rows(read_latest(spark, root, SCHEMA)) == []
    write_version(spark.createDataFrame([(1, "a")], SCHEMA), root, 0)
    write_version(spark.createDataFrame([(1, "b"), (2, "c")], SCHEMA), root, 1)
    write_version(spark.createDataFrame([(9, "z")], SCHEMA), root, 1)  # a replayed batch overwrites itself
    assert versions(spark, root) == [0, 1]
    assert rows(read_latest(spark, root, SCHEMA)) == [(9, "z")]
    assert rows(read_latest(spark, root, SCHEMA, below=1)) == [(1, "a")]


def test_conform_contract(spark):
    df = spark.createDataFrame([("5", "x", 1.5)], "k string, extra string, w double")
    out = conform(df, StructType([StructField("k", LongType()), StructField("missing", StringType()),
                                  StructField("w", StringType())]))
    assert out.columns == ["k", "missing", "w"]
    assert out.collect()[0] == (5, None, "1.5")


def test_worklist_replace_append_blank(spark):
    schema = StructType([StructField("row_key", StringType()), StructField("added_by", StringType())])
    table = BucketTable(spark, scratch_path(spark, "t-list"), schema, ("row_key",), buckets=8)
    replace_list(table, spark.createDataFrame([("1", "r0"), ("2", "r0")], schema))
    new = spark.createDataFrame([(" 2 ",), ("3",)], "row_key string")
    append_list(table, new, "r1")
    assert rows(table.read()) == [("1", "r0"), ("2", "r0"), ("3", "r1")]
    replace_list(table, spark.createDataFrame([("7", "r2")], schema))  # no stale tail rows
    assert rows(table.read()) == [("7", "r2")]
    cells = spark.createDataFrame([("a", ""), ("b", None), ("c", "x")], "k string, v string")
    assert rows(blank_cells(cells, ["v"]), "k") == [("a",), ("b",)]


def test_retrain_guard_and_version_upsert(spark):
    vschema = ("fit_window_start date, fit_window_end date, time_unit string, horizon_weeks int, status string, "
               "created_at timestamp_ntz, created_by string, notes string")
    fs, fe = date(2024, 1, 1), date(2024, 12, 29)
    versions_df = spark.createDataFrame([(fs, fe, "week", 52, "inactive", datetime(2024, 1, 1), "x", "")], vschema)
    models = spark.createDataFrame([(fs, fe, "week", 1, 0, 1.0, 0.0, 0.0)],
                                   "fit_window_start date, fit_window_end date, time_unit string, cohort_months int, "
                                   "time_k int, s double, q double, h double")
    assert should_retrain(versions_df, models, fs, fe)            # curve exists but no active version
    upd = activate_version(versions_df, fs, fe, 52, datetime(2025, 1, 1), "job", "retrain")
    assert [r.status for r in upd.collect()] == ["active"]
    assert not should_retrain(upd, models, fs, fe)                # both exist: skip
    assert should_retrain(upd, models.limit(0), fs, fe)           # no curve: retrain


def test_stream_mirror_rerun_is_idempotent(spark):
    root = scratch_path(spark, "t-stream")
    schema = StructType([StructField("k", LongType()), StructField("ts", LongType()), StructField("v", StringType())])
    order = [F.col("ts").desc()]
    target = BucketTable(spark, f"{root}/target", schema, ("k",), buckets=8)
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], schema).write.mode("append").parquet(f"{root}/inbox")

    def start():
        return mirror(spark, f"{root}/inbox", target, order, f"{root}/_ckpt")
    run_once(start())
    spark.createDataFrame([(1, 5, "a2"), (2, 0, "late")], schema).write.mode("append").parquet(f"{root}/inbox")
    run_once(start())
    first = rows(target.read())
    run_once(start())  # nothing new: no new batch, same table
    assert rows(target.read()) == first == [(1, 5, "a2"), (2, 1, "b")]


# ---------------------------------------------------------------- bucketed tables

def _files(spark, version):
    """Data files named by a version's manifest."""
    return {f for folders in version.folders.values() for f in folders}


def test_a_batch_rewrites_only_its_buckets(spark):
    table = BucketTable(spark, scratch_path(spark, "t-buckets"), SCHEMA, ("k",), buckets=16)
    assert rows(table.read()) == [] and table.manifest() is None
    first = table.replace(spark.createDataFrame([(i, "old") for i in range(200)], SCHEMA), 0)
    assert len(first.folders) == 16
    one = spark.createDataFrame([(5, "new")], SCHEMA)
    second = table.merge(one, 1, lambda stored, new: upsert(stored, new, ["k"]))
    assert len(second.written) == 1 and len(_files(spark, second) - _files(spark, first)) == 1
    assert len(_files(spark, second) & _files(spark, first)) == 15
    want = sorted([(i, "old") for i in range(200) if i != 5] + [(5, "new")])
    assert rows(table.read()) == want
    assert rows(table.read(below=1)) == [(i, "old") for i in range(200)]      # an older version is undisturbed
    # a replayed batch starts below its own version and gives an equal one
    again = table.merge(one, 1, lambda stored, new: upsert(stored, new, ["k"]))
    assert again.written == second.written and rows(table.read()) == want and table.versions() == [0, 1]
    # nothing to write: no new version
    table.merge(one.limit(0), 2, lambda stored, new: upsert(stored, new, ["k"]))
    assert table.versions() == [0, 1]
    # a bucket that loses its last row leaves the manifest
    table.merge(spark.createDataFrame([(i, "x") for i in range(200)], SCHEMA), 2, lambda stored, new: stored.where("k >= 1000"))
    assert table.manifest().folders == {} and rows(table.read()) == []


def test_append_rewrites_nothing_until_a_bucket_has_many_folders(spark):
    table = BucketTable(spark, scratch_path(spark, "t-append"), SCHEMA, ("k",), buckets=1)
    fresh = lambda stored, new: new.join(stored, "k", "left_anti")
    for i in range(COMPACT):
        v = table.append(spark.createDataFrame([(i, "a"), (0, "again")] if i else [(0, "a")], SCHEMA), i, fresh)
        assert len(v.folders[0]) == i + 1
    v = table.append(spark.createDataFrame([(99, "a")], SCHEMA), COMPACT, fresh)
    assert len(v.folders[0]) == 1
    assert rows(table.read()) == [(i, "a") for i in range(COMPACT)] + [(99, "a")]


# ---------------------------------------------------------------- checked commit

def test_a_bad_batch_leaves_the_old_version_and_reports_counts(spark):
    contract = Contract(StructType([StructField("k", LongType()), StructField("v", StringType()), StructField("n", LongType()),
                                    StructField("note", StringType())]),
                        key=("k",), not_null=("v",), checks={"n_positive": "n > 0", "v_known": "v IN ('a', 'b')"},
                        defaults={"n": "1"})
    table = BucketTable(spark, scratch_path(spark, "t-contract"), contract.schema, ("k",), 4, contract)
    good = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], SCHEMA)          # n and note are missing columns
    version = table.replace(good, 0)
    assert version.rules["rows"] == 3 and not any(v for k, v in version.rules.items() if k != "rows")
    want = [(1, "a", 1, None), (2, "b", 1, None), (3, "a", 1, None)]
    assert rows(table.read()) == want
    bad = spark.createDataFrame([(1, "a", 5), (None, "b", 5), (7, None, None), (8, "c", 0), (8, "a", 1), (9, "a", -1)],
                                "k long, v string, n long")
    with pytest.raises(ContractError) as e:
        table.merge(bad, 1, lambda stored, new: stored.unionByName(new))
    assert {k: v for k, v in e.value.counts.items() if v and k != "rows"} == {
        "not_null(k)": 1, "not_null(v)": 1, "check(n_positive)": 2, "check(v_known)": 1, "unique(k)": 2}
    assert table.versions() == [0] and rows(table.read()) == want
    table.merge(spark.createDataFrame([(1, "b", 5)], "k long, v string, n long"), 1, lambda stored, new: upsert(stored, new, ["k"]))
    assert rows(table.read())[0] == (1, "b", 5, None)


# ---------------------------------------------------------------- run ledger

def test_a_failed_run_loses_no_row_and_repeats_none(spark):
    ledger, read = RunLedger(spark, scratch_path(spark, "t-ledger")), []
    day = [datetime(2024, 1, d) for d in range(1, 8)]

    def body(start, end):
        if len(read) == 1 and not failed:
            failed.append((start, end))
            raise RuntimeError("lost its source")
        read.append((start, end))

    failed = []
    with pytest.raises(NoSuccessfulRun):
        ledger.run("job", "r0", day[1], body)
    ledger.record("other", "s", None, day[5], "success")
    ledger.record("job", "seed", None, day[0], "success")
    ledger.run("job", "r1", day[1], body)
    with pytest.raises(RuntimeError):
        ledger.run("job", "r2", day[2], body)
    ledger.run("job", "r3", day[3], body)
    assert failed == [(day[1], day[2])] and read == [(day[0], day[1]), (day[1], day[3])]
    states = {r["run_id"]: r["state"] for r in ledger.runs().collect()}
    assert states == {"s": "success", "seed": "success", "r1": "success", "r2": "failed", "r3": "success"}
    # a rerun of an earlier interval looks at successes before it only
    assert ledger.last_success("job", day[2]) == day[1]


# ---------------------------------------------------------------- keyed state

def test_stream_changes_equal_batch_and_resume(spark):
    root = scratch_path(spark, "t-changes")
    schema = "k long, ts long, s string"
    batches = [[(1, 1, "a"), (1, 2, "b"), (2, 1, "x"), (3, 1, None), (None, 1, "n")],
               [(1, 3, "b"), (2, 2, "y"), (3, 2, None), (4, None, "old"), (4, 1, "new")],
               [(1, 4, "c"), (2, 3, "y"), (3, 3, "z"), (1, 0, "late")]]
    want, kept = [], {}
    for i, b in enumerate(batches):
        now = {}
        for k, t, s in sorted(b, key=lambda r: r[1] or 0):
            now[k] = s
        for k, s in now.items():
            if k not in kept or kept[k] != s:
                want.append((k, s, i))
            kept[k] = s
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(f"{root}/inbox")
        for _ in range(2):                       # the second run starts from the checkpoint and finds nothing new
            run_once(changes(spark, f"{root}/inbox", spark.createDataFrame([], schema).schema, "k", "s", ["ts"],
                             f"{root}/history", f"{root}/_ckpt"))
    got = spark.read.parquet(f"{root}/history")
    assert rows(got, "k", "s", "batch_id") == sorted(want, key=lambda t: tuple((x is not None, x) for x in t))
