"""Streams by name, declared tables, swaps, keys, JSON, month ranges, and the fill-down's plan."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from hearth.operators import bounded, extend_keys, fill_down, latest_month_slice, month_bounds, months_between, newer_months
from hearth.quality import NotConforming, conformance_report, read_ledger, require_conformance
from hearth.sinks import create_declared, delete_period, drop_declared, read_table, recover_swap, replace_declared, write_replace
from hearth.sources import flatten_json, malformed_json, read_delimited_raw, read_json_documents
from tests.test_landed_rows import put


def test_stream_takes_columns_by_name_and_counts_what_it_leaves(spark, tmpdir_path):
    from hearth.streaming import incremental_load, landed_csv_stream
    put(f"{tmpdir_path}/in/a.csv", "m,v,x\n202401,1,q\n,9,q\n")
    put(f"{tmpdir_path}/in/b.csv", "﻿ m ,x,v\n202401,r,2\n")

    def load(checkpoint):
        incremental_load(landed_csv_stream(spark, f"{tmpdir_path}/in", ["m", "v", "x", "absent"]), lambda b: b, f"{tmpdir_path}/T", "m",
                         checkpoint, ledger_path=f"{tmpdir_path}/L", table="T").awaitTermination(120)
    load(f"{tmpdir_path}/c")
    want = [(202401, "1", "q", None), (202401, "2", "r", None)]
    got = lambda: sorted((r.m, r.v, r.x, r.absent) for r in read_table(spark, f"{tmpdir_path}/T").collect())
    assert got() == want
    load(f"{tmpdir_path}/other")  # the same batch again, as after a lost checkpoint: replaced, not doubled
    assert got() == want
    ledger = [(r.table_name, r.run_id, r.step, r.rows_read, r.rows_loaded, r.rows_quarantined) for r in read_ledger(spark, f"{tmpdir_path}/L").collect()]
    assert ledger == [("T", "stream", "batch-00000000", 3, 2, 1)]


@pytest.mark.parametrize("cap", [None, 1])
def test_a_delivery_that_lands_again_replaces_itself(spark, tmpdir_path, cap):
    from hearth.streaming import incremental_load, landed_csv_stream

    def load():
        stream = landed_csv_stream(spark, f"{tmpdir_path}/in", max_files_per_trigger=cap)
        incremental_load(stream, lambda b: b, f"{tmpdir_path}/T", "m", f"{tmpdir_path}/c", delivery=r"/(day\d+)").awaitTermination(120)
    put(f"{tmpdir_path}/in/day1-v1.csv", "m,v\n202401,1\n202402,2\n")
    put(f"{tmpdir_path}/in/day2-v1.csv", "m,v\n202401,3\n")
    os.utime(f"{tmpdir_path}/in/day1-v1.csv", (1, 1))
    load()
    put(f"{tmpdir_path}/in/day1-v2.csv", "v,m\n5,202401\n")  # corrected: another value, and 202402 is gone
    load()
    assert sorted((r.m, int(r.v), r.load_delivery) for r in read_table(spark, f"{tmpdir_path}/T").collect()) == [
        (202401, 3, "day2"), (202401, 5, "day1")]


def test_folder_columns_are_read_either_way(spark, tmpdir_path):
    put(f"{tmpdir_path}/same/k=1/a.csv", "id,x\n1,a\n")
    put(f"{tmpdir_path}/same/k=2/a.csv", "id,x\n2,b\n")
    put(f"{tmpdir_path}/other/k=1/a.csv", "id,x\n1,\"a, b\"\n\n")
    put(f"{tmpdir_path}/other/k=2/a.csv", "y,id\nc,2\n")
    same = read_delimited_raw(spark, f"{tmpdir_path}/same")
    assert sorted((r.id, r.x, r.k) for r in same.collect()) == [("1", "a", 1), ("2", "b", 2)]
    other = read_delimited_raw(spark, f"{tmpdir_path}/other")
    assert sorted((r.id, r.x, r.y, r.k) for r in other.collect()) == [("1", "a, b", None, 1), ("2", None, "c", 2)]


def test_declared_table_refuses_and_swaps(spark, tmpdir_path):
    layout = [("k", "int"), ("name", "varchar(3)")]
    name = "t_declared_test"
    drop_declared(spark, name)
    rows = lambda *r: spark.createDataFrame(list(r), "k string, name string")
    create_declared(spark, name, layout, f"{tmpdir_path}/t")
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        create_declared(spark, name, layout, f"{tmpdir_path}/t")
    replace_declared(spark, rows(("1", "abc"), ("x", None)), name, layout, f"{tmpdir_path}/t")
    assert sorted(map(tuple, spark.table(name).collect()), key=str) == [(1, "abc"), (None, None)]
    with pytest.raises(NotConforming, match="name: length"):
        replace_declared(spark, rows(("2", "abcd")), name, layout, f"{tmpdir_path}/t")
    assert spark.table(name).count() == 2  # the old table is still there
    assert drop_declared(spark, name) and not drop_declared(spark, name)


def test_conformance(spark):
    df = spark.createDataFrame([(1, "abc", 1.5)], "a int, b string, extra double")
    layout = [("a", "int"), ("b", "varchar(2)"), ("c", "date")]
    got = {r.column_name: (r.status, r.max_length, r.rows_over) for r in conformance_report(df, layout).collect()}
    assert got == {"a": ("ok", None, None), "b": ("length", 3, 1), "c": ("missing", None, None), "extra": ("undeclared", None, None)}
    assert require_conformance(df, [("a", "int"), ("b", "varchar(3)")]) is df
    with pytest.raises(NotConforming, match="extra: undeclared"):
        require_conformance(df, [("a", "int"), ("b", "string")], allow_extra=False)
    assert [r.status for r in conformance_report(df.limit(0), [("b", "varchar(2)")]).collect()][0] == "ok"


def test_delete_period_and_an_interrupted_swap(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    write_replace(spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 2, 1), 2), (None, 3)], "p date, v int"), path)
    assert not delete_period(spark, path, "p", dt.date(2030, 1, 1))
    assert delete_period(spark, path, "p", dt.date(2024, 1, 1))
    assert sorted(r.v for r in read_table(spark, path).collect()) == [2, 3]
    assert delete_period(spark, path, "p", None)
    os.rename(path, f"{path}__old_dead")  # a job died between its two renames
    assert [r.v for r in read_table(spark, path).collect()] == [2]
    assert not recover_swap(spark, path) and not delete_period(spark, f"{tmpdir_path}/none", "p", 1)
    stamped = f"{tmpdir_path}/s"
    at = dt.datetime(2024, 1, 1, 6, 30)
    write_replace(spark.createDataFrame([(at, 1), (None, 2)], "p timestamp_ntz, v int"), stamped, ["p"])
    assert delete_period(spark, stamped, "p", at) and [r.v for r in read_table(spark, stamped).collect()] == [2]
    with pytest.raises(ValueError, match="no column"):
        delete_period(spark, path, "q", 1)


def test_keys_never_change(spark):
    labels = lambda *x: spark.createDataFrame([(v,) for v in x], "label string")
    first = extend_keys(labels("m", "c", None, "c"), "label", None)
    assert sorted(map(tuple, first.collect())) == [("c", 0), ("m", 1)]
    more = extend_keys(labels("a", "m", "z", None), "label", first)
    assert sorted(map(tuple, more.collect())) == [("a", 2), ("z", 3)]
    assert extend_keys(labels("m"), "label", first).count() == 0


def test_json_paths_and_what_is_no_json(spark, tmpdir_path):
    put(f"{tmpdir_path}/j/a.json", '{"a": {"b": [1, {"c": null}, []], "d": "{}"}, "e": true,\n "f": {}}')
    put(f"{tmpdir_path}/j/b.json", '{"a": ')
    landed = read_json_documents(spark, f"{tmpdir_path}/j")
    assert [r.text for r in malformed_json(landed).collect()] == ['{"a": ']
    assert sorted(map(tuple, flatten_json(landed, "document").collect())) == [
        ("$.a.b[0]", "1"), ("$.a.b[1].c", None), ("$.a.b[2]", "[]"), ("$.a.d", "{}"), ("$.e", "true"), ("$.f", "{}")]
    with pytest.raises(ValueError, match="deeper"):
        flatten_json(landed, "document", max_depth=2)


def test_month_ranges_reach_the_scan(spark, tmpdir_path):
    assert month_bounds(202412) == (dt.date(2024, 12, 1), dt.date(2025, 1, 1))
    with pytest.raises(ValueError):
        month_bounds(202413)
    days = spark.range(800).select(F.date_add(F.lit("2023-01-15").cast("date"), F.col("id").cast("int")).alias("d"))
    days.select("d", F.col("d").cast("timestamp_ntz").alias("t")).write.parquet(f"{tmpdir_path}/t")
    df = spark.read.parquet(f"{tmpdir_path}/t")
    month = F.year("d") * 100 + F.month("d")
    for c in ("d", "t"):
        assert months_between(df, c, 202312, 202402).count() == df.where(month.between(202312, 202402)).count()
        assert newer_months(df, c, 202406).count() == df.where(month > 202406).count()
        last = latest_month_slice(df, c)
        assert last.count() == df.where(month == 202503).count() == 24
        plan = last._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThanOrEqual({c},2025-03-01" in plan and f"LessThan({c},2025-04-01" in plan and plan.count("FileScan") == 1
    assert newer_months(df, "d", None) is df and latest_month_slice(df.limit(0), "d").count() == 0


def test_fill_down_counts_keys_first(spark, tmpdir_path, monkeypatch):
    """Small keys are filled by the plain window; a hot key leaves one carry for each bucket."""
    from hearth.operators import filldown
    staged, stage = {}, filldown.stage
    monkeypatch.setattr(filldown, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    rng = random.Random(3)
    small = [(f"k{i % 900}", i, None if rng.random() < 0.8 else str(i)) for i in range(9000)]
    hot = [(rng.choice(["hot", None]), i, None if rng.random() < 0.999 else str(i)) for i in range(9000, 15000)]
    spark.createDataFrame(small + hot, "k string, n long, v string").repartition(4).write.parquet(f"{tmpdir_path}/t")
    df = spark.read.parquet(f"{tmpdir_path}/t")
    expected, last = {}, {}
    for k, n, v in sorted(small + hot, key=lambda r: r[1]):
        last[k] = v if v is not None else last.get(k)
        expected[n] = last[k]
    out = fill_down(df, ["v"], "n", ["k"], max_rows=200)
    assert {r.n: r.v for r in out.collect()} == expected
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count(f"{tmpdir_path}/t") == 1  # the data is scanned once; keys and carries are staged
    assert 0 < staged["fill_carries"].count() <= 0.05 * len(expected) and staged["hot_keys"].count() == 2
    monkeypatch.undo()
    calm = fill_down(df.where("k <> 'hot'"), ["v"], "n", ["k"], max_rows=200)
    assert "Join" not in calm._jdf.queryExecution().executedPlan().toString()
    whole = fill_down(df, ["v"], "n", max_rows=500)
    last, by_n = None, {}
    for k, n, v in sorted(small + hot, key=lambda r: r[1]):
        last = v if v is not None else last
        by_n[n] = last
    assert {r.n: r.v for r in whole.collect()} == by_n


def test_broadcasts_are_bounded_by_bytes(spark):
    wide = spark.range(10).select(F.col("id"), F.repeat(F.lit("x"), 10_000).alias("t"))
    assert bounded(wide, 100, 200_000) and not bounded(wide, 100, 50_000) and not bounded(wide, 5, 1 << 30)
