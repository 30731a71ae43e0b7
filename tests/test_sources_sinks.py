import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from hearth.quality import audited_write, quality_flag_counts, reject_rows, text_length_report, schema_report
from hearth.sinks import (
    write_replace, write_append, write_create, overwrite_periods, read_table, delete_period, freshness_gate, dimension_snapshot,
    export_csv, export_sample,
)
from hearth.sources import (
    read_delimited, read_delimited_raw, read_preamble_tsv, MissingHeader, long_series, read_landed_json,
    json_key_values, sql_view_query,
)


def _write(path, text, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if gz else open
    with opener(path, "wt", encoding="utf-8") as f:
        f.write(text)


def test_csv_bom_and_padded_header(spark, tmpdir_path):
    p = f"{tmpdir_path}/inv/a.csv"
    _write(p, "﻿month_date_yyyymm, postal_code ,value\n202401,2301,1.5\n202402,,x\n")
    raw = read_delimited_raw(spark, p)
    assert raw.columns == ["month_date_yyyymm", "postal_code", "value"]
    typed = read_delimited(spark, p, [("month_date_yyyymm", "int"), ("postal_code", "string"), ("value", "double")])
    assert [tuple(r) for r in typed.orderBy("month_date_yyyymm").collect()] == [(202401, "2301", 1.5), (202402, None, None)]


def test_preamble_per_file_and_missing_header(spark, tmpdir_path):
    head = "period_begin\tperiod_end\tregion\n"
    _write(f"{tmpdir_path}/t/a.tsv000.gz", "junk\n" + head + "2024-01-01\t2024-01-31\tA\n2024-02-01\t2024-02-29\tB\n", gz=True)
    _write(f"{tmpdir_path}/t/b.tsv000.gz", "x\ny\nz\n" + head + "2024-03-01\t2024-03-31\tC\n", gz=True)
    df = read_preamble_tsv(spark, f"{tmpdir_path}/t", ["period_begin", "period_end"],
                           [("period_begin", "date"), ("region", "string")])
    assert sorted(r.region for r in df.collect()) == ["A", "B", "C"]
    _write(f"{tmpdir_path}/bad/c.tsv000.gz", "no header here\n1\t2\n", gz=True)
    with pytest.raises(MissingHeader):
        read_preamble_tsv(spark, f"{tmpdir_path}/bad", ["period_begin", "period_end"])


def test_wide_series_and_json(spark, tmpdir_path):
    p = f"{tmpdir_path}/w.csv"
    _write(p, "RegionID,RegionName,2024-01-31,2024-02-29,2024-03-31\n1,2301,100.5,,300\n2,10001,,,\n")
    long = long_series(read_delimited_raw(spark, p), ["RegionID", "RegionName"])
    assert long.count() == 6 and long.where("value IS NULL").count() == 4
    assert long.agg(F.min("month_end_date")).first()[0] == dt.date(2024, 1, 31)
    j = f"{tmpdir_path}/resp.json"
    _write(j, json.dumps({"price": 100, "beds": 3, "city": "Boston"}, indent=2))
    resp = read_landed_json(spark, j)
    kv = json_key_values(resp.select(F.to_json(F.struct(*resp.columns)).alias("body")), "body")
    assert sorted((r.key, r.value) for r in kv.collect()) == [("beds", "3"), ("city", "Boston"), ("price", "100")]


def test_sql_view(spark):
    df = spark.range(10)
    assert sql_view_query(df, "SELECT count(*) AS n FROM {view} WHERE id >= 5").first().n == 5


def test_gate_append_and_idempotence(spark, tmpdir_path):
    target = f"{tmpdir_path}/tbl"
    ext = spark.createDataFrame([(202401, 1.0), (202402, 2.0), (202403, 3.0)], "p int, v double")
    assert freshness_gate(spark, ext.where("p < 202402"), target, "p").action == "full"
    assert freshness_gate(spark, ext, target, "p").action == "append"
    assert freshness_gate(spark, ext, target, "p").action == "none"
    assert read_table(spark, target).count() == 3
    # re-delivering a period replaces it instead of duplicating it
    overwrite_periods(ext.where("p = 202403").withColumn("v", F.lit(9.0)), target, "p")
    assert sorted(tuple(r) for r in read_table(spark, target).select("p", "v").collect())[-1] == (202403, 9.0)
    assert delete_period(spark, target, "p", 202403) and read_table(spark, target).count() == 2
    latest = f"{tmpdir_path}/tbl2"
    freshness_gate(spark, ext.where("p = 202401"), latest, "p")
    assert freshness_gate(spark, ext, latest, "p", latest_only=True).action == "append"
    assert sorted(r.p for r in read_table(spark, latest).collect()) == [202401, 202403]


def test_replace_append_snapshot_exports(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, t string")
    write_replace(df, f"{tmpdir_path}/r")
    write_replace(df, f"{tmpdir_path}/r")
    write_append(df, f"{tmpdir_path}/a")
    write_append(df, f"{tmpdir_path}/a")
    assert read_table(spark, f"{tmpdir_path}/r").count() == 3 and read_table(spark, f"{tmpdir_path}/a").count() == 6
    write_create(spark, df, f"{tmpdir_path}/a")            # drop then create: replaces the appended table
    assert read_table(spark, f"{tmpdir_path}/a").count() == 3
    for _ in range(2):
        dimension_snapshot(df, ["k", "t"], f"{tmpdir_path}/dim", dt.date(2025, 1, 1), "Home_Values")
    assert read_table(spark, f"{tmpdir_path}/dim").count() == 2
    export_sample(df, f"{tmpdir_path}/sample", 2, ["k", "t"])
    assert read_delimited_raw(spark, f"{tmpdir_path}/sample").count() == 2
    export_csv(df, f"{tmpdir_path}/csv")
    assert read_delimited_raw(spark, f"{tmpdir_path}/csv").count() == 3


def test_audit_and_quality(spark, tmpdir_path):
    df = spark.createDataFrame([(202401, "x", 1), (202402, "2024-13-01", None), (202402, "2024-01-05", 0)],
                               "p int, d string, flag int")
    audit = audited_write(df, lambda d: overwrite_periods(d, f"{tmpdir_path}/data", "p", clustered=True), "step1",
                          f"{tmpdir_path}/audit", dt.datetime(2025, 1, 1, 8, 0), "p", partition_by=["p"])
    row = spark.read.parquet(f"{tmpdir_path}/audit").first()
    assert (row.step, row.rows_written, row.max_period) == ("step1", 3, "202402") and audit.count() == 1
    rej = reject_rows(df, [("d", "date")], ["p"])
    assert sorted(r.raw_value for r in rej.collect()) == ["2024-13-01", "x"]
    assert {tuple(r) for r in quality_flag_counts(df, "flag").collect()} == {(1, 1), (0, 2)}
    rep = {r.column_name: (r.max_length, r.rows_over) for r in text_length_report(df, {"d": 5}).collect()}
    assert rep == {"d": (10, 2)}
    assert schema_report(df, [("p", "int"), ("zz", "string")]) == [("p", "int", "int"), ("zz", "string", None)]


def test_jdbc_writer_reaches_spark_jdbc(spark):
    """No database may run here: an unknown JDBC scheme proves the call reaches
    Spark's JDBC writer (it fails looking up a driver, before any connection)."""
    from hearth.sinks import write_jdbc
    with pytest.raises(Exception) as err:
        write_jdbc(spark.range(3), "jdbc:hearth-none:target", "t", batchsize=500, num_partitions=2)
    assert "driver" in str(err.value).lower()


def test_wide_series_requires_id_columns(spark, tmpdir_path):
    from hearth.sources import read_wide_series
    _write(f"{tmpdir_path}/w2.csv", "RegionID,2024-01-31\n1,5\n")
    with pytest.raises(ValueError):
        read_wide_series(spark, f"{tmpdir_path}/w2.csv", ["RegionID", "RegionName"])
    assert read_wide_series(spark, f"{tmpdir_path}/w2.csv", ["RegionID"]).columns == ["RegionID", "2024-01-31"]
