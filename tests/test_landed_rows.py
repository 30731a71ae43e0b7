"""No landed row is lost, misplaced or invented."""

import gzip
import os

import pytest
from pyspark.sql import functions as F


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_files_with_other_headers_are_read_by_name(spark, tmpdir_path):
    from hearth.sources import read_delimited_raw
    put(f"{tmpdir_path}/d/a.csv", "id,x,y\n1,x1,y1\n")
    put(f"{tmpdir_path}/d/b.csv", "id,y,x,z\n2,y2,x2,z2\n")
    got = {r.id: (r.x, r.y, r.z) for r in read_delimited_raw(spark, f"{tmpdir_path}/d").collect()}
    assert got == {"1": ("x1", "y1", None), "2": ("x2", "y2", "z2")}


def test_wide_header_that_is_no_date_raises(spark, tmpdir_path):
    from hearth.sources import read_wide_series
    put(f"{tmpdir_path}/w.csv", "RegionID,2024-01-31,Note\n1,2.5,hello\n")
    with pytest.raises(ValueError, match="Note"):
        read_wide_series(spark, f"{tmpdir_path}/w.csv", ["RegionID"])


def test_preamble_rows_do_not_depend_on_the_split_layout(spark, tmpdir_path):
    from hearth.sources import MissingHeader, read_preamble_tsv
    os.makedirs(f"{tmpdir_path}/t")
    for i in range(6):
        with gzip.open(f"{tmpdir_path}/t/{i}.tsv.gz", "wt") as f:
            f.write("junk\n" * i + "a_begin\ta_end\n" + "".join(f"{i}\t{k}\n" for k in range(50)))
    df = read_preamble_tsv(spark, f"{tmpdir_path}/t", ["a_begin", "a_end"])
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for cost in ("1", "100000000"):
            spark.conf.set("spark.sql.files.openCostInBytes", cost)
            assert df.count() == 300 and df.where(F.col("a_begin") == "a_begin").count() == 0
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    with gzip.open(f"{tmpdir_path}/t/empty.tsv.gz", "wt"):
        pass
    with pytest.raises(MissingHeader):
        read_preamble_tsv(spark, f"{tmpdir_path}/t", ["a_begin", "a_end"])


@pytest.mark.parametrize("cap", [None, 1])
def test_a_month_in_several_files_and_deliveries_adds_up(spark, tmpdir_path, cap):
    from hearth.sinks import read_table
    from hearth.streaming import incremental_load, landed_csv_stream

    def load():
        stream = landed_csv_stream(spark, f"{tmpdir_path}/in", ["m", "v"], max_files_per_trigger=cap)
        incremental_load(stream, lambda b: b, f"{tmpdir_path}/T", "m", f"{tmpdir_path}/c").awaitTermination(120)
    put(f"{tmpdir_path}/in/a.csv", "m,v\n202401,1\n202401,2\n")
    put(f"{tmpdir_path}/in/b.csv", "m,v\n202401,3\n202402,4\n")
    load()
    put(f"{tmpdir_path}/in/c.csv", "m,v\n202401,5\n")
    load()
    load()
    assert sorted((int(r.m), int(r.v)) for r in read_table(spark, f"{tmpdir_path}/T").collect()) == [
        (202401, 1), (202401, 2), (202401, 3), (202401, 5), (202402, 4)]


def test_gate_keeps_off_foreign_tables_and_rows_without_a_period(spark, tmpdir_path):
    from hearth.sinks import freshness_gate, read_table
    spark.range(2).write.parquet(f"{tmpdir_path}/other")
    rows = spark.createDataFrame([(202401, 1), (202402, 2), (None, 3)], "p int, v int")
    with pytest.raises(ValueError, match="no partition"):
        freshness_gate(spark, rows, f"{tmpdir_path}/other", "p")
    assert spark.read.parquet(f"{tmpdir_path}/other").count() == 2
    assert freshness_gate(spark, rows, f"{tmpdir_path}/mine", "p").rows_written == 2
    assert freshness_gate(spark, rows, f"{tmpdir_path}/mine", "p").action == "none"
    assert read_table(spark, f"{tmpdir_path}/mine").count() == 2
