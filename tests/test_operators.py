import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from hearth.operators import (
    melt, header_to_date, pivot_wide, fill_down, surrogate_key, lookup_left_join, fits, footer_reject,
    latest_period_slice, drop_all_null, tagged_union, duplicate_key_report, project_layout, with_prior_levels,
    measures, measure, round_columns, region_filter, period_range, distinct_dimension, loaded_periods, top_n,
    with_tags, row_count, max_period_frame,
)


def test_melt_keeps_nulls_and_counts(spark):
    df = spark.createDataFrame([(1, "a", 1.0, None, "3"), (2, "b", None, None, None)],
                               "RegionID int, State string, `2024-01-31` double, `2024-02-29` double, `2024-03-31` string")
    long = melt(df, ["RegionID", "State"], variable="hdr", value="Value")
    assert long.count() == 2 * 3                                   # rows x value columns, NULLs kept
    d = long.select("RegionID", header_to_date("hdr").alias("d"), "Value").where("RegionID = 1").orderBy("d").collect()
    assert [r["Value"] for r in d] == [1.0, None, 3.0] and str(d[1]["d"]) == "2024-02-29"


def test_pivot_then_melt_roundtrip(spark):
    df = spark.createDataFrame([(1, "h1", 1.0), (1, "h2", 2.0), (2, "h1", 3.0)], "k int, h string, v double")
    wide = pivot_wide(df, ["k"], "h", F.max("v"))
    back = melt(wide, ["k"], variable="h", value="v")
    assert sorted(tuple(r) for r in back.collect()) == [(1, "h1", 1.0), (1, "h2", 2.0), (2, "h1", 3.0), (2, "h2", None)]


def _reference_fill(df, col, order, keys):
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(order) \
        .rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(col, F.last(col, ignorenulls=True).over(w))


def test_fill_down_matches_single_window_with_hot_key(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rnd.randint(1, 40)              # key 0 holds a third of all rows
        val = f"v{i}" if rnd.random() < 0.08 else None
        rows.append((i, key, val))
    df = spark.createDataFrame(rows, "row_no long, k int, q string")
    for keys in ([], ["k"]):
        for width in (7, 64, None):
            got = fill_down(df, ["q"], "row_no", keys=keys, bucket_width=width)
            ref = _reference_fill(df, "q", "row_no", keys)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect())), (keys, width)


def test_fill_down_leading_nulls_stay_null(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None), (10, None), (11, "b"), (12, None)], "row_no long, q string")
    out = [r["q"] for r in fill_down(df, ["q"], "row_no", bucket_width=2).orderBy("row_no").collect()]
    assert out == [None, "a", "a", "a", "b", "b"]


def test_surrogate_key_dense_in_label_order(spark):
    labels = [f"label-{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(x,) for x in labels * 3] + [(None,)], "t string")
    got = surrogate_key(df, "t", "k", partitions=7).orderBy("k").collect()
    assert [r["t"] for r in got] == sorted(labels)
    assert [r["k"] for r in got] == list(range(500))


def test_lookup_left_join(spark):
    fact = spark.createDataFrame([(1, "A"), (2, "B"), (3, "Z")], "id int, Data_Type string")
    lkp = spark.createDataFrame([(10, "A", "x"), (20, "B", "y")], "LOOKUP_KEY int, DATA_TYPE string, DATASET_TYPE string")
    out = lookup_left_join(fact, lkp, ["Data_Type"], ["DATA_TYPE"], drop=["DATASET_TYPE"])
    assert out.columns == ["id", "Data_Type", "LOOKUP_KEY"]
    assert sorted(map(tuple, out.collect())) == [(1, "A", 10), (2, "B", 20), (3, "Z", None)]
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    big = lookup_left_join(fact, lkp, ["Data_Type"], ["DATA_TYPE"], max_broadcast_rows=1)   # over the bound: no hint
    assert sorted(map(tuple, big.collect()))[2] == (3, "Z", None, None)
    assert fits(lkp, 2) and not fits(lkp, 1)


def test_filters(spark):
    df = spark.createDataFrame([("202401", 1.0, "MA"), ("202402", 2.0, "NY"), ("quality_flag = 1: footer", None, None)],
                               "month_date_yyyymm string, v double, State string")
    kept = footer_reject(df, "month_date_yyyymm")
    assert kept.count() == 2
    typed = kept.withColumn("month_date_yyyymm", F.col("month_date_yyyymm").try_cast("int"))
    assert [r.v for r in latest_period_slice(typed, "month_date_yyyymm").collect()] == [2.0]
    assert region_filter(typed, "State", "MA").count() == 1 and region_filter(typed, "State", None).count() == 2
    assert period_range(typed, "month_date_yyyymm", start=202402, equals={"State": "NY"}).count() == 1
    blank = spark.createDataFrame([(1, None, None), (2, None, "x")], "row_no int, a string, b string")
    assert drop_all_null(blank, ["a", "b"]).count() == 1


def test_aggregates_union_layout(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, t string")
    rep = duplicate_key_report(df, ["k"]).collect()
    assert tuple(rep[0]) == (1, 2)
    assert duplicate_key_report(df, ["k"], only_duplicates=True).count() == 1
    assert distinct_dimension(df, ["k", "t"]).count() == 2
    assert [r.k for r in loaded_periods(df, "k").collect()] == [1, 2]
    assert [r.k for r in top_n(df, 1, [F.col("k").desc()]).collect()] == [2]
    assert row_count(df).first()[0] == 3 and max_period_frame(df, "k").first()[0] == 2
    u = tagged_union({"x": df, "y": df.select("k")}, "label")
    assert u.count() == 6 and u.where("label = 'y' AND t IS NULL").count() == 3
    lay = project_layout(with_tags(df, {"run": "r1"}), ["t", "key", "run"], rename={"k": "key"})
    assert lay.columns == ["t", "key", "run"]


def test_prior_levels_one_projection(spark):
    df = spark.createDataFrame([(110.0, 0.1, 0.0, 10.0, 2.0)], "p double, p_mm double, p_yy double, d double, d_mm double")
    spec = measures(["p"]) + measure("d", "diff", changes=(("_mm", "_lm"),))
    out = round_columns(with_prior_levels(df, spec), {"p_lm": 2}, "half_even")
    assert out.columns == ["p", "d", "p_lm", "p_ly", "d_lm"]
    assert tuple(out.first()) == (110.0, 10.0, 100.0, 110.0, 8.0)
