"""Property tests (invariants from the survey's test strategy), one DataFrame per example."""

import decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from hearth.functions import prior_from_ratio, prior_from_difference, round_half_even, round_half_up, zero_pad_code
from hearth.operators import melt, fill_down

SETTINGS = settings(max_examples=5, deadline=None)


@SETTINGS
@given(st.lists(st.tuples(st.floats(-1e6, 1e6, allow_nan=False), st.floats(-0.95, 5, allow_nan=False)),
                min_size=1, max_size=200))
def test_prior_inverts_the_change(spark, rows):
    df = spark.createDataFrame(rows, "prior double, g double").select(
        "prior", "g", (F.col("prior") * (1 + F.col("g"))).alias("x_ratio"), (F.col("prior") + F.col("g")).alias("x_diff"))
    out = df.select("prior", prior_from_ratio("x_ratio", "g").alias("r"), prior_from_difference("x_diff", "g").alias("d"))
    for prior, r, d in out.collect():
        assert abs(r - prior) <= 1e-9 * max(1.0, abs(prior))
        assert abs(d - prior) <= 1e-9 * max(1.0, abs(prior))


@SETTINGS
@given(st.lists(st.integers(-10_000, 10_000), min_size=1, max_size=300))
def test_rounding_modes_on_exact_ties(spark, ints):
    df = spark.createDataFrame([(i,) for i in ints], "k int").select("k", (F.col("k") / 2).alias("x"))
    got = df.select("k", round_half_even("x", 0), round_half_up("x", 0)).collect()
    for k, even, up in got:
        d = decimal.Decimal(k) / 2
        assert even == float(d.quantize(decimal.Decimal(1), decimal.ROUND_HALF_EVEN))
        assert up == float(d.quantize(decimal.Decimal(1), decimal.ROUND_HALF_UP))


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789", min_size=1, max_size=9), min_size=1, max_size=100))
def test_zero_pad_never_truncates(spark, codes):
    out = spark.createDataFrame([(c,) for c in codes], "c string").select("c", zero_pad_code("c").alias("z")).collect()
    for c, z in out:
        assert len(z) == max(5, len(c)) and z.endswith(c) and set(z[: len(z) - len(c)]) <= {"0"}


@SETTINGS
@given(st.integers(1, 40), st.integers(1, 6))
def test_melt_row_count(spark, n_rows, n_values):
    df = spark.range(n_rows).select("id", *[F.when(F.col("id") % (i + 2) == 0, F.lit(None)).otherwise(F.col("id") * i)
                                           .alias(f"m{i}") for i in range(n_values)])
    assert melt(df, ["id"]).count() == n_rows * n_values


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.booleans()), min_size=1, max_size=400), st.integers(1, 50))
def test_fill_down_equals_single_window(spark, rows, width):
    data = [(i, k if k else None, f"v{i}" if present else None) for i, (k, present) in enumerate(rows)]
    df = spark.createDataFrame(data, "row_no long, k int, q string")
    got = fill_down(df, ["q"], "row_no", keys=["k"], bucket_width=width)
    w = Window.partitionBy("k").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("q", F.last("q", ignorenulls=True).over(w))
    key = lambda r: r[0]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, ref.collect()), key=key)


@SETTINGS
@given(st.lists(st.text(alphabet="abcxyz", min_size=0, max_size=4), min_size=1, max_size=300), st.integers(1, 9))
def test_surrogate_keys_dense_and_ordered(spark, labels, parts):
    from hearth.operators import surrogate_key
    df = spark.createDataFrame([(x,) for x in labels], "t string")
    got = surrogate_key(df, "t", "k", partitions=parts).collect()
    expect = {lab: i for i, lab in enumerate(sorted(set(labels), key=lambda v: v.encode()))}
    assert {r.t: r.k for r in got} == expect and len(got) == len(expect)


def test_fill_down_by_timestamp(spark):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(hours=7 * i), "a" if i % 5 == 0 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, q string")
    out = [r.q for r in fill_down(df, ["q"], "ts").orderBy("ts").collect()]
    assert out == ["a"] * 60
