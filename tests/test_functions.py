import datetime as dt
import math

from pyspark.sql import functions as F

from hearth.functions import (
    prior_from_ratio, prior_from_difference, prior_from_sum, prior_from_ratio_guarded, total_from_share,
    complement, count_from_rate, guarded_ratio, round_half_even, round_half_up, to_int, to_decimal, conform,
    zero_pad_code, split_last_token, duration_to_int, strip_literal, quarter_start, quarter_label, yyyymm,
    yyyymm_to_date, minute_stamp, finite_or_zero, nonfinite_to_zero, fill_defaults, text_default, us_abbrev,
    abs_int_default, parse_date,
)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_prior_levels(spark):
    df = spark.createDataFrame([(110.0, 0.1), (0.0, -1.0), (50.0, -1.0), (80.0, None), (None, 0.2)], "x double, g double")
    out = rows(df.select(F.round(prior_from_ratio("x", "g"), 6), F.round(prior_from_difference("x", "g"), 6),
                         F.round(prior_from_sum("x", "g"), 6), F.round(prior_from_ratio_guarded("x", "g"), 6)))
    assert out[0] == (100.0, 109.9, 110.1, 100.0)
    assert out[1][0] is None and out[1][3] == 0.0      # 0 / 0 -> NULL (not NaN); guarded -> 0
    assert out[2][0] is None and out[2][3] == 0.0      # change of -100 %
    assert out[3] == (None, None, None, None)
    assert out[4][0] is None


def test_prior_inverts_change(spark):
    df = spark.range(1, 200).select((F.col("id") * 1.37).alias("prior"), ((F.col("id") % 7) / 10.0 - 0.3).alias("g"))
    df = df.select("prior", "g", (F.col("prior") * (1 + F.col("g"))).alias("x"))
    bad = df.where(F.abs(prior_from_ratio("x", "g") - F.col("prior")) > 1e-9).count()
    assert bad == 0


def test_share_total_complement(spark):
    df = spark.createDataFrame([(30.0, 0.3), (5.0, 0.0), (7.0, None)], "part double, share double")
    t = total_from_share("part", "share")
    out = rows(df.select(F.round(t, 6), F.round(complement(t, "part"), 6)))
    assert out == [(100.0, 70.0), (0.0, -5.0), (None, None)]


def test_counts_and_sizes(spark):
    df = spark.createDataFrame([(0.25, 10.0, 300000.0, 150.0), (0.05, 10.0, 1.0, 0.0)], "r double, v double, p double, s double")
    out = rows(df.select(count_from_rate("r", "v"), guarded_ratio("p", "s")))
    assert out == [(3.0, 2000.0), (1.0, 0.0)]   # 2.5 -> 3 (half-up), size 0 when ppsf is 0


def test_rounding_modes(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,), (2.675,)], "x double")
    out = rows(df.select(round_half_even("x", 0), round_half_up("x", 0)))
    assert out[:4] == [(0.0, 1.0), (2.0, 2.0), (2.0, 3.0), (-2.0, -3.0)]


def test_casts(spark):
    df = spark.createDataFrame([("12.9", 12.7, 1.23456), ("x", -12.7, 99999999.99999)], "s string, d double, z double")
    out = rows(df.select(to_int(F.col("s")), to_int("d"), to_decimal("z")))
    assert out[0][0] is None and out[0][1] == 12 and str(out[0][2]) == "1.2346"
    assert out[1][0] is None and out[1][1] == -12 and out[1][2] is None   # truncating; overflow -> NULL
    c = conform(df, [("d", "int"), ("s", "double"), ("missing", "string")], missing="null")
    assert c.columns == ["d", "s", "missing"] and rows(c)[0] == (12, 12.9, None)


def test_text(spark):
    df = spark.createDataFrame([("2301", "Brockton, MA", "4 weeks"), ("123456", "Nowhere", "x weeks"), (None, None, None)],
                               "code string, place string, dur string")
    out = rows(df.select(zero_pad_code("code"), split_last_token("place"), duration_to_int("dur"),
                         strip_literal(F.lit("Boston, MA metro area"), " metro area")))
    assert out[0] == ("02301", "MA", 4, "Boston, MA")
    assert out[1][:3] == ("123456", "Nowhere", None)       # longer codes are never truncated
    assert out[2][:3] == (None, None, None)


def test_quarters_and_periods(spark):
    df = spark.createDataFrame([("2024 Q4",), ("2024 Q1",), ("2024-4",), ("2024 Q5",), (None,)], "q string")
    out = [r[0] for r in df.select(quarter_start("q")).collect()]
    assert out == [dt.date(2024, 10, 1), dt.date(2024, 1, 1), None, None, None]
    d = spark.createDataFrame([(dt.datetime(2025, 2, 14, 13, 45, 59),)], "ts timestamp_ntz")
    r = d.select(yyyymm("ts").alias("ym"), minute_stamp("ts"), quarter_label("ts")).first()
    assert r[0] == 202502 and r[1] == "2025-02-14 13:45" and r[2] == "2025 Q1"
    assert d.select(yyyymm_to_date(F.lit(202502)), yyyymm_to_date(F.lit(202513))).first() == (dt.date(2025, 2, 1), None)
    assert spark.range(1).select(parse_date(F.lit("2024-10-31")), parse_date(F.lit("nope"))).first() == (dt.date(2024, 10, 31), None)


def test_hygiene(spark):
    df = spark.createDataFrame([(float("inf"), float("nan"), None, " a ", None, "U.S.", "-1"),
                                (float("-inf"), 1.5, 3, None, "x", None, "n/a")],
                               "a double, b double, n int, t string, u string, st string, pid string")
    clean = fill_defaults(nonfinite_to_zero(df))
    out = rows(clean)
    assert out[0][:5] == (0.0, 0.0, 0, " a ", "") and out[1][:5] == (0.0, 1.5, 3, "", "x")
    assert rows(df.select(text_default("t"), us_abbrev("st"), abs_int_default("pid"))) == [("a", "US", 1), ("NA", "NA", 0)]
    assert all(not math.isinf(v) for r in out for v in r[:2])
    assert rows(df.select(finite_or_zero("b")))[0] == (0.0,)
