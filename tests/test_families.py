"""End-to-end family runs on small synthetic landed files (schemas per FIXTURES.md)."""

import datetime as dt
import gzip
import os

from pyspark.sql import functions as F

from hearth.plans import families as fam
from hearth.plans import specs as S
from hearth.sinks import read_table

RUN = dt.datetime(2025, 1, 15, 6, 30, 0)


def _write(path, lines, gz=False, bom=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if gz else open
    with opener(path, "wt", encoding="utf-8") as f:
        f.write(("﻿" if bom else "") + "\n".join(lines) + "\n")


def _inventory_file(path, month):
    header = ["month_date_yyyymm", "postal_code", "zip_name"]
    for m in S.INVENTORY_MEASURES:
        header += [m, f"{m}_mm", f"{m}_yy"]
    header.append("quality_flag")
    rows = []
    for code, name in (("2301", "brockton, ma"), ("10001", "new york")):
        vals = [str(month), code, f'"{name}"']
        for m in S.INVENTORY_MEASURES:
            if m == "median_listing_price":
                vals += ["300000", "0.2", "-1"]
            elif m == "pending_ratio":
                vals += ["0.5", "0.25", "0"]
            else:
                vals += ["100", "0.25", ""]
        vals.append("")
        rows.append(",".join(vals))
    _write(path, [",".join(header)] + rows + [f'"{S.FOOTER_TEXT}"'], bom=True)


def test_inventory_zip_history_then_append(spark, tmpdir_path):
    target = f"{tmpdir_path}/REALTOR_MNTHLY_ZIP"
    _inventory_file(f"{tmpdir_path}/hist/h.csv", 202401)
    assert fam.run_inventory(spark, "zip", f"{tmpdir_path}/hist", target, RUN,
                             quarantine_path=f"{tmpdir_path}/Q").action == "full"
    assert read_table(spark, f"{tmpdir_path}/Q") is None or read_table(spark, f"{tmpdir_path}/Q").count() == 0
    out = {r.zip_code: r for r in read_table(spark, target).collect()}
    assert set(out) == {"02301", "10001"}
    r = out["02301"]
    assert r.state == "ma" and out["10001"].state == "new york"
    assert r.median_listing_price == 300000 and r.median_listing_price_lm == 250000.0
    assert r.median_listing_price_ly == 0.0                      # change of -100 %: inf -> 0
    assert r.active_listing_count_lm == 80.0 and r.active_listing_count_ly == 0.0   # missing change -> 0
    assert r.pending_ratio_lm == 0.4 and r.pending_ratio_ly == 0.0                  # compat: ly rounded to 0 places
    assert r.quality_flag == 0 and r.Update_Date == RUN
    _inventory_file(f"{tmpdir_path}/cur/c.csv", 202402)
    assert fam.run_inventory(spark, "zip", f"{tmpdir_path}/cur", target, RUN).action == "append"
    assert fam.run_inventory(spark, "zip", f"{tmpdir_path}/cur", target, RUN).action == "none"
    assert read_table(spark, target).count() == 4


def test_inventory_quarantines_bad_keys_and_measures(spark, tmpdir_path):
    header = ["month_date_yyyymm", "county_fips", "county_name"] + \
        [c for m in S.INVENTORY_MEASURES for c in (m, f"{m}_mm", f"{m}_yy")] + ["quality_flag"]
    good = ["202401", "6037", "los angeles"] + ["1"] * (3 * len(S.INVENTORY_MEASURES)) + [""]
    bad = ["202401", "n/a", "somewhere"] + ["x"] + ["1"] * (3 * len(S.INVENTORY_MEASURES) - 1) + [""]
    _write(f"{tmpdir_path}/c/a.csv", [",".join(header), ",".join(good), ",".join(bad)])
    fam.run_inventory(spark, "county", f"{tmpdir_path}/c", f"{tmpdir_path}/T", RUN, quarantine_path=f"{tmpdir_path}/Q")
    q = sorted((r.column_name, r.raw_value) for r in read_table(spark, f"{tmpdir_path}/Q").collect())
    assert q == [("county_fips", "n/a"), ("median_listing_price", "x")]


def test_inventory_other_geographies(spark):
    raw = spark.createDataFrame([("202401", "6037", "los angeles, ca", 500.0, 0.25, 0.0)],
                                "month_date_yyyymm string, county_fips string, county_name string, "
                                "median_listing_price double, median_listing_price_mm double, median_listing_price_yy double")
    for m in S.INVENTORY_MEASURES[1:]:
        raw = raw.withColumn(m, F.lit(1.0)).withColumn(f"{m}_mm", F.lit(0.0)).withColumn(f"{m}_yy", F.lit(0.0))
    out = fam.inventory_transform(raw.withColumn("quality_flag", F.lit(None).cast("double")),
                                  S.INVENTORY_GEOGRAPHIES["county"], RUN)
    r = out.first()
    assert out.columns[:3] == ["month_date_yyyymm", "county_fips", "county_name"]
    assert (r.county_fips, r.median_listing_price_lm) == (6037, 400.0)


def test_hotness_zip(spark, tmpdir_path):
    header = ["month_date_yyyymm", "postal_code", "zip_name", "hh_rank", "hotness_rank", "hotness_rank_mm",
              "hotness_rank_yy", "hotness_score", "supply_score", "demand_score", "median_days_on_market",
              "median_days_on_market_mm", "median_days_on_market_yy", "median_dom_mm_day", "median_dom_yy_day",
              "median_dom_vs_us", "page_view_count_per_property_mm", "page_view_count_per_property_yy",
              "page_view_count_per_property_vs_us", "median_listing_price", "median_listing_price_mm",
              "median_listing_price_yy", "median_listing_price_vs_us", "quality_flag"]
    row = ["202401", "2301", "brockton, ma", "15", "10", "2", "3", "55.123456", "40", "12.345678", "40", "0.1", "0.2",
           "5", "-10", "4", "1.234567", "", "0.5", "300000", "0.2", "-1", "0.5", "1"]
    _write(f"{tmpdir_path}/hot/a.csv", [",".join(header), ",".join(f'"{v}"' for v in row), f'"{S.FOOTER_TEXT}"'], bom=True)
    assert fam.run_hotness(spark, "zip", f"{tmpdir_path}/hot", f"{tmpdir_path}/HOT", RUN,
                           quarantine_path=f"{tmpdir_path}/HQ").action == "full"
    assert read_table(spark, f"{tmpdir_path}/HQ") is None or read_table(spark, f"{tmpdir_path}/HQ").count() == 0
    r = read_table(spark, f"{tmpdir_path}/HOT").first()
    assert (r.zip_code, r.household_count_rank, r.hotness_rank, r.hotness_rank_lm, r.hotness_rank_ly) == ("02301", 15, 10, 12, 7)
    assert str(r.demand_score) == "12.3500" and str(r.hotness_score) == "55.1235"
    assert str(r.median_days_on_market_lm) == "35.0000" and str(r.median_days_on_market_ly) == "50.0000"
    assert str(r.median_days_on_market_us) == "36.0000"
    assert (r.median_listing_price_lm, r.median_listing_price_ly, r.median_listing_price_us) == (250000, 0, 200000)
    assert str(r.page_view_count_per_property_yy) == "0.0000"


def _tracker_lines(period, state="U.S."):
    cols = (["period_begin", "period_end", "period_duration", "region_type", "region_type_id", "table_id",
             "is_seasonally_adjusted", "region", "city", "state", "state_code", "property_type", "property_type_id"]
            + fam.tracker_measure_columns() + ["parent_metro_region", "parent_metro_region_metro_code", "last_updated"])
    vals = {c: "" for c in cols}
    vals.update(period_begin=period, period_end=period, period_duration="30", region_type="national",
                region_type_id="1", is_seasonally_adjusted="f", region=" United States ", state=state,
                property_type="All Residential", property_type_id="-1", last_updated="2025-01-10 14:03:07",
                median_sale_price="400000", median_sale_price_mom="0.25", median_sale_price_yoy="-1",
                median_list_price="410000", median_ppsf="200", median_list_ppsf="0", homes_sold="100",
                homes_sold_mom="0.25", sold_above_list="0.3", sold_above_list_mom="0.05", median_dom="20",
                median_dom_mom="2", months_of_supply="2.5", months_of_supply_mom="0.5", avg_sale_to_list="0.98765")
    return ["\t".join(cols), "\t".join(vals[c] for c in cols)]


def test_tracker_with_preamble(spark, tmpdir_path):
    _write(f"{tmpdir_path}/trk/us.tsv000.gz", ["Redfin data center", "generated 2025-01-10"] + _tracker_lines("2024-12-01"),
           gz=True)
    assert fam.run_tracker(spark, f"{tmpdir_path}/trk", f"{tmpdir_path}/TRK", RUN,
                           quarantine_path=f"{tmpdir_path}/TQ").action == "full"
    assert read_table(spark, f"{tmpdir_path}/TQ") is None or read_table(spark, f"{tmpdir_path}/TQ").count() == 0
    df = read_table(spark, f"{tmpdir_path}/TRK")
    r = df.first()
    assert len(df.columns) == len(fam.tracker_layout())
    assert (r.state, r.city, r.region, r.property_type_id, r.table_id) == ("US", "NA", "United States", 1, 0)
    assert (r.median_sale_price, r.median_sale_price_lm, r.median_sale_price_ly) == (400000, 320000, 0)
    assert (r.homes_sold_lm, r.sold_above_list, r.sold_above_list_lm) == (80, 30, 20)
    assert (r.median_sqft_off_sale_price, r.median_sqft_off_list_price) == (2000, 0)
    assert (r.median_dom_lm, r.months_of_supply_lm, r.avg_sale_to_list) == (22, 2.0, 0.9877)
    assert r.nk_update_date == "2025-01-15 06:30" and r.last_updated == dt.datetime(2025, 1, 10, 14, 3, 7)


def test_investor_fill_down_and_guards(spark, tmpdir_path):
    lines = ['row_no,Quarter,Redfin Metro,Investor Market Share,Investor Purchases,Investor Purchases YoY',
             '1,2024 Q4,"Boston, MA",0.2,20,0.25', '2,,"Austin, TX",0,5,-1', '3,,,,,',
             '4,2024-3,"Miami, FL",0.1,10,', '5,,"Denver, CO",0.5,1,0']
    _write(f"{tmpdir_path}/inv/x.csv", lines)
    out = {r["Redfin Metro"]: r for r in fam.run_investor(spark, f"{tmpdir_path}/inv", f"{tmpdir_path}/INV", RUN,
                                                          quarantine_path=f"{tmpdir_path}/Q").collect()}
    tagged = read_table(spark, f"{tmpdir_path}/Q")
    assert [r.step for r in tagged.collect()] == ["inv"]
    q = [tuple(r) for r in tagged.drop("table_name", "run_id", "step").collect()]
    assert q == [(4, "Miami, FL", "Quarter", "quarter 'YYYY QN'", "2024-3")]
    assert len(out) == 4
    b, a, m, d = out["Boston, MA"], out["Austin, TX"], out["Miami, FL"], out["Denver, CO"]
    assert (b.Quarter, b.start_quarter_date, b.total_purchases, b.non_investor_purchases, b.Investor_Purchases_LY) == \
        ("2024 Q4", dt.date(2024, 10, 1), 100.0, 80.0, 16.0)
    assert (a.Quarter, a.total_purchases, a.non_investor_purchases, a.Investor_Purchases_LY) == ("2024 Q4", 0.0, -5.0, 0.0)
    assert (m.Quarter, m.start_quarter_date, m.Investor_Purchases_LY) == ("2024-3", None, 0.0)
    assert d.Quarter == "2024-3"
    assert read_table(spark, f"{tmpdir_path}/INV").count() == 4


def test_weekly(spark, tmpdir_path):
    lines = ["region_name\tregion_id\tperiod_begin\tduration\tadjusted_average_new_listings\t"
             "adjusted_average_new_listings_yoy\tmedian_days_on_market\tmedian_days_on_market_yoy",
             "Boston, MA metro area\t7\t2024-01-01\t4 weeks\t110\t0.1\t30.123456\t0.5",
             "Nowhere\t8\t2024-01-01\t1 weeks\t50\t-1\t\t"]
    _write(f"{tmpdir_path}/wk/w.tsv000", lines)
    df = fam.run_weekly(spark, f"{tmpdir_path}/wk")
    types = dict(df.dtypes)
    assert (types["region_id"], types["period_begin"], types["median_days_on_market"]) == ("int", "date", "double")
    out = {r.region_name: r for r in df.collect()}
    assert out["Boston, MA metro area"].median_days_on_market == 30.1235
    assert (out["Boston, MA metro area"].state, out["Boston, MA metro area"].duration_weeks) == ("MA", 4)
    assert out["Boston, MA metro area"].adjusted_average_new_listings_ly == 100.0
    assert out["Nowhere"].state == "Nowhere" and out["Nowhere"].adjusted_average_new_listings_ly is None


def test_home_values_series(spark, tmpdir_path):
    head = "RegionID,SizeRank,RegionName,RegionType,StateName,State,City,Metro,CountyName,2024-01-31,2024-02-29"
    rows = ['77001,31,2301,zip,MA,MA,Millbrook,"Boston, MA",Plymouth County,210400.5,211000.4',
            '1,2,10001,zip,NY,NY,,"New York, NY",New York County,,900000']
    _write(f"{tmpdir_path}/hv/a/a.csv", [head] + rows)
    _write(f"{tmpdir_path}/hv/b/b.csv", [head] + rows)
    spec = S.SeriesSpec("Home_Values", {"Condo/Co-op Time Series": f"{tmpdir_path}/hv/a",
                                        "Mystery Series": f"{tmpdir_path}/hv/b"}, state="MA")
    fact = fam.run_series(spark, spec, dt.date(2025, 1, 15), f"{tmpdir_path}/ZW", f"{tmpdir_path}/DIM")
    got = sorted((tuple(r) for r in read_table(spark, f"{tmpdir_path}/ZW").collect()),
                 key=lambda t: (t[2], t[5] is None, t[5] or 0))
    assert fact.columns == ["RegionID", "SizeRank", "Month_End_Date", "Value", "Date_Pulled", "LOOKUP_KEY"]
    assert got == [(77001, 31, dt.date(2024, 1, 31), 210400.0, dt.date(2025, 1, 15), 1),
                   (77001, 31, dt.date(2024, 1, 31), 210400.0, dt.date(2025, 1, 15), None),
                   (77001, 31, dt.date(2024, 2, 29), 211000.0, dt.date(2025, 1, 15), 1),
                   (77001, 31, dt.date(2024, 2, 29), 211000.0, dt.date(2025, 1, 15), None)]
    dim = read_table(spark, f"{tmpdir_path}/DIM").collect()
    assert len(dim) == 1 and dim[0].Zip_Code == "02301" and dim[0].dataset_type == "Home_Values"


def _hotness_raw(spark, keys: dict):
    cols = dict(keys)
    cols.update(month_date_yyyymm="202401", hh_rank="3", hotness_rank="5", hotness_rank_mm="1", hotness_rank_yy="-2",
                hotness_score="1.23456", supply_score="2", demand_score="3", median_days_on_market="30",
                median_days_on_market_mm="0", median_days_on_market_yy="0", median_dom_mm_day="3",
                median_dom_yy_day="4", median_dom_vs_us="5", page_view_count_per_property_mm="0.1",
                page_view_count_per_property_yy="0.2", page_view_count_per_property_vs_us="0.3",
                median_listing_price="1000", median_listing_price_mm="0.25", median_listing_price_yy="0",
                median_listing_price_vs_us="1", quality_flag=None)
    names = list(cols)
    return spark.createDataFrame([tuple(cols[n] for n in names)], ", ".join(f"`{n}` string" for n in names))


def test_hotness_county_and_metro(spark):
    county = fam.hotness_transform(_hotness_raw(spark, {"county_fips": "6037", "county_name": "los angeles, ca",
                                                        "cbsa_code": "31080", "cbsa_title": None}),
                                   S.HOTNESS_GEOGRAPHIES["county"], RUN)
    r = county.first()
    assert county.columns[:5] == ["month_date_yyyymm", "county_fips", "county_name", "cbsa_code", "cbsa_title"]
    assert (r.county_fips, r.cbsa_code, r.cbsa_title, r.hotness_rank_lm, r.hotness_rank_ly) == (6037, 31080, "", 6, 7)
    assert (r.median_listing_price_lm, r.median_listing_price_us) == (800, 500)
    metro = fam.hotness_transform(_hotness_raw(spark, {"cbsa_code": "14460", "cbsa_title": "Boston, MA"}),
                                  S.HOTNESS_GEOGRAPHIES["metro"], RUN).first()
    assert (metro.cbsa_code, metro.cbsa_title, str(metro.hotness_score)) == (14460, "Boston, MA", "1.2346")


def test_inventory_state_and_metro(spark):
    def raw(keys):
        cols = dict(keys, month_date_yyyymm="202401", quality_flag="1")
        for m in S.INVENTORY_MEASURES:
            cols.update({m: "10", f"{m}_mm": "1", f"{m}_yy": "-0.5"})
        names = list(cols)
        return spark.createDataFrame([tuple(cols[n] for n in names)], ", ".join(f"`{n}` string" for n in names))
    st = fam.inventory_transform(raw({"state": "Massachusetts", "state_id": "ma"}), S.INVENTORY_GEOGRAPHIES["state"], RUN)
    r = st.first()
    assert st.columns[:3] == ["month_date_yyyymm", "state", "state_id"]
    assert (r.state_id, r.active_listing_count_lm, r.active_listing_count_ly, r.quality_flag) == ("ma", 5.0, 20.0, 1)
    me = fam.inventory_transform(raw({"cbsa_code": "14460", "cbsa_title": "Boston, MA", "HouseholdRank": "10"}),
                                 S.INVENTORY_GEOGRAPHIES["metro"], RUN).first()
    assert (me.cbsa_code, me.HouseholdRank, me.median_listing_price) == (14460, 10, 10)


def test_tracker_latest_only_append(spark, tmpdir_path):
    _write(f"{tmpdir_path}/t1/a.tsv000.gz", _tracker_lines("2024-10-01"), gz=True)
    assert fam.run_tracker(spark, f"{tmpdir_path}/t1", f"{tmpdir_path}/T", RUN).action == "full"
    lines = _tracker_lines("2024-11-01") + _tracker_lines("2024-12-01")[1:]
    _write(f"{tmpdir_path}/t2/b.tsv000.gz", ["junk line"] + lines, gz=True)
    res = fam.run_tracker(spark, f"{tmpdir_path}/t2", f"{tmpdir_path}/T", RUN, latest_only=True)
    assert (res.action, res.rows_written, str(res.extract_max)) == ("append", 1, "2024-12-01")
    assert sorted(str(r.period_begin) for r in read_table(spark, f"{tmpdir_path}/T").collect()) == \
        ["2024-10-01", "2024-12-01"]
