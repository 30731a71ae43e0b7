"""Every landed row has one fate, and reruns leave no second record."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hearth.plans import families as fam
from hearth.plans import specs as S
from hearth.plans.registry import declared_layout, registry, run_pipeline
from hearth.quality import LoadEntry, Unaccounted, read_ledger, record
from hearth.sinks import read_table
from tests.test_families import RUN, _inventory_file, _write


def _spoil(path):
    """A landed inventory file with a row without a period and one with another text in its place."""
    _inventory_file(path, 202401)
    lines = open(path, encoding="utf-8").read().rstrip("\n").split("\n")
    body = lines[1]
    extra = [body.replace("202401", "", 1), body.replace("202401", "2024-02", 1)]
    open(path, "w", encoding="utf-8").write("\n".join([*lines[:3], *extra, *lines[3:]]) + "\n")


def test_blank_periods_are_an_error_without_a_quarantine(spark, tmpdir_path):
    _spoil(f"{tmpdir_path}/in/a.csv")
    with pytest.raises(Unaccounted, match="2 of 5"):
        fam.run_inventory(spark, "zip", f"{tmpdir_path}/in", f"{tmpdir_path}/T", RUN)
    assert read_table(spark, f"{tmpdir_path}/T") is None


def test_every_row_has_a_fate_and_a_rerun_leaves_no_second_record(spark, tmpdir_path):
    _spoil(f"{tmpdir_path}/in/a.csv")
    places = dict(quarantine_path=f"{tmpdir_path}/Q", ledger_path=f"{tmpdir_path}/L")
    first = fam.run_inventory(spark, "zip", f"{tmpdir_path}/in", f"{tmpdir_path}/T", RUN, **places)
    e = first.entry
    assert (e.rows_read, e.rows_loaded, e.rows_older, e.rows_footer, e.rows_quarantined) == (5, 2, 0, 1, 2)
    kept = lambda: sorted((r.column_name, r.declared_type, r.raw_value) for r in read_table(spark, f"{tmpdir_path}/Q").collect())
    assert kept() == [("month_date_yyyymm", "empty period", None), ("month_date_yyyymm", "int", "2024-02")]
    again = fam.run_inventory(spark, "zip", f"{tmpdir_path}/in", f"{tmpdir_path}/T", RUN, **places)
    assert (again.action, again.entry.rows_older) == ("none", 2)
    ledger = read_ledger(spark, f"{tmpdir_path}/L").collect()
    assert [(r.table_name, r.step, r.action, r.rows_loaded, r.max_period) for r in ledger] == [("REALTOR_MNTHLY_ZIP", "in", "full", 2, "202401")]
    assert len(kept()) == 2


def test_ledger_keys_and_sums(spark, tmpdir_path):
    entry = LoadEntry("T", "run-1", "a", RUN, "append", 3, 2, 1)
    for e in (entry, entry, LoadEntry("T", "run-1", "b", RUN, "append", 1, 1), LoadEntry("T", "run-2", "a", RUN, "none", 3, 0, 3),
              LoadEntry("T", "run-1", "a", RUN, "none", 3, 0, 3)):  # the last: a rerun that finds its rows loaded
        record(spark, f"{tmpdir_path}/L", e)
    got = sorted((r.run_id, r.step, r.action, r.rows_loaded) for r in read_ledger(spark, f"{tmpdir_path}/L").collect())
    assert got == [("run-1", "a", "append", 2), ("run-1", "b", "append", 1), ("run-2", "a", "none", 0)]
    with pytest.raises(Unaccounted):
        record(spark, f"{tmpdir_path}/L", LoadEntry("T", "run-3", "a", RUN, "append", 3, 2))
    assert read_ledger(spark, f"{tmpdir_path}/none").count() == 0


def test_series_rows_without_an_id_are_quarantined(spark, tmpdir_path):
    head = "RegionID,SizeRank,RegionName,RegionType,StateName,State,City,Metro,CountyName,2024-01-31"
    _write(f"{tmpdir_path}/hv/a.csv", [head, '7,1,2301,zip,MA,MA,X,"Y, MA",Z,10', ',2,2302,zip,MA,MA,X,"Y, MA",Z,11',
                                       '9,3,2303,zip,MA,MA,X,"Y, MA",Z,n/a', '10,4,2304,zip,NY,NY,X,"Y, NY",Z,12'])
    spec = S.SeriesSpec("Home_Values", {"Condo/Co-op Time Series": f"{tmpdir_path}/hv"}, state="MA")
    with pytest.raises(Unaccounted):
        fam.run_series(spark, spec, dt.date(2025, 1, 15), f"{tmpdir_path}/ZW", f"{tmpdir_path}/DIM")
    fam.run_series(spark, spec, dt.date(2025, 1, 15), f"{tmpdir_path}/ZW", f"{tmpdir_path}/DIM", f"{tmpdir_path}/Q", f"{tmpdir_path}/L")
    assert sorted((r.RegionID, r.Value) for r in read_table(spark, f"{tmpdir_path}/ZW").collect()) == [(7, 10.0), (9, 0.0)]
    assert sorted((r.column_name, r.raw_value) for r in read_table(spark, f"{tmpdir_path}/Q").collect()) == [("2024-01-31", "n/a"), ("RegionID", None)]
    r = read_ledger(spark, f"{tmpdir_path}/L").first()
    assert (r.rows_read, r.rows_loaded, r.rows_excluded, r.rows_quarantined, r.values_rejected) == (4, 2, 1, 1, 2)


def test_dimension_is_taken_before_the_melt(spark):
    ids = "RegionID string, SizeRank string, RegionName string, State string, City string, Metro string, CountyName string"
    wide = spark.createDataFrame([("1", "1", "2301", "MA", None, "m", "c", "1.5", None), ("1", "1", "2301", "MA", None, "m", "c", "2", "3"),
                                  ("x", "1", "23", "MA", "t", "m", "c", None, None)], ids + ", `2024-01-31` string, `2024-02-29` string")
    regions = fam.series_regions({"a": wide, "b": wide}, "MA")
    long = fam.series_long({"a": wide, "b": wide}, dt.date(2025, 1, 1), "MA")
    assert sorted(map(tuple, regions.collect())) == sorted(map(tuple, fam.series_dimension(long).collect()))
    assert "Expand" not in regions._jdf.queryExecution().optimizedPlan().toString()


def test_registry_picks_the_source_by_what_is_loaded(spark, tmpdir_path):
    specs = registry()
    assert {(f, g) for f, g in specs if f == "tracker"} == {("tracker", g) for g in S.TRACKER_GEOGRAPHIES}
    assert specs["tracker", "zip"].table == "REDFIN_MNTHLY_HOUSING_ZIP" and specs["inventory", "state"].table == "REALTOR_MNTHLY_STATE"
    assert len({s.table for s in specs.values()}) == len(specs)
    spec = specs["inventory", "zip"]
    _inventory_file(f"{tmpdir_path}/landing/{spec.history}/h.csv", 202401)
    _inventory_file(f"{tmpdir_path}/landing/{spec.current}/c.csv", 202402)
    run = lambda ts: run_pipeline(spark, spec, ts, f"{tmpdir_path}/landing", f"{tmpdir_path}/lake")
    assert (run(RUN).step, run(RUN).step) == ("history", "current")
    later = run(RUN + dt.timedelta(days=1))
    assert (later.action, later.rows_older, later.rows_loaded) == ("none", 2, 0)
    assert read_table(spark, f"{tmpdir_path}/lake/{spec.table}").count() == 4


def test_declared_layouts_name_the_loaded_columns():
    specs = registry()
    county = dict(declared_layout(specs["inventory", "county"]))
    assert county["county_name"] == "varchar(75)" and county["active_listing_count_lm"] == "int" and county["pending_ratio_ly"] == "double"
    assert [c for c, _ in declared_layout(specs["tracker", "city"])] == [c for c, _ in fam.tracker_layout()]
    assert dict(declared_layout(specs["hotness", "zip"]))["hotness_score"] == "decimal(12,4)"


def test_missing_values_may_stay_missing(spark):
    names = ["month_date_yyyymm", "state", "state_id", "quality_flag"] + [f"{m}{s}" for m in S.INVENTORY_MEASURES for s in ("", "_mm", "_yy")]
    row = ["202401", "Maine", None, None] + [x for _ in S.INVENTORY_MEASURES for x in ("10", "-1", None)]
    raw = spark.createDataFrame([tuple(row)], ", ".join(f"`{n}` string" for n in names))
    geo = S.INVENTORY_GEOGRAPHIES["state"]
    kept = fam.inventory_transform(raw, geo, RUN, fill=False).first()
    filled = fam.inventory_transform(raw, geo, RUN).first()
    assert (kept.active_listing_count, kept.active_listing_count_lm, kept.active_listing_count_ly, kept.state_id) == (10.0, None, None, None)
    assert (filled.active_listing_count_lm, filled.active_listing_count_ly, filled.state_id) == (0.0, 0.0, "")
    exact = fam.inventory_transform(raw.withColumn("pending_ratio_yy", F.lit("3")), geo, RUN, compat=False).first()
    assert exact.pending_ratio_ly == 2.5
