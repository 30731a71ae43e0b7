"""Declarative specs of the source families.

One spec per family; the geography (state, metro, county, zip, ...) is a
parameter that only changes key columns and the target table. Column lists
below are fixed values that must equal the published files and the target
layouts, so they are stated plainly and in natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Monthly inventory measures (each has _mm and _yy changes).
INVENTORY_MEASURES = [
    "median_listing_price", "active_listing_count", "median_days_on_market", "new_listing_count",
    "price_increased_count", "price_reduced_count", "pending_listing_count",
    "median_listing_price_per_square_foot", "median_square_feet", "average_listing_price",
    "total_listing_count", "pending_ratio",
]

# Monthly hotness columns.
HOTNESS_SCORES = ["hotness_score", "supply_score", "demand_score"]
HOTNESS_PAGE_VIEWS = ["page_view_count_per_property_mm", "page_view_count_per_property_yy",
                      "page_view_count_per_property_vs_us"]
HOTNESS_CHANGE_INPUTS = ["hotness_rank_mm", "hotness_rank_yy", "median_dom_mm_day", "median_dom_yy_day",
                         "median_dom_vs_us", "median_listing_price_mm", "median_listing_price_yy",
                         "median_listing_price_vs_us", "median_days_on_market_mm", "median_days_on_market_yy"]

# Hotness columns rounded to two and to four places.
HOTNESS_TWO_PLACES = ["hotness_rank", "demand_score", "hotness_rank_lm", "hotness_rank_ly",
                      "median_listing_price_lm", "median_listing_price_ly", "median_listing_price_us"]
HOTNESS_FOUR_PLACES = ["median_days_on_market_ly", "median_days_on_market_lm", "median_days_on_market_us",
                       "hotness_score", "supply_score", "page_view_count_per_property_mm",
                       "page_view_count_per_property_yy", "page_view_count_per_property_vs_us"]

# Housing-tracker measures. Ratio measures publish a relative
# change; point measures publish a change in points.
TRACKER_RATIO_MEASURES = ["median_sale_price", "median_list_price", "median_ppsf", "median_list_ppsf",
                          "homes_sold", "pending_sales", "new_listings", "inventory"]
TRACKER_POINT_MEASURES = ["months_of_supply", "median_dom", "avg_sale_to_list", "sold_above_list",
                          "price_drops", "off_market_in_two_weeks"]
# The days-on-market change is published with the opposite sign.
TRACKER_SUM_MEASURES = ["median_dom"]
TRACKER_TEXT_TRIMMED = ["region_type", "is_seasonally_adjusted", "region", "city", "state_code", "property_type"]
TRACKER_INT_DEFAULTS = ["period_duration", "region_type_id", "table_id"]
TRACKER_TEXT_UNTRIMMED = ["parent_metro_region", "parent_metro_region_metro_code"]
# Rounded to 4 places (all other numbers to 0).
TRACKER_FOUR_PLACES = ["months_of_supply", "avg_sale_to_list"]
# Rates turned into counts of homes sold, with their output names.
TRACKER_RATE_COUNTS = [("sold_above_list", "sold_above_list"), ("price_drops", "sold_price_drops"),
                       ("off_market_in_two_weeks", "sold_off_market_in_two_weeks")]
# Implied sizes: (output, price, price per square foot).
TRACKER_SIZES = [("median_sqft_off_sale_price", "median_sale_price", "median_ppsf"),
                 ("median_sqft_off_list_price", "median_list_price", "median_list_ppsf")]
TRACKER_HEADER_TOKENS = ["period_begin", "period_end"]

# Home-value / rent series labels and their lookup keys.
SERIES_LOOKUP = [
    (1, "Condo/Co-op Time Series", "Home_Values"),
    (2, "4-Bedroom Time Series", "Home_Values"),
    (3, "2-Bedroom Time Series", "Home_Values"),
    (4, "5+ Bedroom Time Series", "Home_Values"),
    (5, "3-Bedroom Time Series", "Home_Values"),
    (6, "All Homes (SFR, Condo/Co-op) Time Series, Smoothed, Seasonally Adjusted", "Home_Values"),
    (7, "Single-Family Homes Time Series", "Home_Values"),
    (8, "1-Bedroom Time Series", "Home_Values"),
    (9, "Smoothed All Homes Plus Multifamily Time Series", "Rent_Values"),
    (10, "Smoothed (Seasonally Adjusted) All Homes Plus Multifamily Time Series", "Rent_Values"),
]
SERIES_ID_COLUMNS = ["RegionID", "SizeRank", "RegionName", "State", "City", "Metro", "CountyName"]
SERIES_DROPPED = ["StateName", "RegionType"]
SERIES_DIMENSION = ["RegionID", "State", "City", "Metro", "CountyName", "Zip_Code"]

# Investor purchases by quarter (export column names).
INVESTOR_QUARTER = "Quarter"
INVESTOR_METRO = "Redfin Metro"
INVESTOR_SHARE = "Investor Market Share"
INVESTOR_PURCHASES = "Investor Purchases"
INVESTOR_YOY = "Investor Purchases YoY"
INVESTOR_LAYOUT = ["Quarter", "start_quarter_date", "Redfin Metro", "Investor Market Share", "Investor Purchases",
                   "Investor Purchases YoY", "total_purchases", "non_investor_purchases", "Investor_Purchases_LY",
                   "Update_Date"]

# Weekly tracker columns that are not measures.
WEEKLY_TEXT = ["region_name", "region_type", "duration"]
WEEKLY_INTS = ["region_type_id", "region_id"]
WEEKLY_DATES = ["period_begin", "period_end"]

# The disclaimer closing the landed inventory/hotness files.
FOOTER_TEXT = "quality_flag = 1:  year-over-year figures may be impacted"


@dataclass(frozen=True)
class Geography:
    """Key columns of one geographic level.

    ``keys`` are (target column, type); ``pad`` zero-pads a code column
    (source -> target); ``state_from`` derives ``state`` from 'place, ST';
    ``text`` are name columns filled with '' when missing."""
    name: str
    table: str
    keys: tuple[tuple[str, str], ...]
    pad: tuple[str, str] | None = None
    state_from: str | None = None
    text: tuple[str, ...] = ()


INVENTORY_GEOGRAPHIES = {
    "state": Geography("state", "REALTOR_MNTHLY_STATE", (("state", "string"), ("state_id", "string")),
                       text=("state", "state_id")),
    "metro": Geography("metro", "REALTOR_MNTHLY_METRO",
                       (("cbsa_code", "int"), ("cbsa_title", "string"), ("HouseholdRank", "int")),
                       text=("cbsa_title",)),
    "county": Geography("county", "REALTOR_MNTHLY_COUNTY", (("county_fips", "int"), ("county_name", "string")),
                        text=("county_name",)),
    "zip": Geography("zip", "REALTOR_MNTHLY_ZIP", (("zip_code", "string"), ("state", "string")),
                     pad=("postal_code", "zip_code"), state_from="zip_name", text=("zip_name",)),
}

HOTNESS_GEOGRAPHIES = {
    "metro": Geography("metro", "REALTOR_MNTHLY_HOT_METRO", (("cbsa_code", "int"), ("cbsa_title", "string")),
                       text=("cbsa_title",)),
    "county": Geography("county", "REALTOR_MNTHLY_HOT_COUNTY",
                        (("county_fips", "int"), ("county_name", "string"), ("cbsa_code", "int"),
                         ("cbsa_title", "string")), text=("county_name", "cbsa_title")),
    "zip": Geography("zip", "REALTOR_MNTHLY_HOT_ZIP", (("zip_code", "string"), ("zip_name", "string")),
                     pad=("postal_code", "zip_code"), text=("zip_code", "zip_name")),
}

# Declared lengths of the text columns of each table.
TEXT_LENGTHS = {
    "REALTOR_MNTHLY_STATE": {"state": 25, "state_id": 5},
    "REALTOR_MNTHLY_METRO": {"cbsa_title": 75},
    "REALTOR_MNTHLY_COUNTY": {"county_name": 75},
    "REALTOR_MNTHLY_ZIP": {"zip_code": 75, "state": 10},
    "REALTOR_MNTHLY_HOT_METRO": {"cbsa_title": 200},
    "REALTOR_MNTHLY_HOT_COUNTY": {"county_name": 200, "cbsa_title": 200},
    "REALTOR_MNTHLY_HOT_ZIP": {"zip_code": 200, "zip_name": 200},
    "REDFIN_MNTHLY_HOUSING": {"region_type": 50, "is_seasonally_adjusted": 1, "region": 100, "city": 100, "state": 100,
                              "state_code": 100, "property_type": 100, "parent_metro_region": 100,
                              "parent_metro_region_metro_code": 100, "nk_update_date": 16},
}


TRACKER_GEOGRAPHIES = {g: f"REDFIN_MNTHLY_HOUSING_{g.upper()}"
                       for g in ("us", "state", "metro", "county", "city", "zip", "neighborhood")}


@dataclass(frozen=True)
class SeriesSpec:
    """A family of wide month-per-column series files: {label: location}."""
    dataset_type: str
    sources: dict = field(default_factory=dict)
    state: str | None = None          # optional region restriction (e.g. 'MA')
    target: str = "ZW_HOME_VALUES"
