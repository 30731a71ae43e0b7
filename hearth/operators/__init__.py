"""DataFrame -> DataFrame operators."""

from hearth.operators.measures import (
    Derived, measure, measures, with_prior_levels, round_columns, MONTH_YEAR_MM, MONTH_YEAR_MOM,
)
from hearth.operators.reshape import melt, header_to_date, pivot_wide
from hearth.operators.filldown import fill_down
from hearth.operators.filters import (
    region_filter, footer_reject, period_range, latest_period, latest_period_slice, newer_than, drop_all_null,
    month_bounds, months_between, newer_months, latest_month_slice,
)
from hearth.operators.layout import project_layout, with_tags
from hearth.operators.joins import fits, bounded, lookup_left_join, surrogate_key, extend_keys, load_keys
from hearth.operators.aggregates import (
    max_period_frame, row_count, duplicate_key_report, distinct_dimension, loaded_periods, top_n,
)
from hearth.operators.union import tagged_union
