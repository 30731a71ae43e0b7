"""Column -> Column building blocks (all JVM built-ins; no Python UDFs)."""

from hearth.functions.metrics import (
    prior_from_ratio, prior_from_difference, prior_from_sum, prior_from_ratio_guarded,
    total_from_share, complement, count_from_rate, guarded_ratio, prior_level,
)
from hearth.functions.hygiene import (
    finite_or_zero, text_default, us_abbrev, abs_int_default, nonfinite_to_zero, nonfinite_to_null,
    fill_defaults,
)
from hearth.functions.casting import (
    round_half_even, round_half_up, rounded, to_int, to_decimal, conform,
)
from hearth.functions.text import zero_pad_code, split_last_token, strip_literal, duration_to_int
from hearth.functions.dates import (
    quarter_start, quarter_label, parse_date, parse_timestamp, yyyymm, yyyymm_to_date,
    minute_stamp, second_stamp, run_timestamp_literal,
)
