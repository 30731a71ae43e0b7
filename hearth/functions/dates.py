"""Period handling: quarters, year-month keys, load stamps."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearth.functions._util import as_col, ColumnLike

# Fixed value: quarter labels look like '2024 Q4'.
QUARTER_PATTERN = r"^(\d{4}) Q([1-4])$"


def quarter_start(c: ColumnLike) -> Column:
    """'2024 Q4' -> DATE 2024-10-01; anything else -> NULL (quarantined by the quality layer)."""
    s = F.trim(as_col(c))
    ok = s.rlike(QUARTER_PATTERN)
    year = F.regexp_extract(s, QUARTER_PATTERN, 1).try_cast("int")
    quarter = F.regexp_extract(s, QUARTER_PATTERN, 2).try_cast("int")
    return F.when(ok, F.make_date(year, (quarter - 1) * 3 + 1, F.lit(1)))


def quarter_label(d: ColumnLike) -> Column:
    """DATE -> 'YYYY QN'."""
    d = as_col(d)
    return F.concat(F.year(d).cast("string"), F.lit(" Q"), F.quarter(d).cast("string"))


def parse_date(c: ColumnLike) -> Column:
    return as_col(c).cast("string").try_cast("date")


def parse_timestamp(c: ColumnLike) -> Column:
    return as_col(c).cast("string").try_cast("timestamp_ntz")


def yyyymm(d: ColumnLike) -> Column:
    """DATE/TIMESTAMP -> INT 202502."""
    d = as_col(d)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def yyyymm_to_date(c: ColumnLike) -> Column:
    """INT 202502 -> DATE 2025-02-01; invalid -> NULL."""
    v = as_col(c).try_cast("int")
    month = v % 100
    return F.when(month.between(1, 12), F.make_date((v / 100).cast("int"), month, F.lit(1)))


def minute_stamp(ts: ColumnLike) -> Column:
    """Timestamp truncated to the minute as 'YYYY-MM-DD HH:MM' text."""
    return F.date_format(F.date_trunc("minute", as_col(ts)), "yyyy-MM-dd HH:mm")


def second_stamp(ts: ColumnLike) -> Column:
    return F.date_format(as_col(ts), "yyyy-MM-dd HH:mm:ss")


def run_timestamp_literal(run_ts: _dt.datetime) -> Column:
    """The run time is a parameter, never CURRENT_TIMESTAMP, so reruns reproduce.
    Built from text, so neither the Python nor the session time zone shifts it."""
    return F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
