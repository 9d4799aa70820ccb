"""Run parameters: dates, ticker lists and the fixed time literals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the dimension's open interval (must match the reference):
# first version starts 1900-01-01 00:00:00, open end is 9999-12-31 23:59:59.
START_OF_TIME = dt.datetime(1900, 1, 1, 0, 0, 0)
END_OF_TIME = dt.datetime(9999, 12, 31, 23, 59, 59)


def as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def as_datetime(value) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(str(value))


def date_lit(value) -> Column:
    return F.lit(as_date(value)).cast("date")


def ts_lit(value) -> Column:
    return F.lit(as_datetime(value)).cast("timestamp_ntz")


def previous_dates(process_date, lookback_days: int = 1) -> list[dt.date]:
    """[D, D-1, ..., D-k]: the load dates tried for a process date, newest first."""
    d = as_date(process_date)
    return [d - dt.timedelta(days=i) for i in range(lookback_days + 1)]


def parse_ticker_list(text: str | list[str] | None) -> list[str]:
    """'A, B,,C' -> ['A', 'B', 'C'] (order kept, blanks and repeats dropped)."""
    if text is None:
        return []
    items = text.split(",") if isinstance(text, str) else list(text)
    seen, out = set(), []
    for item in items:
        item = item.strip()
        if item and item not in seen:
            seen.add(item)
            out.append(item)
    return out
