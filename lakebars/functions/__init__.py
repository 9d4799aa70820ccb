"""Column-level helpers (JVM-side expressions only, no Python UDFs)."""

from lakebars.functions.casts import to_double, to_long, to_timestamp_ntz
from lakebars.functions.hashing import row_hash, surrogate_id
from lakebars.functions.params import (END_OF_TIME, START_OF_TIME, date_lit, parse_ticker_list,
                                       previous_dates, ts_lit)
from lakebars.functions.returns import daily_return_pct

__all__ = [
    "to_double", "to_long", "to_timestamp_ntz", "row_hash", "surrogate_id", "END_OF_TIME",
    "START_OF_TIME", "date_lit", "parse_ticker_list", "previous_dates", "ts_lit",
    "daily_return_pct",
]
