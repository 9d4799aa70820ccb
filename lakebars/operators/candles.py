"""Typed candle projection (P1-P3, X1-X4) and the process-date filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebars.functions.casts import to_double, to_long, to_timestamp_ntz
from lakebars.functions.params import date_lit

PRICE_FIELDS = ("open", "close", "high", "low")


def typed_candles(raw: DataFrame, keep: tuple[str, ...] = ("ticker",)) -> DataFrame:
    """Raw text candles -> (keep..., begin_ts, open, close, high, low, volume, trade_date).

    Each field is cast on its own with ``try_cast``; a bad value becomes NULL.
    A row whose ``begin`` does not parse has a NULL trade_date and is dropped
    by any day filter.
    """
    return raw.select(
        *[F.col(c) for c in keep],
        to_timestamp_ntz("begin").alias("begin_ts"),
        *[to_double(c).alias(c) for c in PRICE_FIELDS],
        to_long("volume").alias("volume"),
    ).withColumn("trade_date", F.to_date("begin_ts"))


def on_day(df: DataFrame, process_date, column: str = "trade_date") -> DataFrame:
    """Rows of one trade date.  On a typed timestamp source Catalyst rewrites
    ``to_date(ts) = D`` into a range that reaches the Parquet scan."""
    return df.where(F.col(column) == date_lit(process_date))
