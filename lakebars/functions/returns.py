"""Daily return in percent."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakebars.schemas import PRICE, RETURN_PCT


def daily_return_pct(open_col="open_price", close_col="close_price") -> Column:
    """round((close - open) / open * 100, 2), exact decimal, half away from zero.

    Prices are decimals, so the division is exact to 20+ places and the
    rounding of ties (0.125 -> 0.13) is not subject to binary doubles.
    A zero open gives NULL instead of an ANSI division error; the quality
    gate reports such rows before the mart is built.
    """
    o = F.col(open_col).cast(PRICE) if isinstance(open_col, str) else open_col.cast(PRICE)
    c = F.col(close_col).cast(PRICE) if isinstance(close_col, str) else close_col.cast(PRICE)
    ratio = F.try_divide(c - o, o)
    return F.round(ratio * F.lit(100), 2).cast(RETURN_PCT)
