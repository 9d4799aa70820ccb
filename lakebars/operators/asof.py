"""Facts joined to the dimension version valid on the trade date (J5) and the mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebars.functions.params import as_date
from lakebars.functions.returns import daily_return_pct
from lakebars.schemas import MART, PRICE


EPOCH = dt.date(1970, 1, 1)
BINS = 256   # bins of a range of days at most; a version has a row for each bin it overlaps


def bin_width(first, last, bins: int = BINS) -> int:
    """Days of a bin, so that ``first`` to ``last`` (inclusive) have at most ``bins`` of them."""
    return max(1, -(-((as_date(last) - as_date(first)).days + 1) // bins))


def versions_by_bin(dimension: DataFrame, between, key: str = "ticker", bins: int = BINS) -> DataFrame:
    """Each version once for every bin of ``between`` that it overlaps: its columns, dates, key and bin.

    Versions outside the range have no row, the open ends of the others are cut to it.
    """
    first, last = (as_date(x) for x in between)
    width, day0 = bin_width(first, last, bins), F.lit((first - EPOCH).days)
    rows = dimension.select(
        F.col(key).alias("_dim_key"), *[F.col(c) for c in dimension.columns if c != key],
        F.to_date("valid_from").alias("_from_date"), F.to_date("valid_to").alias("_to_date"))
    rows = rows.where((F.col("_from_date") <= F.lit(last)) & (F.col("_to_date") > F.lit(first))
                      & (F.col("_from_date") < F.col("_to_date")))
    lo = F.greatest(F.unix_date("_from_date") - day0, F.lit(0))
    hi = F.least(F.unix_date("_to_date") - day0 - 1, F.lit((last - first).days))
    return rows.withColumn("_bin", F.explode(F.sequence(F.floor(lo / width), F.floor(hi / width))))


def asof_join(facts: DataFrame, dimension: DataFrame, key: str = "ticker",
              date_col: str = "trade_date", between=None, bins: int = BINS) -> DataFrame:
    """Inner join on ``key`` and ``date(valid_from) <= date < date(valid_to)``.

    Comparison is at date grain: a version opened and closed on one day
    matches nothing, overlapping versions duplicate a fact, and a fact with
    no version is dropped.

    ``between`` (first and last date of the facts) joins on key and bin of
    days: a fact meets the versions of its own bin only, however many its key
    has, and a key with a great many facts is spread over its bins.  Without
    it the join is on the key, with the range as residual.  In both, AQE
    turns the join into a broadcast when the dimension side is measured small
    and splits skewed partitions otherwise.
    """
    if between is None:
        d = dimension.select(
            F.col(key).alias("_dim_key"),
            *[F.col(c) for c in dimension.columns if c != key],
            F.to_date("valid_from").alias("_from_date"),
            F.to_date("valid_to").alias("_to_date"),
        )
        same = facts[key] == d["_dim_key"]
    else:
        d = versions_by_bin(dimension, between, key, bins)
        day0, width = F.lit((as_date(between[0]) - EPOCH).days), bin_width(*between, bins)
        facts = facts.withColumn("_fact_bin", F.floor((F.unix_date(date_col) - day0) / width))
        same = (facts[key] == d["_dim_key"]) & (facts["_fact_bin"] == d["_bin"])
    cond = same & (facts[date_col] >= d["_from_date"]) & (facts[date_col] < d["_to_date"])
    return facts.join(d, cond, "inner").drop("_dim_key", "_from_date", "_to_date", "_bin", "_fact_bin")


def mart_frame(bars: DataFrame, dimension: DataFrame, between=None) -> DataFrame:
    """Mart rows: bar + the issuer attributes of its version + daily return; ``between`` as in :func:`asof_join`."""
    joined = asof_join(bars, dimension, between=between)
    out = joined.select(
        "ticker", "company_name", "sector",
        F.col("dividend_policy_active").alias("is_dividend_payer"),
        *[F.col(c).cast(PRICE).alias(c) for c in ("open_price", "close_price", "high_price", "low_price")],
        F.col("volume").cast("bigint").alias("volume"),
        daily_return_pct("open_price", "close_price").alias("daily_return_pct"),
        "trade_date",
    )
    return out.select(*[f.name for f in MART.fields])
